"""Schema-driven column shaping."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql.types import NullType

# --- fixed values -----------------------------------------------------------
DUPLICATE_SUFFIX = re.compile(r"\.\d+$")   # 'ANO.1', 'ANO.12' are repeated headers
# ---------------------------------------------------------------------------


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def drop_suffix_columns(df: DataFrame) -> DataFrame:
    keep = [f.name for f in df.schema.fields if not DUPLICATE_SUFFIX.search(f.name)]
    return df.select(*[_q(c) for c in keep])


def drop_void_columns(df: DataFrame) -> DataFrame:
    keep = [f.name for f in df.schema.fields if not isinstance(f.dataType, NullType)]
    return df.select(*[_q(c) for c in keep])
