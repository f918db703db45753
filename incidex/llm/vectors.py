"""Vector helpers shared by the search and the near-duplicate join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vec: str):
    """Condition: not null, not zero, and every component finite."""
    v = F.col(vec)
    return (v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))


def matrix(lists) -> np.ndarray:
    """Rows of an Arrow list array of one length, in double precision."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def common_length(df: DataFrame, vec: str) -> int | None:
    """The most frequent vector length."""
    top = df.groupBy(F.size(vec).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return top["d"] if top else None
