"""Date helpers on text dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
DEFAULT_DAY = 1
DMY_PATTERN = "d/M/yyyy"
OUTPUT_PATTERN = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------


def day_with_default(col: Column | str) -> Column:
    """Day of month of a text timestamp; 1 when the text does not parse."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.dayofmonth(F.try_to_timestamp(c)), F.lit(DEFAULT_DAY))


def assemble_date(day, month, year) -> Column:
    """d/M/yyyy parts -> 'yyyy-MM-dd HH:mm:ss'; impossible dates give NULL."""
    parts = [F.col(x).cast("string") if isinstance(x, str) else x.cast("string")
             for x in (day, month, year)]
    d = F.try_to_date(F.concat_ws("/", *parts), DMY_PATTERN)
    return F.date_format(d, OUTPUT_PATTERN)
