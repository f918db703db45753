"""Coordinate repair and validation for text coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Coordinates written without a decimal point get one after the first two
# digits (sign kept).  The sign group is possessive so '-23' stays '-23'.
EDGE_SPACE = r"^\s+|\s+$"
MISSING_POINT = r"(?s)^(-?+)([^.]{2})([^.]+)$"
# Largest magnitude a DECIMAL(24,20) coordinate can hold (4 integer digits).
COORD_LIMIT = 10000.0
# Degrees below which the Mercator projection can use a coordinate.
LONGITUDE_LIMIT = 180.0
LATITUDE_LIMIT = 89.0
# ---------------------------------------------------------------------------


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def repair_coordinate(col: Column | str) -> Column:
    trimmed = F.regexp_replace(_c(col), EDGE_SPACE, "")
    return F.regexp_replace(trimmed, MISSING_POINT, "$1$2.$3")


def coordinate_value(col: Column | str, limit: float = COORD_LIMIT) -> Column:
    """Repaired text -> double; NULL when unparseable or not below ``limit``."""
    v = _c(col).try_cast("double")
    return F.when(F.abs(v) < F.lit(limit), v)


def valid_coordinate(value: Column | str) -> Column:
    """A usable coordinate is present and not the 0 placeholder."""
    v = _c(value)
    return v.isNotNull() & (v != F.lit(0.0))


def usable_point(x: Column | str, y: Column | str) -> Column:
    """Both coordinates are present and not the 0 placeholder (each is named
    once: a filter on them is moved below long text expressions)."""
    return F.coalesce((F.abs(_c(x)) > 0) & (F.abs(_c(y)) > 0), F.lit(False))
