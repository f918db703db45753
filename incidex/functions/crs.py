"""Reference systems as checked column metadata.

The SRID of a geometry is metadata of its columns (``rings``, or each
coordinate column).  Spark keeps column metadata through projections, joins
and Parquet files, so a table read back still tells its system.  ``to_srid``
is the only thing that changes it; operators that bring two geometries
together call ``same_srid``, which refuses two different systems.  Columns
without an SRID are of unknown system and meet any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geometry import EARTH_RADIUS_M, mercator_rings

# --- fixed values -----------------------------------------------------------
SIRGAS_2000 = 4674       # longitude and latitude in degrees
WGS_84 = 4326            # longitude and latitude in degrees
WEB_MERCATOR = 3857      # metres
GEOGRAPHIC = (SIRGAS_2000, WGS_84)     # equal to within the data's precision
# ---------------------------------------------------------------------------

KEY = "srid"


class SridMismatch(ValueError):
    """Geometries of different reference systems meet."""


def with_srid(df: DataFrame, srid: int, *columns: str) -> DataFrame:
    """``df`` with the reference system of geometry columns recorded (their
    other metadata stays); a column that tells another one is refused."""
    told = srid_of(df, *columns)
    if told not in (None, srid):
        raise SridMismatch(f"{', '.join(columns)}: SRID {told}, not {srid}; use to_srid to reproject")
    return _marked(df, srid, columns)


def _marked(df: DataFrame, srid: int, columns) -> DataFrame:
    for c in columns:
        df = df.withMetadata(c, {**df.schema[c].metadata, KEY: srid})
    return df


def srid_of(df: DataFrame, *columns: str) -> int | None:
    """The SRID that the columns tell; ``None`` where none does."""
    told = {df.schema[c].metadata.get(KEY) for c in columns} - {None}
    if len(told) > 1:
        raise SridMismatch(f"{', '.join(columns)}: SRIDs {sorted(told)} in one geometry")
    return told.pop() if told else None


def same_srid(left: DataFrame, left_columns, right: DataFrame, right_columns) -> int | None:
    """The SRID two geometries share, where any tells one; different ones are refused."""
    a, b = srid_of(left, *left_columns), srid_of(right, *right_columns)
    if None not in (a, b) and a != b:
        raise SridMismatch(f"SRID {a} ({', '.join(left_columns)}) meets SRID {b} ({', '.join(right_columns)})")
    return b if a is None else a


def to_srid(df: DataFrame, srid: int, *, rings: str | None = None, x: str | None = None,
            y: str | None = None) -> DataFrame:
    """``df`` reprojected, either its ``rings`` or its ``x`` and ``y``.

    The geometry must tell its system.  Between the geographic systems the
    coordinates stay; from them to Mercator they are projected.  The same
    system changes nothing, any other way is refused.  Nulls stay null."""
    columns = (rings,) if rings else (x, y)
    told = srid_of(df, *columns)
    if told is None:
        raise SridMismatch(f"{', '.join(columns)}: no SRID recorded, nothing to reproject from")
    if told == srid:
        return df
    if told not in GEOGRAPHIC or srid not in (*GEOGRAPHIC, WEB_MERCATOR):
        raise SridMismatch(f"no way from SRID {told} to {srid}")
    if srid == WEB_MERCATOR:
        kept = {c: df.schema[c].metadata for c in columns}
        if rings:
            df = df.withColumn(rings, mercator_rings(f"`{rings}`"))
        else:
            df = df.withColumns({x: F.lit(EARTH_RADIUS_M) * F.radians(x),
                                 y: F.lit(EARTH_RADIUS_M) * F.ln(F.tan(F.pi() / 4 + F.radians(y) / 2))})
        for c in columns:
            df = df.withMetadata(c, kept[c])
    return _marked(df, srid, columns)
