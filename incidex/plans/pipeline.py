"""The incident pipeline as DataFrame -> DataFrame steps.

bronze  landing records typed as text, duplicate/void columns dropped,
        null-safe content fingerprint, de-duplicated
silver  sectors: demographics, dissolved geometry + Mercator area, joined
        incidents: per source cleaning and keys; union, priority de-dup,
        classification and the point-in-sector spatial join
gold    incidents; per sector-year and municipality-year counts, per-type
        counts and population rate indices
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coords import LATITUDE_LIMIT, LONGITUDE_LIMIT, coordinate_value, repair_coordinate, usable_point
from ..functions.dates import day_with_default
from ..functions.geometry import EARTH_RADIUS_M, M2_PER_KM2
from ..functions.keys import entity_key, packed_columns, packed_key, row_fingerprint, unpacked_key, zone_year_sha1, zone_year_sha256
from ..functions.text import label_to_identifier, merge_labels, normalize_text
from ..operators.aggregate import population_rollup, total_and_type_counts
from ..operators.classify import INCIDENT_CLASSES, VEHICLE_LABELS, VEHICLE_MERGED, classify
from ..operators.columns import drop_suffix_columns, drop_void_columns
from ..operators.dedup import keep_top_priority, union_sources
from ..operators.rates import GUARD_YEAR, MUNICIPALITY_BASE, SECTOR_BASE, rate_index
from ..operators.spatial import dissolve, spatial_join, zone_edges
from ..sources.sinks import spread

# --- fixed values -----------------------------------------------------------
STATE = "SP"
CENSUS_YEAR = 2022
REDACTION_PATTERN = "%DIVULGA__O%"
CELLPHONE_TYPE = "FURTO ROUBO DE CELULAR"
VEHICLE_TYPE = "FURTO ROUBO DE VEICULO"
INCIDENT_ID_COLUMNS = ["ADDRESS", "ADDRESS_NUMBER", "NEIGHBORHOOD", "LATITUDE", "LONGITUDE",
                       "DAY_INFO", "MONTH_INFO", "YEAR_INFO"]
SOURCE_COLUMNS = ["ID", "CRIMINAL_TYPE", "ADDRESS", "ADDRESS_NUMBER", "NEIGHBORHOOD",
                  "DAY_INFO", "MONTH_INFO", "YEAR_INFO", "x", "y"]
INCIDENT_COLUMNS = ["ID_CRIME", "CRIMINAL_CLASS", "CRIMINAL_TYPE", "ADDRESS", "ADDRESS_NUMBER",
                    "NEIGHBORHOOD", "DAY_INFO", "MONTH_INFO", "YEAR_INFO", "ID_SC", "ID_MUN",
                    "MUN", "STATE", "x", "y", "CRIMINAL_CLASS_TREATED", "CRIMINAL_TYPE_TREATED"]
TYPE_COLUMNS = list(INCIDENT_CLASSES)      # one count column per known treated type
OTHER_COLUMN = "OTHER_TYPES"                # incidents of every other type
REJECT_REASONS = ["coordinate", "no_address", "redacted"]      # every value of reject_reason
# ---------------------------------------------------------------------------


def in_state(col: str = "CD_UF", code: int = 35):
    """State filter that accepts '35', '035', ' 35' and '35.0'."""
    return F.col(col).try_cast("double").cast("int") == F.lit(code)


# ------------------------------------------------------------ materialise --
def materialize(df: DataFrame, name: str, partition_cols=None, max_records: int | None = None, late=None) -> DataFrame:
    """Write a layer table to the shared folder and read it back with the same
    schema.  Later steps then scan it instead of recomputing its lineage, and a
    lost executor only re-reads files.  ``late``: see ``write_partitioned``."""
    from ..session import shared_path, writing
    from ..sources.sinks import LAYER_COMPRESSION, write_partitioned
    spark = df.sparkSession
    path = shared_path(spark, name)
    if partition_cols:
        write_partitioned(df, path, partition_cols, max_records=max_records, late=late)
    else:
        with writing(spark):
            (df if late is None else late(df)).write.mode("overwrite").option("compression", LAYER_COMPRESSION).parquet(path)
    return spark.read.schema(df.schema if late is None else late(df).schema).parquet(path)


# ----------------------------------------------------------------- bronze --
def bronze(df: DataFrame, year_col: str | None = None, year: int | None = None) -> DataFrame:
    """Fingerprint, year and distinct rows of a landing table.  A column
    ``YEAR_INFO`` (the year of the row's landing file) is the year itself and
    no part of the fingerprint."""
    rows, late = bronze_parts(df, year_col, year, pack=False)
    return late(rows)


def bronze_parts(df: DataFrame, year_col: str | None = None, year: int | None = None, pack: bool = True):
    """-> (rows, late): ``bronze`` is ``late(rows)``.  Fingerprint and year follow
    from the other columns, so the exchange of the distinct need not carry
    them.  ``pack``: texts travel as one (``packed_columns``), for rows that are
    written; filters do not get below it."""
    df = drop_void_columns(drop_suffix_columns(df))
    key = row_fingerprint([c for c in df.columns if c != "YEAR_INFO"])

    def with_year(d):
        if year is not None:
            return d.withColumn("YEAR_INFO", F.lit(int(year)))
        return d if year_col is None else d.withColumn("YEAR_INFO", F.col(year_col).try_cast("int"))
    keyed = with_year(df.withColumn("ID", key))
    # 0.0 and -0.0 are equal but have different fingerprints; an ID of the source's own makes way for the fingerprint
    if any(t in f.dataType.simpleString() for f in df.schema.fields for t in ("float", "double")) \
            or "id" in (c.lower() for c in df.columns):
        return keyed.distinct(), spread(lambda d: d)
    rows, unpack = packed_columns(df) if pack else (df, lambda d: d)
    return rows.distinct(), spread(lambda d: with_year(unpack(d)).withColumn("ID", key).select(*[f"`{c}`" for c in keyed.columns]))


# ------------------------------------------------------------ silver area --
def sector_population(demo: DataFrame) -> DataFrame:
    return (demo.where(in_state())
                .select(F.col("CD_SETOR").alias("ID_SC"),
                        F.col("v0001").try_cast("double").cast("int").alias("POP_TOTAL"),
                        F.lit(CENSUS_YEAR).alias("YEAR_INFO"))
                .distinct())


def municipality_population(demo: DataFrame) -> DataFrame:
    return (population_rollup(demo.where(in_state()), "CD_MUN", "v0001")
            .select(F.col("CD_MUN").alias("ID_MUN"), "POP_TOTAL",
                    F.lit(CENSUS_YEAR).alias("YEAR_INFO")))


def mercator_area_km2(edges: DataFrame, keys) -> DataFrame:
    """Planar area in EPSG:3857 of dissolved boundary edges, km^2."""
    def px(c):
        return F.lit(EARTH_RADIUS_M) * F.radians(c)

    def py(c):
        return F.lit(EARTH_RADIUS_M) * F.ln(F.tan(F.lit(3.141592653589793) / 4 + F.radians(c) / 2))
    term = (px("x1") * py("y2") - px("x2") * py("y1")) * F.col("mult")
    return edges.groupBy(*keys).agg((F.sum(term) / 2 / F.lit(M2_PER_KM2)).alias("AREA_KM2"),
                                    F.count(F.lit(1)).alias("n_edges"))


SECTOR_KEYS = ["CD_SETOR", "CD_MUN", "NM_MUN"]
MUNICIPALITY_KEYS = ["CD_MUN", "NM_MUN"]


def zone_boundaries(parts: DataFrame, keys, split_cell: float | None = None) -> DataFrame:
    """In-state zone parts -> dissolved boundary edges per key (``split_cell``:
    split edges at T-junctions first, see ``operators.spatial.dissolve``)."""
    return dissolve(zone_edges(parts.where(in_state()), keys), keys, split_cell=split_cell)


def sector_table(edges: DataFrame) -> DataFrame:
    """Sector boundary edges -> one row per sector with its Mercator area."""
    area = mercator_area_km2(edges, SECTOR_KEYS)
    return area.select(F.col("CD_SETOR").alias("ID_SC"), F.col("CD_MUN").alias("ID_MUN"),
                       F.col("NM_MUN").alias("MUN"), F.lit(STATE).alias("STATE"),
                       "AREA_KM2", "n_edges", F.lit(CENSUS_YEAR).alias("YEAR_INFO"))


def municipality_table(edges: DataFrame) -> DataFrame:
    area = mercator_area_km2(edges, MUNICIPALITY_KEYS)
    return area.select(F.col("CD_MUN").alias("ID_MUN"), F.col("NM_MUN").alias("MUN"),
                       F.lit(STATE).alias("STATE"), "AREA_KM2", "n_edges",
                       F.lit(CENSUS_YEAR).alias("YEAR_INFO"))


def sector_geometry(parts: DataFrame, persist=None):
    """-> (sector table, sector boundary edges).  Parts of a sector are
    dissolved; area from the dissolved boundary.  ``persist`` (e.g.
    ``materialize``) is applied to the edges so both outputs read them once."""
    edges = zone_boundaries(parts, SECTOR_KEYS)
    if persist is not None:
        edges = persist(edges)
    return sector_table(edges), edges.withColumnRenamed("CD_SETOR", "ID_SC").drop("CD_MUN", "NM_MUN")


def municipality_geometry(parts: DataFrame):
    edges = zone_boundaries(parts, MUNICIPALITY_KEYS)
    return municipality_table(edges), edges.withColumnRenamed("CD_MUN", "ID_MUN").drop("NM_MUN")


def zone_with_population(geom: DataFrame, demo: DataFrame, key: str) -> DataFrame:
    """Zone geometry table left-joined with its demographics."""
    return geom.drop("YEAR_INFO").join(demo.drop("YEAR_INFO"), on=key, how="left") \
        .withColumn("YEAR_INFO", F.lit(CENSUS_YEAR))


# -------------------------------------------------------- silver incidents --
def reject_reason():
    """Why a landing record (with coordinates ``x``, ``y``) is left out; NULL: it is kept."""
    return (F.when(~usable_point("x", "y"), "coordinate").when(F.col("LOGRADOURO").isNull(), "no_address")
            .when(F.col("LOGRADOURO").like(REDACTION_PATTERN), "redacted"))


def incident_rejects(raw: DataFrame, source: str) -> DataFrame:
    """Number of landing records of a source left out, by reason.  One count a
    reason and no filter on it: a filter would be moved below the coordinate
    texts and work them out once more."""
    located = raw.select("LOGRADOURO", coordinate_value(repair_coordinate("LONGITUDE"), LONGITUDE_LIMIT).alias("x"),
                         coordinate_value(repair_coordinate("LATITUDE"), LATITUDE_LIMIT).alias("y"))
    counts = located.select(reject_reason().alias("reason")).agg(*[F.count_if(F.col("reason") == r).alias(r) for r in REJECT_REASONS])
    return (counts.select(F.explode(F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in REJECT_REASONS])).alias("r"))
            .select(F.lit(source).alias("source"), "r.reason", "r.n").where("n > 0"))


def incident_source(raw: DataFrame, crime_type=None, month: str = "MES", year: str = "ANO",
                    type_col: str | None = None) -> DataFrame:
    """Landing incident records of one source -> cleaned, keyed, de-duplicated.

    ``crime_type``: fixed type for single-type sources; ``type_col``: column
    holding the type (vehicle labels are merged first)."""
    rows, late = incident_source_parts(raw, crime_type, month, year, type_col, pack=False)
    return late(rows)


def incident_source_parts(raw: DataFrame, crime_type=None, month: str = "MES", year: str = "ANO",
                          type_col: str | None = None, pack: bool = True):
    """-> (rows, late): ``incident_source`` is ``late(rows)``.  Rows are distinct
    in the columns that make the key; the coordinates' texts hold no separator
    of the key, so these are the rows that are distinct with their keys.
    ``pack``: as in ``bronze_parts``."""
    lat = repair_coordinate("LATITUDE")
    lon = repair_coordinate("LONGITUDE")
    typ = F.lit(crime_type) if crime_type is not None else \
        merge_labels(type_col, VEHICLE_LABELS, VEHICLE_MERGED)
    df = raw.select(
        F.col("LOGRADOURO"), F.col("NUMERO_LOGRADOURO").alias("ADDRESS_NUMBER"),
        F.col("BAIRRO"), lat.alias("LATITUDE"), lon.alias("LONGITUDE"),
        day_with_default("DATA_OCORRENCIA_BO").alias("DAY_INFO"),
        F.col(month).try_cast("int").alias("MONTH_INFO"),
        F.col(year).try_cast("int").alias("YEAR_INFO"),
        typ.alias("_type"))

    def located(d):
        return d.withColumn("x", coordinate_value("LONGITUDE", LONGITUDE_LIMIT)) \
                .withColumn("y", coordinate_value("LATITUDE", LATITUDE_LIMIT))
    df = located(df).where(reject_reason().isNull())
    df = (df.withColumn("ADDRESS", normalize_text("LOGRADOURO"))
            .withColumn("NEIGHBORHOOD", normalize_text("BAIRRO"))
            .withColumn("CRIMINAL_TYPE", normalize_text("_type")))
    rows, unpack = df.select("CRIMINAL_TYPE", *INCIDENT_ID_COLUMNS), lambda d: d
    if pack:
        rows, unpack = packed_columns(rows)
    return rows.distinct(), spread(lambda d: located(unpack(d)).withColumn("ID", entity_key(INCIDENT_ID_COLUMNS)).select(*SOURCE_COLUMNS))


def incidents(cellphones: DataFrame, vehicles: DataFrame, others: DataFrame,
              sector_edges: DataFrame, sectors: DataFrame, cell: float | None = None) -> DataFrame:
    """Union of the sources, best-priority rows per incident (ties kept),
    incident key and class, then the point-in-sector join (boundary
    inclusive: a point on a shared border belongs to both sectors).
    ``sector_edges`` is a written layer table."""
    rows, late = incident_parts(cellphones, vehicles, others, sector_edges, sectors, cell)
    return late(rows)


def incident_parts(cellphones: DataFrame, vehicles: DataFrame, others: DataFrame,
                   sector_edges: DataFrame, sectors: DataFrame, cell: float | None = None):
    """-> (rows, late): ``incidents`` is ``late(rows)``.  Key, class and labels
    follow from a row's other columns, so the exchanges carry the packed key of
    the source alone; texts travel as one."""
    u = union_sources([(cellphones, 1), (vehicles, 2), (others, 3)]).withColumn("ID", packed_key("ID"))
    u, unpack = packed_columns(u, keep=("ID", "YEAR_INFO", "MONTH_INFO", "x", "y", "priority"))
    best = keep_top_priority(u, "ID", null_keys=False, ends=(1, 3)).drop("priority")
    attrs = sectors.select("ID_SC", "ID_MUN", "MUN", "STATE")
    joined = spatial_join(best, sector_edges.select("ID_SC", "x1", "y1", "x2", "y2"), ["ID_SC"],
                          x="x", y="y", cell=cell, attrs=attrs, edges_written=True)


    def late(d):
        return (unpack(d).withColumn("ID", unpacked_key("ID"))
                 .withColumn("ID_CRIME", entity_key(["ID", "CRIMINAL_TYPE", "ADDRESS", "ADDRESS_NUMBER", "NEIGHBORHOOD",
                                                     "DAY_INFO", "MONTH_INFO", "YEAR_INFO"]))
                 .withColumn("CRIMINAL_TYPE_TREATED", label_to_identifier("CRIMINAL_TYPE"))
                 .withColumn("CRIMINAL_CLASS", classify("CRIMINAL_TYPE_TREATED"))
                 .withColumn("CRIMINAL_CLASS_TREATED", label_to_identifier("CRIMINAL_CLASS"))
                 .select(*INCIDENT_COLUMNS))
    return joined, late


# ------------------------------------------------------------------- gold --
def gold_incidents(silver: DataFrame) -> DataFrame:
    """Incident grain: collapse the copies a border point got per sector."""
    rows, late = gold_incident_parts(silver, pack=False)
    return late(rows)


def packed_incidents(df: DataFrame, pack: bool = True):
    """-> (rows, late): ``df`` is ``late(rows)``, and ``rows`` has its key as
    bytes.  ``pack``: as in ``bronze_parts``."""
    rows, unpack = df.withColumn("ID_CRIME", packed_key("ID_CRIME")), lambda d: d
    if pack:
        rows, unpack = packed_columns(rows, keep=("YEAR_INFO", "MONTH_INFO"))
    return rows, lambda d: unpack(d).withColumn("ID_CRIME", unpacked_key("ID_CRIME"))


def gold_incident_parts(silver: DataFrame, pack: bool = True):
    """-> (rows, late): ``gold_incidents`` is ``late(rows)``.  ``pack``: as in
    ``bronze_parts``."""
    rows, late = packed_incidents(silver.drop("ID_SC", "CRIMINAL_TYPE_TREATED", "CRIMINAL_CLASS_TREATED"), pack)
    return rows.distinct(), spread(late)


gold_incidents.parts = gold_incident_parts


def _zone_rates(silver: DataFrame, zones: DataFrame, zone: str, base: int) -> DataFrame:
    counts = total_and_type_counts(silver, [zone, "YEAR_INFO"], "ID_CRIME", "CRIMINAL_TYPE_TREATED",
                                   TYPE_COLUMNS, total_name="TOTAL_CRIMES", other_name=OTHER_COLUMN)
    data = zones.drop("YEAR_INFO").join(counts, on=zone, how="inner")
    return (data.withColumn("TOTAL_CRIME_INDEX", rate_index("TOTAL_CRIMES", "POP_TOTAL", base,
                                                            "YEAR_INFO", GUARD_YEAR))
                .withColumn("CELLPHONE_CRIME_INDEX", rate_index("FURTO_ROUBO_DE_CELULAR", "POP_TOTAL", base))
                .withColumn("VEHICLE_CRIME_INDEX", rate_index("FURTO_ROUBO_DE_VEICULO", "POP_TOTAL", base)))


def sector_rates(silver: DataFrame, sectors: DataFrame) -> DataFrame:
    return _zone_rates(silver, sectors, "ID_SC", SECTOR_BASE) \
        .withColumn("ID_SC_CRIME", zone_year_sha256("ID_SC", "YEAR_INFO"))


def municipality_rates(silver: DataFrame, municipalities: DataFrame) -> DataFrame:
    return _zone_rates(silver, municipalities, "ID_MUN", MUNICIPALITY_BASE) \
        .withColumn("ID_MUN_CRIME", zone_year_sha1("ID_MUN", "YEAR_INFO"))
