"""Writers: partitioned parquet, GeoJSON features, metrics CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import writing

LAYER_COMPRESSION = "zstd"      # keys in hex digits are half as large as with snappy


def write_partitioned(df: DataFrame, path: str, partition_cols, max_records: int | None = None,
                      mode: str = "overwrite", only_partitions: bool = False, late=None) -> None:
    """Partitioned parquet.  An overwrite replaces the whole table, so no old
    partition survives a run with fewer values; ``only_partitions`` replaces
    just the partitions that ``df`` holds (a refresh of one year).

    Rows are rebalanced on the partition columns before the write (AQE's
    ``REBALANCE``): each partition value goes to its own writer, a value
    holding a large share of the data is split into tasks of the advisory
    size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and small
    values are packed together.  File count per value therefore follows the
    data size instead of a fixed fan-out, and a retried task re-reads the same
    hash-partitioned shuffle blocks.  ``max_records=None``: no record cap per
    file (file size then follows the advisory size alone).  ``late`` (rows ->
    rows): what each row's columns give by themselves, such as hash keys, added
    behind the exchange, which then carries less.  Rows of a ``spread`` late are
    not moved again: a file per task and value."""
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    with writing(df.sparkSession):
        laid_out(df, cols, late) \
           .write.partitionBy(*cols) \
           .option("compression", LAYER_COMPRESSION) \
           .option("maxRecordsPerFile", max_records or 0) \
           .option("partitionOverwriteMode", "dynamic" if only_partitions else "static") \
           .mode(mode).parquet(path)


def spread(late):
    """Marks the ``late`` of rows that come out of an exchange on all their
    columns (a distinct): every task has its share of every partition value,
    so they are written from there without a second exchange."""
    late.spread = True
    return late


def laid_out(df: DataFrame, cols, late=None) -> DataFrame:
    """Rows dealt out to the writers of a table partitioned by ``cols``, with
    their ``late`` columns."""
    out = df.hint("rebalance", *cols) if cols and not getattr(late, "spread", False) else df
    return out if late is None else late(out)


def write_delimited(df: DataFrame, path: str, sep: str = ";", encoding: str = "Windows-1252",
                    header: bool = True, mode: str = "overwrite") -> None:
    """Delimited text in the landing format (one file per task)."""
    from .readers import allow_charset
    allow_charset(df.sparkSession, encoding)
    (df.write.mode(mode).option("sep", sep).option("header", header)
       .option("encoding", encoding).csv(path))


def geojson_features(df: DataFrame, rings: str = "rings", properties=None) -> DataFrame:
    """One GeoJSON Feature (Polygon) per row, as a JSON string column."""
    props = properties or [c for c in df.columns if c != rings]
    coords = F.transform(F.col(rings), lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(c) for c in props]).alias("properties"))
    return df.select(F.to_json(feature).alias("value"))


def geojson_points(df: DataFrame, x: str, y: str, properties=None) -> DataFrame:
    """One GeoJSON Feature (Point) per row."""
    props = properties or [c for c in df.columns if c not in (x, y)]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(c) for c in props]).alias("properties"))
    return df.select(F.to_json(feature).alias("value"))


def geojson_multipolygons(df: DataFrame, polygons: str = "polygons", properties=None) -> DataFrame:
    """One GeoJSON Feature (MultiPolygon) per row from ``assemble_polygons``
    output: polygons = [exterior, hole, ...] rings of x/y structs."""
    props = properties or [c for c in df.columns if c != polygons]
    coords = F.transform(F.col(polygons), lambda poly: F.transform(
        poly, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(c) for c in props]).alias("properties"))
    return df.select(F.to_json(feature).alias("value"))


def write_geojson_lines(df: DataFrame, path: str, rings: str = "rings", properties=None) -> None:
    geojson_features(df, rings, properties).write.mode("overwrite").text(path)


def write_metrics_csv(df: DataFrame, path: str) -> None:
    """Small metrics table -> one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
