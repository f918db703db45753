"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidex.session import ensure_checkpoint_dir, shared_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH_ROWS = 2_000


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package when it was not installed or sent
    with ``--py-files`` and the folder exists on their machine.

    Batches of Spark's standard 10,000 rows are cut to ``BATCH_ROWS``: rows
    here are whole texts, and both sides hold a batch at a time."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, PACKAGE_ROOT) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_shared(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the folder named by ``spark.checkpoint.dir``
    and read it back: lineage is cut, and a lost executor costs nothing."""
    spark = spark or df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         name: str = "components") -> DataFrame:
    """Smallest reachable node of every node that has an edge: rows
    ``(node, component)``.

    Alternating large-star and small-star rounds on the edge table: each round
    links every node's neighbours to the smallest node it sees, which at least
    halves the length of chains.  Only aggregates and equi-joins run, a hot
    node's edges are pre-aggregated before the shuffle and split by AQE in the
    join.  Each round is written to the shared folder; the driver sees two
    numbers a round (the edge count and a checksum), never links.

    Edges with a null end and self links are ignored; repeated edges count
    once; without edges the result is empty.  Columns other than ``a`` and
    ``b`` are not read.
    """
    spark = edges.sparkSession
    kind = edges.schema[a].dataType
    e = (edges.select(F.col(a).cast(kind).alias("u"), F.col(b).cast(kind).alias("v"))
         .where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = write_shared(e, name)
    seen = None
    while True:
        # large star: every neighbour greater than the node gets the smallest of its neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: smaller neighbours and the node itself get the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct())
        e = write_shared(small, name)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
