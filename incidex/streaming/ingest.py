"""Landing files -> bronze table, incrementally.

The batch job appends one landing file (one year) at a time.  Here the landing
folder is a streaming file source.  Each micro-batch is fingerprinted and
de-duplicated, rows that the table already holds are taken out with an
anti-join, and the rest is published as one version of the table
(``sources.versions``).

A fingerprint covers every column, the year among them, so a record can only
be in the partition of its own year: the anti-join reads the fingerprint
column of the years that the batch touches, and nothing else is kept.  There
is no streaming state, so neither memory nor a checkpoint grows with the
history.

The manifest names the last batch of each stream in the same step that
publishes its rows.  A batch that is run again (a failure between publishing
and the stream's own commit) finds its number there and changes nothing; one
that failed before overwrites its own unpublished folder.  A partition made up
of many small batches is rewritten as one version after ``COMPACT_AFTER`` of
them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import row_fingerprint
from ..operators.columns import drop_suffix_columns, drop_void_columns
from ..sources.versions import VersionedTable

YEAR = "YEAR_INFO"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"      # fixed: Spark's folder of null partition values
COMPACT_AFTER = 16


def bronze_rows(df: DataFrame, year_col: str) -> DataFrame:
    """Landing records, each once, with fingerprint and year."""
    df = drop_void_columns(drop_suffix_columns(df))
    return (df.withColumn("ID", row_fingerprint(df.columns))
              .withColumn(YEAR, F.col(year_col).try_cast("int"))
              .dropDuplicates(["ID"]))


def touched_partitions(batch: DataFrame, year_col: str) -> list[str]:
    """Folders of the years that occur in a batch (one row a year)."""
    years = batch.select(F.col(year_col).try_cast("int").alias(YEAR)).distinct().collect()
    return [f"{YEAR}={NULL_PARTITION if r[0] is None else r[0]}" for r in years]


def append_batch(table: VersionedTable, batch: DataFrame, batch_id: int, stream: str, year_col: str) -> bool:
    """Add the rows of a batch that ``table`` does not hold yet, exactly once;
    False: the batch is part of the table already."""
    done = table.manifest()
    if done and done["note"].get(stream, -1) >= batch_id:
        return False
    rows = bronze_rows(batch, year_col)
    if done:
        known = table.read(names=touched_partitions(batch, year_col)).select("ID")
        rows = rows.join(known, "ID", "left_anti").select(*rows.columns)
    name = hashlib.sha256(f"{stream}\n{batch_id}".encode()).hexdigest()[:16]
    table.publish(table.stage(rows, YEAR, version=name), keep="all", note={stream: batch_id})
    table.compact(YEAR, COMPACT_AFTER)
    return True


def ingest_landing(spark: SparkSession, landing: str, schema, out_path: str, checkpoint: str,
                   year_col: str, fmt: str = "parquet", files_per_batch: int = 1) -> VersionedTable:
    """Run until every file present in ``landing`` is ingested (availableNow).
    ``checkpoint`` names the stream: a new one reads every file again."""
    table = VersionedTable(spark, out_path)

    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(table, batch, batch_id, checkpoint, year_col)
    (spark.readStream.schema(schema).format(fmt)
          .option("maxFilesPerTrigger", files_per_batch).load(landing)
          .writeStream.foreachBatch(append)
          .option("checkpointLocation", checkpoint)
          .trigger(availableNow=True)
          .start().awaitTermination())
    return table
