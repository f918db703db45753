"""Session construction and shared-folder handling."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings the library relies on.  AQE re-plans joins from runtime sizes (a join
# side is broadcast only when its measured size is under the threshold) and
# splits skewed shuffle partitions; the charset flag lets the CSV reader decode
# legacy encodings such as Windows-1252.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # geometry and text work after a shuffle is CPU-bound while its shuffle
    # bytes are small: do not merge such partitions below 128 KiB
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# What holds in a session while a table is written.
WRITE_CONF = {
    # a write's shuffle files go when it has ended, not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # a task that meets few partition values writes their files side by side, without a sort that may spill
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}
_WRITERS: dict = {}       # session -> [writes under way, settings before]
_WRITERS_LOCK = threading.Lock()


def build_session(master: str | None = None, app_name: str = "incidex",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  A folder of our own is set only when the
    setting is missing and the session runs in local mode (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="incidex-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for written tables
    that cut lineage or round-trip a sink)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/incidex/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def writing(spark: SparkSession):
    """``WRITE_CONF`` holds in the session until the last of its writes under
    way has ended; then the session has its own settings again."""
    key = spark._jsparkSession.sessionUUID()
    with _WRITERS_LOCK:
        if key not in _WRITERS:
            before = {k: spark.conf.get(k, None) for k in WRITE_CONF}
            for k, v in WRITE_CONF.items():
                if before[k] in (None, "false", "0"):
                    spark.conf.set(k, v)
            _WRITERS[key] = [0, before]
        _WRITERS[key][0] += 1
    try:
        yield
    finally:
        with _WRITERS_LOCK:
            _WRITERS[key][0] -= 1
            if not _WRITERS[key][0]:
                for k, v in _WRITERS.pop(key)[1].items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cut_lineage(df, spark: SparkSession | None = None):
    """The rows written to the shared folder and read back (they survive the
    loss of an executor): compressed, as rows of edges are a fraction of a
    checkpoint's size, which Spark writes plain."""
    from .sources.sinks import LAYER_COMPRESSION
    spark = spark or df.sparkSession
    path = shared_path(spark, "rows")
    with writing(df.sparkSession):
        df.write.option("compression", LAYER_COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def ensure_parallelism(df, min_partitions: int | None = None):
    """Spread rows before CPU-heavy narrow work when far fewer partitions than
    the cluster has cores hold rows, a quarter at most.  A file with one row
    group is one filled split however often it is cut, so splits are counted
    by their rows: the count reads no column (file footers only).  Inputs of
    many splits (eight a core) are returned unchanged without a count.  Meant
    for fresh scans: a plan that already contains exchanges would run them."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < 8 * want and 4 * filled_partitions(df) <= want:
        return df.repartition(want)
    return df


def filled_partitions(df) -> int:
    """Partitions that hold rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never broadcast)."""
    v = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    num = v.rstrip("bkmg")
    unit = v[len(num):] or "b"
    return int(float(num) * _UNITS.get(unit, 1))


def concurrently(*thunks):
    """Run independent Spark actions from separate driver threads (Spark
    schedules jobs of different threads side by side); results in order.
    Useful when each job alone does not fill the cluster."""
    from concurrent.futures import ThreadPoolExecutor
    if len(thunks) <= 1:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=len(thunks), thread_name_prefix="incidex") as pool:
        futures = [pool.submit(t) for t in thunks]
    return [f.result() for f in futures]
