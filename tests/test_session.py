"""Session helpers: broadcast threshold parsing and concurrent actions."""

import pyarrow as pa
import pyarrow.parquet as pq

from incidex.session import broadcast_threshold, concurrently, ensure_parallelism, filled_partitions


def test_broadcast_threshold_units(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key, None)
    try:
        for value, want in (("10485760", 10 << 20), ("10485760b", 10 << 20), ("10MB", 10 << 20),
                            ("64m", 64 << 20), ("1g", 1 << 30), ("-1", -1)):
            spark.conf.set(key, value)
            assert broadcast_threshold(spark) == want, value
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def test_concurrent_actions_keep_order(spark):
    counts = concurrently(*[(lambda n=n: spark.range(n).count()) for n in (3, 1, 2)])
    assert counts == [3, 1, 2]


def test_one_row_group_of_many_splits_is_spread(spark, tmp_path):
    """Splits of a file with one row group: one holds the rows, the others none."""
    path = f"{tmp_path}/one.parquet"
    pq.write_table(pa.table({"s": [f"{i:064d}" * 4 for i in range(20_000)]}), path, compression="none", use_dictionary=False)
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "1m")
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= 4 and filled_partitions(df) == 1
        want = df.rdd.getNumPartitions()
        assert filled_partitions(ensure_parallelism(df, want)) == want
        assert ensure_parallelism(df, 3) is df          # a third of the tasks hold rows
    finally:
        spark.conf.set(key, old)
