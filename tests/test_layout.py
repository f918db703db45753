"""Rows laid out by place: a map window reads few files."""

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from incidex.functions.geometry import place_key
from incidex.session import shared_path
from incidex.sources.versions import VersionedTable


def python_key(x, y):
    def place(v, limit):
        return int(min(1.0, max(0.0, (v + limit) / (2 * limit))) * ((1 << 31) - 1))
    a, b = place(x, 180.0), place(y, 90.0)
    return sum(((a >> i & 1) << 2 * i) | ((b >> i & 1) << (2 * i + 1)) for i in range(31))


def test_place_key(spark):
    points = [(0.0, 0.0), (-180.0, -90.0), (180.0, 90.0), (-46.6333, -23.5505), (500.0, -500.0)]
    df = spark.createDataFrame([*points, (None, 1.0), (float("nan"), 1.0)], "x double, y double")
    got = [r[0] for r in df.coalesce(1).select(place_key("x", "y")).collect()]
    assert got == [python_key(*p) for p in points] + [None, None]


def test_a_window_reads_few_files(spark):
    rng = np.random.default_rng(2)
    n = 20_000
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": rng.uniform(-50, -45, n), "y": rng.uniform(-25, -20, n),
                                             "YEAR_INFO": rng.integers(2022, 2024, n)})).repartition(8)
    table = VersionedTable(spark, shared_path(spark, "by-place"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.replace(df, "YEAR_INFO", near=("x", "y"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = [f.removeprefix("file://") for f in table.read().inputFiles()]
    box = {"x": (-48.0, -47.5), "y": (-23.0, -22.5)}

    def meets(path):
        meta = pq.read_metadata(path)
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in box}
            if all(stats[c].min <= hi and stats[c].max >= lo for c, (lo, hi) in box.items()):
                return True
        return False
    assert len(files) >= 20 and sum(map(meets, files)) <= len(files) // 4
    window = table.read().where(" AND ".join(f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in box.items()))
    want = df.where(F.col("x").between(*box["x"]) & F.col("y").between(*box["y"]))
    assert sorted(r.id for r in window.collect()) == sorted(r.id for r in want.collect())
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(x,-48.0)" in plan and table.read().count() == n
