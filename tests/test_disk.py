"""What a layer's build leaves on the disks: shuffle files of finished writes,
exchanges of whole rows, plain checkpoints."""

import glob
import gzip
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from incidex.functions.geometry import curve_key
from incidex.functions.keys import PACK_MARK, PACK_SEP, packed_columns
from incidex.operators.dedup import keep_top_priority, union_sources
from incidex.operators.spatial import zone_cells
from incidex.operators import quality
from incidex.plans import etl
from incidex.plans import pipeline as pl
from incidex.session import WRITE_CONF, concurrently, cut_lineage, shared_path, writing
from incidex.sources import sinks
from incidex.sources.landing import entry_format, heading, landing_files, read_landing
from incidex.sources.versions import VersionedTable


def shuffle_files(spark) -> set[str]:
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for p in places for f in glob.glob(f"{p}/*/shuffle_*.data")}


def left_by(spark, write) -> set[str]:
    before = shuffle_files(spark)
    write()
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_writes_leave_no_shuffle_files(spark):
    df = spark.range(2000).repartition(4).select("id", (F.col("id") % 3).alias("YEAR_INFO"), F.sha2(F.col("id").cast("string"), 256).alias("pay"))
    table = VersionedTable(spark, shared_path(spark, "t"))
    held = {k: spark.conf.get(k) for k in WRITE_CONF}
    for write in (lambda: sinks.write_partitioned(df, shared_path(spark, "w"), "YEAR_INFO"),
                  lambda: table.replace(df, "YEAR_INFO"), lambda: cut_lineage(df.distinct()),
                  lambda: concurrently(*[lambda: pl.materialize(df.distinct(), "m") for _ in range(3)])):
        assert not left_by(spark, write)
        assert {k: spark.conf.get(k) for k in WRITE_CONF} == held
    assert table.read().count() == 2000


def test_a_failed_write_gives_the_settings_back(spark):
    held = {k: spark.conf.get(k) for k in WRITE_CONF}
    with pytest.raises(ValueError):
        with writing(spark), writing(spark):
            assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
            raise ValueError
    assert {k: spark.conf.get(k) for k in WRITE_CONF} == held


def landing(spark, n=400):
    return spark.range(n).selectExpr(
        "concat('Rua ', id % 90) AS LOGRADOURO", "string(id % 90) AS NUMERO_LOGRADOURO", "if(id % 9 = 0, null, 'Centro') AS BAIRRO",
        "concat('-23.', 1000 + id % 90) AS LATITUDE", "concat(' -46.', 1000 + id % 90) AS LONGITUDE",
        "'2020-01-05' AS DATA_OCORRENCIA_BO", "string(1 + id % 9) AS MES", "if(id % 7 = 0, null, string(2015 + id % 4)) AS ANO")


def test_distinct_rows_are_written_from_their_own_exchange(spark):
    for rows, late in (pl.bronze_parts(landing(spark), year_col="ANO"), pl.incident_source_parts(landing(spark), "T")):
        assert planned(sinks.laid_out(rows, ["YEAR_INFO"], late)).count("Exchange ") == 1
        path = shared_path(spark, "spread")
        sinks.write_partitioned(rows, path, "YEAR_INFO", late=late)
        want = late(rows)
        got = spark.read.schema(want.schema).parquet(path).select(want.columns)
        assert want.count() > 90 and not got.exceptAll(want).count() and not want.exceptAll(got).count()


def test_best_priority_is_not_shuffled(spark):
    rng = np.random.default_rng(3)
    frames = [spark.createDataFrame(pd.DataFrame({"k": [None, None, *rng.integers(0, 60, 80)], "t": rng.integers(0, 3, 82)}).astype({"k": "Int64"})
                                    .astype(object).where(lambda d: d.notna(), None), "k long, t long") for _ in range(3)]
    u = union_sources([(f, i + 1) for i, f in enumerate(frames)])
    old, new = keep_top_priority(u, "k", null_keys=False), keep_top_priority(u, "k", null_keys=False, ends=(1, 3))
    assert sorted(map(tuple, new.collect())) == sorted(map(tuple, old.collect()))
    # first branch of the union: no exchange above its scan
    plan = planned(new)
    assert "Exchange" not in plan[plan.index("Union"):plan.index("Join")]


def test_cells_of_a_row_meet_once(spark):
    edges = spark.createDataFrame([("a", 0.0, 0.0, 4.0, 0.0), ("a", 4.0, 0.0, 4.0, 4.0), ("a", 4.0, 4.0, 0.0, 4.0), ("a", 0.0, 4.0, 0.0, 0.0)],
                                  "z string, x1 double, y1 double, x2 double, y2 double")
    assert planned(zone_cells(edges, ["z"], 1.0)).count("Exchange ") == 1


def test_cut_lineage_keeps_rows_and_metadata(spark):
    df = spark.createDataFrame([(1, None, [1.5, None], float("nan")), (1, "ä", None, -0.0), (None, "", [], 2.0)],
                               "a int, b string, c array<double>, d double")
    df = df.withColumn("a", F.col("a").alias("a", metadata={"srid": 7}))
    got = cut_lineage(df)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
    assert got.schema["a"].metadata == {"srid": 7} and got.columns == df.columns


def test_curve_has_no_jumps(spark):
    at = spark.range(64).crossJoin(spark.range(64).withColumnRenamed("id", "b"))
    side = F.lit(1 << 25) / F.lit((1 << 31) - 1)
    x, y = (F.col("id") + 0.5) * side * 360 - 180, (F.col("b") + 0.5) * side * 180 - 90
    rows = at.select("id", "b", x.alias("x"), y.alias("y")).select("id", "b", curve_key("x", "y").alias("k")).orderBy("k").collect()
    assert len({r.k for r in rows}) == 64 * 64
    assert all(abs(a.id - b.id) + abs(a.b - b.b) == 1 for a, b in zip(rows, rows[1:]))
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0)], "x double, y double").select(curve_key("x", "y"))
    assert [r[0] for r in odd.collect()] == [None, None]


def test_layout_by_place_takes_late_columns(spark):
    df = spark.createDataFrame([(f"{i:064x}", i % 2, i / 10, i / 20) for i in range(200)], "ID_CRIME string, YEAR_INFO int, x double, y double")
    rows, late = pl.packed_incidents(df)
    table = VersionedTable(spark, shared_path(spark, "by-place"))
    seen = []
    table.replace(rows, "YEAR_INFO", near=("x", "y"), late=lambda d: (seen.append(planned(d)), late(d))[1])
    assert "Exchange rangepartitioning" in seen[0]       # late: behind the layout's exchange
    assert sorted(table.read().select(df.columns).collect()) == sorted(df.collect())


def test_packed_columns_give_back_every_text(spark):
    texts = [None, "", "a", PACK_SEP, PACK_MARK, PACK_MARK + "0", PACK_MARK + "1", PACK_MARK + "2", PACK_SEP + "1",
             PACK_MARK + PACK_SEP, PACK_MARK + "3FF", "ä" + PACK_SEP * 3, "0", "null"]
    rows = [(a, i % 5 - 2 if i % 4 else None, b, i / 7, 1 << 40) for i, (a, b) in enumerate((a, b) for a in texts for b in texts)]
    df = spark.createDataFrame(rows, "a string, n int, b string, x double, k long")
    broken = df.limit(1).withColumn("a", F.unhex(F.lit("FF1F1E")).cast("string"))      # bytes that are no text
    df = df.unionByName(broken)
    packed, unpack = packed_columns(df, keep=("k",))
    assert packed.columns == ["x", "k", "_row"] and packed.select("_row").distinct().count() == len(rows) + 1
    back = unpack(packed.withColumn("new", F.lit(1)).drop("x"))
    assert back.columns == ["a", "n", "b", "k", "new"] and back.dtypes[:3] == [df.dtypes[0], df.dtypes[1], df.dtypes[2]]
    as_bytes = [F.col("a").cast("binary").alias("a"), "n", F.col("b").cast("binary").alias("b")]
    got, want = (sorted(map(repr, d.select(*as_bytes).collect())) for d in (back, df))
    assert got == want
    one = df.select("a", "x")
    assert packed_columns(one)[0] is one


def test_written_bronze_packs_its_rows(spark):
    rows, late = pl.bronze_parts(landing(spark), year_col="ANO")
    assert rows.columns == ["_row"] and pl.bronze(landing(spark), year_col="ANO").columns == late(rows).columns
    assert not late(rows).exceptAll(pl.bronze(landing(spark), year_col="ANO")).count()


def test_landing_reads_gzip(spark, tmp_path):
    for year, text in ((2020, "RUA;ANO\nSão João;2020\n"), (2021, "ANO;RUA;NOTA\n2021;Sé;x\n")):
        os.makedirs(f"{tmp_path}/y={year}")
        with gzip.open(f"{tmp_path}/y={year}/part.csv.gz", "wt", encoding="windows-1252") as f:
            f.write(text)
    with gzip.open(f"{tmp_path}/y=2021/METODOLOGIA.csv.gz", "wt") as f:
        f.write("CAMPO\nx\n")
    entry = {"input": "y={year}", "format": "csv", "years": [2020, 2021], "skip_parts": ["METODOLOGIA"]}
    found = landing_files(spark, entry, str(tmp_path))
    assert [heading(spark, p, ";", "windows-1252") for p, _ in found] == [("ANO", "RUA", "NOTA"), ("RUA", "ANO")]
    rows = read_landing(spark, entry, str(tmp_path)).select("RUA", "ANO", "NOTA", "YEAR_INFO").collect()
    assert sorted(map(tuple, rows)) == [("São João", "2020", None, 2020), ("Sé", "2021", "x", 2021)]
    assert entry_format({"input": "x/{year}.csv.gz"}) == "csv"


def test_unique_keys_are_counted_by_hash_first(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("b", 1, -0.0), (None, 2, 1.0), (None, 3, 2.0), ("c", None, 3.0)], "k string, n int, x double")
    for unique, bad in (("k", [1]), ("n", [1]), (["k", "n"], [0]), ([["k", "n"], ["n"], ["x"]], [0, 1, 1])):
        plain, probed = (quality.unique_reports(df, "t", unique, probe=p) for p in (False, True))
        assert [r.violations for r in probed.collect()] == bad and plain.collect() == probed.collect() and plain.schema == probed.schema
    assert quality.hashes_differ(df, ["k", "n"]) and not quality.hashes_differ(df, ["x"]) and not quality.hashes_differ(df, ["k"])


def test_the_run_moves_distinct_rows_once(spark, tmp_path, monkeypatch):
    moved = {}

    def seen(run, df, path, entry, not_null, late=None):
        moved[entry["name"]] = planned(sinks.laid_out(df, entry["partition"], late)).count("REBALANCE")
        return stage(run, df, path, entry, not_null, late)
    stage = etl._stage
    monkeypatch.setattr(etl, "_stage", seen)
    out = etl.run_etl(spark, "/root/testdata/sf0.001", f"{tmp_path}/run")
    once = ["bronze_crimes_cellphones", "bronze_crimes_others", "bronze_scs_geom", "silver_crimes_vehicles", "gold_crimes", "gold_crimes_scs"]
    assert [moved[n] for n in once] == [0] * len(once) and moved["silver_crimes"] == 1
    gold, want = out["tables"]["gold_crimes"], pl.gold_incidents(out["tables"]["silver_crimes"].drop("DATE_PROCESSED"))
    assert gold.columns == want.columns and want.count() and not gold.exceptAll(want).count() and not want.exceptAll(gold).count()
