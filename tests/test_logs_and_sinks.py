"""Forward fill, run-log parsing, sinks and the driver contract."""

import os
import tempfile

from pyspark.sql import functions as F

from incidex.operators.logs import LINE_ORDER, forward_fill, line_order, line_time, parse_log_lines, stage_metrics
from incidex.session import shared_path
from incidex.sources import readers, sinks


def test_forward_fill_across_blocks(spark):
    # markers are sparse and not monotone; gaps in the ordering key leave
    # whole blocks empty, so carries must cross several block levels
    rows = [(i * 3, (i * 37) % 101 if i % 11 == 4 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "o long, m long")
    last, want = None, {}
    for o, m in rows:
        last = m if m is not None else last
        want[o] = last
    for block, levels in ((5, 1), (5, 2), (4, 3), (1 << 16, 2)):
        got = {r.o: r.f for r in forward_fill(df, "o", "m", "f", block=block, levels=levels).collect()}
        assert got == want, (block, levels)


LOG = """2031-01-04 07:00:10 - ETL - INFO - ##########  BRONZE: bronze_a/2030
2031-01-04 07:00:11 - ETL - INFO - read_data: 8.25s
2031-01-04 07:00:12 - ETL - INFO - read_data: 4.00s
2031-01-04 07:00:13 - ETL - INFO - treat_data: 0.50s
2031-01-04 07:00:14 - ETL - INFO - write_data: 17.25s
2031-01-04 07:00:15 - ETL - INFO - rows: 1234
2031-01-04 07:00:16 - ETL - INFO - test_data: 6.00s
2031-01-04 07:00:17 - ETL - INFO - ##########  SILVER: silver_b
2031-01-04 07:00:18 - ETL - INFO - read_data: 1.00s
2031-01-04 07:00:19 - ETL - INFO - treat_data_zones: 2.00s
2031-01-04 07:00:20 - ETL - INFO - write_data: 3.00s
2031-01-04 07:00:21 - ETL - INFO - silver_b: 7.75s
"""


def test_stage_metrics_from_text(spark):
    path = shared_path(spark, "log-test")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "20310104_ETL.log"), "w") as fh:
        fh.write(LOG)
    lines = readers.read_text_lines(spark, path)
    m = {r.table_name: r for r in stage_metrics(line_order(parse_log_lines(lines)), LINE_ORDER).collect()}
    a, b = m["bronze_a/2030"], m["silver_b"]
    assert (a.level, a.read_time, a.treat_time, a.write_time, a.test_time, a.row_count) == \
        ("BRONZE", 12.25, 0.5, 17.25, 6.0, 1234)
    assert abs(a.total_time - (12.25 + 0.5 + 17.25)) < 1e-9       # no own total -> fallback
    assert (b.treat_time, b.total_time) == (2.0, 7.75)               # prefix match, own total
    latest = readers.latest_file(lines).collect()
    assert len(latest) == 1 and latest[0].file_path.endswith("_ETL.log")


def test_sections_of_one_second_stay_apart(spark, tmp_path):
    """Lines of one second keep the order of their file, also over several splits."""
    lines = []
    for k in range(200):
        lines += [f"##########  SILVER: t{k}", f"read_data: {k}.00s", f"rows: {k * 5}"]
    with open(tmp_path / "x.log", "w") as fh:
        fh.writelines(f"2025-03-19 19:26:10 - ETL - INFO - {x}\n" for x in lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        read = readers.read_text_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 1
        got = {r.table_name: (r.read_time, r.row_count) for r in
               stage_metrics(line_order(parse_log_lines(read)), LINE_ORDER).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {f"t{k}": (float(k), k * 5) for k in range(200)}


def test_many_lines_of_one_time(spark, tmp_path):
    """Over 1,024 lines of one time, then a line one microsecond later: orders stay unique,
    each section has its own lines and starts at its own time."""
    lines = []
    for k in range(900):
        lines += [f"2025-03-19 19:26:10.000000 - ETL - INFO - ##########  SILVER: t{k}",
                  f"2025-03-19 19:26:10.000000 - ETL - INFO - read_data: {k}.00s"]
    lines += ["2025-03-19 19:26:10.000001 - ETL - INFO - rows: 7",
              "2025-03-19 19:26:10.000001 - ETL - INFO - ##########  SILVER: late",
              "2025-03-19 19:26:10.000001 - ETL - INFO - rows: 8"]
    (tmp_path / "x.log").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        read = readers.read_text_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 1
        ordered = line_order(parse_log_lines(read))
        assert ordered.select(LINE_ORDER).distinct().count() == len(lines)
        got = {r.table_name: (r.read_time, r.row_count, r.at) for r in
               stage_metrics(ordered, LINE_ORDER).withColumn("at", line_time("section_start")).collect()}
        # markers carried over several blocks of one time and from the time before
        marked = ordered.withColumn("m", F.when(F.col("section") == "t3", F.lit(3)))
        for block, levels in ((7, 2), (100, 3), (1 << 16, 3)):
            assert forward_fill(marked, LINE_ORDER, "m", "f", block, levels).where("f = 3").count() == len(lines) - 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    at = got["t0"][2]
    assert got == {f"t{k}": (float(k), 7 if k == 899 else 0, at) for k in range(900)} | {"late": (0.0, 8, at + 1)}


def test_partition_roundtrip_keeps_string_ids(spark):
    path = shared_path(spark, "sink-test")
    df = spark.createDataFrame([(1, 2024, "0350"), (2, 2024, "0351"), (3, 2023, "0350")],
                               "id int, YEAR_INFO int, ID_MUN string")
    sinks.write_partitioned(df, path, ["YEAR_INFO", "ID_MUN"], max_records=1)
    sinks.write_partitioned(df.where("YEAR_INFO = 2024"), path, ["YEAR_INFO", "ID_MUN"], only_partitions=True)  # idempotent
    back = readers.read_partitioned(spark, path, df.schema)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    pruned = readers.read_partitioned(spark, path, df.schema, F.col("YEAR_INFO") == 2023)
    assert "PartitionFilters: [isnotnull(YEAR_INFO" in pruned._jdf.queryExecution().executedPlan().toString() \
        or pruned.count() == 1


def test_windows_1252_csv(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(os.path.join(d, "a.csv"), "wb") as fh:
        fh.write("CD_SETOR;NM_MUN\n0350;São Paulo – SP\n".encode("cp1252"))
    rows = readers.read_delimited(spark, d).collect()
    assert rows[0].CD_SETOR == "0350" and rows[0].NM_MUN == "São Paulo – SP"


def test_geojson_features(spark):
    import json
    df = spark.createDataFrame([(1, [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0},
                                      {"x": 0.0, "y": 0.0}]])],
                               "id int, rings array<array<struct<x:double,y:double>>>")
    f = json.loads(sinks.geojson_features(df).first().value)
    assert f["type"] == "Feature" and f["geometry"]["type"] == "Polygon"
    assert f["geometry"]["coordinates"][0][1] == [1.0, 0.0] and f["properties"] == {"id": 1}


def test_driver_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:3] == ["zone_id", "yr", "total"]
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    from incidex.plans.catalog import QUERIES
    assert set(QUERIES) - set(s) == set()


def test_full_overwrite_leaves_no_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, YEAR_INFO int")
    sinks.write_partitioned(df, path, "YEAR_INFO")
    sinks.write_partitioned(df.where("YEAR_INFO = 2024"), path, "YEAR_INFO")
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [2]


def test_gold_counts_keep_unlisted_types(spark):
    from incidex.plans.pipeline import sector_rates
    silver = spark.createDataFrame([("a", "s", 2024, "FURTO_ROUBO_DE_CELULAR"), ("b", "s", 2024, "NOT_IN_THE_LIST"),
                                    ("c", "s", 2024, None)], "ID_CRIME string, ID_SC string, YEAR_INFO int, CRIMINAL_TYPE_TREATED string")
    zones = spark.createDataFrame([("s", 100, 2022)], "ID_SC string, POP_TOTAL int, YEAR_INFO int")
    row = sector_rates(silver, zones).first()
    assert (row["TOTAL_CRIMES"], row["FURTO_ROUBO_DE_CELULAR"], row["OTHER_TYPES"]) == (3, 1, 2)


def test_landing_folders_are_written_in_a_session_without_the_charset_flag(spark, tmp_path):
    from conftest import SF
    from incidex.sources.landing import read_landing
    from incidex.plans import fixtures as fx
    from incidex.plans.catalog import write_landing
    flag, was = "spark.sql.legacy.javaCharsets", spark.conf.get("spark.sql.legacy.javaCharsets")
    spark.conf.set(flag, "false")
    try:
        spec = write_landing(spark, SF, str(tmp_path))
        for source in ("cellphones", "vehicles", "others"):
            got = read_landing(spark, spec["tables"][f"bronze_crimes_{source}"], spec["base"])
            given = fx.raw_incidents(spark, SF, source)
            assert sorted(map(tuple, got.select(given.columns).collect()), key=repr) == sorted(map(tuple, given.collect()), key=repr)
    finally:
        spark.conf.set(flag, was)


def test_landing_rows_are_not_broadcast(spark, tmp_path):
    from incidex.sources.landing import read_landing
    spark.range(50).select(F.col("id").cast("string").alias("v")).write.parquet(f"{tmp_path}/y=2020")
    got = read_landing(spark, {"input": "y={year}", "format": "parquet", "years": [2020]}, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 50 and "BuildRight" in plan and "BuildLeft" not in plan
