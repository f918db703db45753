"""Filters, keys, pivot, rates, de-dup, column shaping, quality rules."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from incidex.functions.dates import assemble_date, day_with_default
from incidex.functions.keys import entity_key, row_fingerprint
from incidex.operators import quality
from incidex.operators.aggregate import pivot_counts, total_and_type_counts
from incidex.operators.classify import INCIDENT_CLASSES, classify
from incidex.operators.columns import drop_suffix_columns, drop_void_columns
from incidex.operators.dedup import keep_top_priority, rank_top_priority, union_sources
from incidex.operators.rates import rate_index
from incidex.plans.pipeline import REDACTION_PATTERN, in_state

SF = "/root/testdata/sf0.001"


def test_state_filter_coercion(spark):
    df = spark.createDataFrame([(v,) for v in ["35", "035", " 35", "35.0", "33", "x", None]], "CD_UF string")
    kept = sorted(r.CD_UF for r in df.where(in_state()).collect())
    assert kept == [" 35", "035", "35", "35.0"]


def test_redaction_filter_drops_nulls(spark):
    vals = ["VEDAÇÃO DA DIVULGAÇÃO DOS DADOS", "vedação da divulgação", None, "RUA A"]
    df = spark.createDataFrame([(v,) for v in vals], "a string")
    kept = [r.a for r in df.where(~F.col("a").like(REDACTION_PATTERN)).collect()]
    assert sorted(kept) == ["RUA A", "vedação da divulgação"]


def test_entity_key_skips_nulls_and_fingerprint_does_not(spark):
    df = spark.createDataFrame([("A", None, "B"), ("A", "B", None)], "a string, b string, c string")
    keys = [r.k for r in df.select(entity_key(["a", "b", "c"]).alias("k")).collect()]
    assert keys[0] == keys[1]
    fps = [r.k for r in df.select(row_fingerprint(["a", "b", "c"]).alias("k")).collect()]
    assert fps[0] != fps[1]


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-15 10:00:00", 30, 2, 2021), ("15/01/2024", 5, 1, 2024), (None, 1, 13, 2020)],
                               "s string, d int, m int, y int")
    out = df.select(day_with_default("s").alias("day"), assemble_date("d", "m", "y").alias("dt")).collect()
    assert [r.day for r in out] == [15, 1, 1]
    assert [r.dt for r in out] == [None, "2024-01-05 00:00:00", None]


def test_classify_and_unknown(spark):
    df = spark.createDataFrame([("LATROCINIO",), ("FURTO_ROUBO_DE_CELULAR",), ("ALGO",), (None,)], "t string")
    got = [r.c for r in df.select(classify("t").alias("c")).collect()]
    assert got == [INCIDENT_CLASSES["LATROCINIO"], "ROUBO E FURTO", "OUTROS", "OUTROS"]
    assert got[0] == "HOMICÍDIO"


@pytest.fixture()
def incidents(spark):
    rows = [("z1", 2021, 1, "A"), ("z1", 2021, 2, "A"), ("z1", 2021, 3, None), ("z1", 2021, 4, "C"),
            ("z2", 2022, 5, "B"), ("z2", 2022, None, "B")]
    return spark.createDataFrame(rows, "zone string, yr int, id int, ty string")


def test_total_and_type_counts(incidents):
    out = {(r.zone, r.yr): r for r in total_and_type_counts(
        incidents, ["zone", "yr"], "id", "ty", ["A", "B"], total_name="total", other_name="other").collect()}
    z1 = out[("z1", 2021)]
    assert (z1.total, z1.A, z1.B, z1.other) == (4, 2, None, 2)   # absent type -> NULL
    z2 = out[("z2", 2022)]
    assert (z2.total, z2.A, z2.B) == (1, None, 2)                # count(id) skips NULL ids


def test_pivot_matches_single_aggregate(incidents):
    a = sorted(pivot_counts(incidents, ["zone", "yr"], "ty", ["A", "B"]).collect())
    b = sorted(total_and_type_counts(incidents, ["zone", "yr"], "id", "ty", ["A", "B"])
               .drop("TOTAL").collect())
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_single_aggregate_has_one_exchange(incidents):
    plan = total_and_type_counts(incidents, ["zone", "yr"], "id", "ty", ["A", "B"])._jdf \
        .queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1


def test_rate_index_guards(spark):
    rows = [(2021, 10, 100), (2022, 10, 100), (2022, 10, 0), (2022, 10, None), (2022, None, 100)]
    df = spark.createDataFrame(rows, "yr int, n long, pop int")
    out = [r.v for r in df.select(rate_index("n", "pop", 1000, "yr", 2022).alias("v")).collect()]
    assert out == [None, 100.0, 0.0, 0.0, 0.0]
    unguarded = [r.v for r in df.select(rate_index("n", "pop", 1000).alias("v")).collect()]
    assert unguarded[0] == 100.0


def test_priority_dedup_keeps_ties(spark):
    a = spark.createDataFrame([("k1", "x"), ("k2", "x")], "id string, t string")
    b = spark.createDataFrame([("k1", "y"), ("k1", "z"), ("k3", "y")], "id string, t string")
    u = union_sources([(b, 2), (a, 1)])
    got = sorted((r.id, r.t) for r in keep_top_priority(u, "id").collect())
    assert got == [("k1", "x"), ("k2", "x"), ("k3", "y")]
    c = spark.createDataFrame([("k4", "p"), ("k4", "q")], "id string, t string")
    u2 = union_sources([(c, 3), (b, 3)])
    ties = sorted((r.id, r.t) for r in keep_top_priority(u2, "id").collect())
    assert ties == sorted((r.id, r.t) for r in rank_top_priority(u2, "id").collect())
    assert ("k4", "p") in ties and ("k4", "q") in ties
    # the per-key table grows with the data: never broadcast, even when tiny
    plan = keep_top_priority(u2, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "ShuffledHashJoin" in plan


def test_union_by_name_allows_missing(spark):
    a = spark.createDataFrame([(1, "a")], "x int, y string")
    b = spark.createDataFrame([(2, 3.0)], "x int, z double")
    out = union_sources([(a, 1), (b, 2)]).orderBy("x").collect()
    assert out[0].z is None and out[1].y is None


def test_drop_suffix_and_void(spark):
    df = spark.sql("SELECT 1 AS `c`, 2 AS `c.1`, 3 AS `c.10`, NULL AS void, 'v' AS d")
    assert isinstance(df.schema["void"].dataType, NullType)
    assert drop_void_columns(drop_suffix_columns(df)).columns == ["c", "d"]


def test_quality_rules(spark):
    rows = [(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (3, "c", None), (3, "c", "z")]
    df = spark.createDataFrame(rows, "id int, k string, v string")
    rep = {(r.rule, r.columns): r.violations for r in
           quality.quality_report(df, "t", unique=[["id"], ["id", "k"]], not_null=["k", "v"]).collect()}
    assert rep[("row_count", "")] == 5
    assert rep[("unique", "id")] == 2
    assert rep[("unique", "id,k")] == 1
    assert rep[("not_null", "k")] == 1 and rep[("not_null", "v")] == 1
    with pytest.raises(AssertionError):
        quality.assert_quality(quality.quality_report(df, "t", unique="id", not_null="k"))
    clean = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    quality.assert_quality(quality.quality_report(clean, "clean", unique="id", not_null=["id", "k"]))


def test_quality_report_reads_the_table_once_per_aggregate(spark):
    """Row count + all NULL counts: one scan; each unique key: one scan."""
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    rep = quality.quality_report(df, "lineitem", unique=[["l_orderkey", "l_linenumber"], ["l_partkey"]],
                                 not_null=["l_orderkey", "l_partkey", "l_suppkey", "l_tax"])
    plan = rep._jdf.queryExecution().executedPlan().toString()        # not executed: initial plan only
    assert plan.count("FileScan parquet") == 3


def test_population_rollup_and_sector_population_with_suppressed_cells(spark):
    """Q3/Q4: suppressed cells ('X') count as NULL in the sum, never raise under
    ANSI; both population columns are INT; out-of-state rows are left out."""
    from incidex.operators.aggregate import population_rollup
    from incidex.plans.pipeline import municipality_population, sector_population
    demo = spark.createDataFrame(
        [("s1", "m1", "35", "10"), ("s2", "m1", "035", "X"), ("s3", "m1", "35.0", "5"),
         ("s4", "m2", "33", "7"), ("s5", "m2", " 35", None)],
        "CD_SETOR string, CD_MUN string, CD_UF string, v0001 string")
    roll = {r.CD_MUN: r.POP_TOTAL for r in population_rollup(demo, "CD_MUN", "v0001").collect()}
    assert roll == {"m1": 15, "m2": 7}
    mun = {r.ID_MUN: r.POP_TOTAL for r in municipality_population(demo).collect()}
    assert mun == {"m1": 15, "m2": None}                     # m2's only in-state cell is NULL
    sec = sector_population(demo)
    assert dict(sec.dtypes)["POP_TOTAL"] == "int"
    assert {r.ID_SC: r.POP_TOTAL for r in sec.collect()} == {"s1": 10, "s2": None, "s3": 5, "s5": None}


def test_rejects_work_out_each_coordinate_once(spark):
    from incidex.plans.pipeline import incident_rejects
    rows = [("Rua A", "-46.5", "-23.5"), (None, "-465", "-235"), ("VEDAÇÃO DA DIVULGAÇÃO", "-46.5", "-23.5"),
            ("Rua B", None, "-23.5"), (None, "abc", "-23.5")]
    got = incident_rejects(spark.createDataFrame(rows, "LOGRADOURO string, LONGITUDE string, LATITUDE string"), "s")
    assert got.columns == ["source", "reason", "n"]
    assert sorted(map(tuple, got.collect())) == [("s", "coordinate", 2), ("s", "no_address", 1), ("s", "redacted", 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "regexp_replace(" in line for line in plan.splitlines())
    assert incident_rejects(spark.createDataFrame(rows[:1], "LOGRADOURO string, LONGITUDE string, LATITUDE string"), "s").collect() == []


def test_packed_keys_stay_apart_and_come_back(spark):
    from incidex.functions.keys import packed_key, unpacked_key
    digest = "0af9" * 16
    texts = [digest, digest.upper(), digest[:63], digest + "00", "z" * 64, "a" * 31, "a" * 32, "a" * 33, "ã" * 16, "", "0af9", "\x00", None]
    df = spark.createDataFrame([(t,) for t in texts], "ID string").select("ID", packed_key("ID").alias("k"))
    rows = df.select("ID", "k", unpacked_key("k").alias("back")).collect()
    assert [r.back for r in rows] == texts
    assert len({None if r.k is None else bytes(r.k) for r in rows}) == len(texts)
    assert len(rows[0].k) == 32


def grouped_by(df):
    """Keys of the plan's aggregates: what their exchanges carry."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line.split("Aggregate [")[1].split("], [")[0] for line in plan.splitlines() if "Aggregate [" in line]


def test_keys_are_made_behind_the_exchanges(spark):
    from incidex.plans import pipeline as pl
    raw = spark.createDataFrame([("Rua A", "1", "Sé", "-23.5", "-46.5", "2020-01-02 10:30:00", "1", "2020")] * 2
                                + [("Rua A", "1", None, "-23.5", "-46.5", "2020-01-02 10:30:00", "1", "2020"),
                                   ("Rua A", "1", "Sé", "-235", "-46.5", "2020-01-02 10:30:00", "1", "2020")],
                                "LOGRADOURO string, NUMERO_LOGRADOURO string, BAIRRO string, LATITUDE string, LONGITUDE string,"
                                "DATA_OCORRENCIA_BO string, MES string, ANO string")
    bronze = pl.bronze(raw, year_col="ANO")
    assert bronze.columns == [*raw.columns, "ID", "YEAR_INFO"] and bronze.count() == 3
    assert "ID" not in pl.bronze_parts(raw, year_col="ANO")[0].columns and "ID#" not in "".join(grouped_by(bronze))
    source = pl.incident_source(raw, crime_type=pl.CELLPHONE_TYPE)
    # the coordinate of the last row is the same number, written -23.5 after its repair
    assert source.columns == pl.SOURCE_COLUMNS and source.count() == 2
    assert "ID" not in pl.incident_source_parts(raw, "T")[0].columns and "ID#" not in "".join(grouped_by(source))
    signed = spark.createDataFrame([("a", 0.0), ("a", -0.0)], "t string, v double")
    assert pl.bronze(signed).count() == 2                  # equal numbers with fingerprints of their own


def test_late_columns_of_a_written_table(spark):
    from incidex.session import shared_path
    from incidex.sources import sinks
    from incidex.sources.versions import VersionedTable
    df = spark.createDataFrame([(1, 2020), (2, 2021), (3, None)], "n int, YEAR_INFO int")

    def late(d):
        return d.withColumn("twice", F.col("n") * 2).select("twice", "YEAR_INFO")
    path = shared_path(spark, "late")
    sinks.write_partitioned(df, path, "YEAR_INFO", late=late)
    table = VersionedTable(spark, shared_path(spark, "late"))
    table.replace(df, "YEAR_INFO", late=late)
    for got in (spark.read.parquet(path), table.read()):
        assert sorted((r.twice, r.YEAR_INFO) for r in got.collect()) == [(2, 2020), (4, 2021), (6, None)]
    assert table.read().columns == ["twice", "YEAR_INFO"]
