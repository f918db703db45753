"""Per-year refresh: only changed partitions are rebuilt."""

import pytest
from pyspark.sql import functions as F

from incidex.plans.refresh import changed_partitions, refresh
from incidex.session import shared_path
from incidex.sources.versions import VersionedTable


def test_only_changed_years_are_rebuilt(spark):
    root = shared_path(spark, "refresh")
    source, target = VersionedTable(spark, f"{root}/s"), VersionedTable(spark, f"{root}/t")
    seen = []

    def build(df):
        seen.append(sorted(r[0] for r in df.select("YEAR_INFO").distinct().collect()))
        return df.groupBy("YEAR_INFO").agg(F.sum("n").alias("n")).where("n > 0").select("n", "YEAR_INFO")

    def rows(*values):
        return spark.createDataFrame(values, "n int, YEAR_INFO int")

    def now():
        return {r.YEAR_INFO: r.n for r in target.read().collect()}
    assert refresh(source, target, build, "YEAR_INFO") == [] and target.manifest() is None
    source.replace(rows((1, 2022), (2, 2022), (5, 2023), (7, 2024)), "YEAR_INFO")
    assert refresh(source, target, build, "YEAR_INFO") == ["YEAR_INFO=2022", "YEAR_INFO=2023", "YEAR_INFO=2024"]
    files = {y: set(target.read(names=[f"YEAR_INFO={y}"]).inputFiles()) for y in (2022, 2023)}
    source.replace(rows((9, 2024)), "YEAR_INFO", keep="all")
    assert refresh(source, target, build, "YEAR_INFO") == ["YEAR_INFO=2024"]
    assert now() == {2022: 3, 2023: 5, 2024: 16} and seen == [[2022, 2023, 2024], [2024]]
    assert files == {y: set(target.read(names=[f"YEAR_INFO={y}"]).inputFiles()) for y in (2022, 2023)}
    assert refresh(source, target, build, "YEAR_INFO") == [] and len(seen) == 2
    # a year without rows in the target any more, and one that the source lost
    source.replace(rows((0, 2022)), "YEAR_INFO", keep="untouched")
    source.publish(source.stage(rows(), "YEAR_INFO"), keep="untouched", drop=["YEAR_INFO=2023"])
    assert refresh(source, target, build, "YEAR_INFO") == ["YEAR_INFO=2022", "YEAR_INFO=2023"]
    assert now() == {2024: 16} and changed_partitions(source, target)[0] == []
    source.replace(rows((1, 2025)), "YEAR_INFO", keep="all")
    with pytest.raises(ValueError, match="did not change"):
        refresh(source, target, lambda df: df.withColumn("YEAR_INFO", F.lit(2024)), "YEAR_INFO")
    assert now() == {2024: 16}
