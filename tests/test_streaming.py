"""Incremental bronze ingestion: exactly-once appends, cross-batch de-dup, resume."""

import os

from incidex.session import shared_path
from incidex.streaming import ingest
from incidex.streaming.ingest import append_batch, ingest_landing
from incidex.sources.versions import VersionedTable

SCHEMA = "ADDR string, `ADDR.1` string, ANO string"


def kept(table):
    return sorted(((r.ADDR, r.YEAR_INFO) for r in table.read().collect()), key=repr)


def test_incremental_bronze(spark):
    root = shared_path(spark, "stream-test")
    first = spark.createDataFrame([("a", "a", "2023"), ("b", "b", "2023"), ("b", "b", "2023"), ("n", "n", None)], SCHEMA)
    first.write.parquet(f"{root}/landing/2023")
    table = ingest_landing(spark, f"{root}/landing/*", first.schema, f"{root}/bronze", f"{root}/ck", year_col="ANO")
    # a later file repeats records (one without a year) and adds a new year
    spark.createDataFrame([("b", "b", "2023"), ("c", "c", "2024"), ("n", "n", None), ("n", "n", "y")], SCHEMA) \
         .write.parquet(f"{root}/landing/2024")
    ingest_landing(spark, f"{root}/landing/*", first.schema, f"{root}/bronze", f"{root}/ck", year_col="ANO")
    assert sorted(table.read().columns) == ["ADDR", "ANO", "ID", "YEAR_INFO"]
    assert kept(table) == [("a", 2023), ("b", 2023), ("c", 2024), ("n", None), ("n", None)]
    # no streaming state beside the offsets; another stream over the same files adds nothing
    assert not os.path.exists(f"{root}/ck/state".removeprefix("file:"))
    ingest_landing(spark, f"{root}/landing/*", first.schema, f"{root}/bronze", f"{root}/ck2", year_col="ANO")
    assert table.read().count() == 5


def test_a_batch_run_again_changes_nothing(spark, monkeypatch):
    table = VersionedTable(spark, shared_path(spark, "stream-test"))
    batch = spark.createDataFrame([("a", "a", "2023"), ("b", "b", "2024")], SCHEMA)
    more = spark.createDataFrame([("b", "b", "2024"), ("c", "c", "2024")], SCHEMA)
    assert append_batch(table, batch, 0, "s", "ANO")
    # stopped between the write and the manifest: the rows are not part of the table
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        try:
            append_batch(table, more, 1, "s", "ANO")
        except OSError:
            pass
    assert kept(table) == [("a", 2023), ("b", 2024)]
    assert append_batch(table, more, 1, "s", "ANO")
    assert not append_batch(table, more, 1, "s", "ANO") and not append_batch(table, batch, 0, "s", "ANO")
    assert kept(table) == [("a", 2023), ("b", 2024), ("c", 2024)] and table.numbers() == [1, 2]


def test_only_touched_years_are_read_and_small_batches_are_put_together(spark, monkeypatch):
    monkeypatch.setattr(ingest, "COMPACT_AFTER", 2)
    table = VersionedTable(spark, shared_path(spark, "stream-test"))
    asked = []
    read = VersionedTable.read
    monkeypatch.setattr(VersionedTable, "read", lambda self, number=None, names=None: asked.append(names) or read(self, number, names))
    for i in range(4):
        rows = [(str(i), str(i), "2023"), ("same", "same", "2023")] + ([("old", "old", "2001")] if i == 0 else [])
        append_batch(table, spark.createDataFrame(rows, SCHEMA), i, "s", "ANO")
    assert all(names == ["YEAR_INFO=2023"] for names in asked)
    assert kept(table) == sorted([(str(i), 2023) for i in range(4)] + [("same", 2023), ("old", 2001)], key=repr)
    folders = table.manifest()["folders"]
    assert len(folders["YEAR_INFO=2023"]) == 2 and len(folders["YEAR_INFO=2001"]) == 1
    assert table.manifest()["note"] == {"s": 3}
