"""Every stage of the corpus pipeline on odd rows: nulls, empty and long texts,
ties, repeated rows, empty tables and columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from incidex.llm import langid
from incidex.llm.minhash import bloom_bits, probably_in

EN = "the cat sat on the mat and looked at the other cat over there while it was raining outside "
DE = "die Katze sitzt auf der Matte und schaut die andere Katze an, während es draußen regnet und stürmt "
BAD = "you awful idiot clown "


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, (EN if i % 2 else DE) + f"Nummer {i} " * 3 + (BAD if i % 5 == 0 else ""), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "½ Ⅷ ①", "de"), (103, EN * 2_000, "en"), (103, EN * 2_000, "en"),
             (104, EN + "one", None), (105, EN + "one", "en"), (None, EN + "null id", "en"), (None, EN + "null id", "en")]
    docs = (spark.createDataFrame(rows, "doc_id long, text string, lang string")
            .withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long")))
    clash = docs.withColumn("_language", F.lit("a")).withColumn("_p", F.lit(1)).withColumn("_key", F.lit("b")) \
                .withColumn("key", F.lit(2)).withColumn("length", F.lit("c"))
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    clash.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    clash.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    return str(tmp_path)


def test_stages_on_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, folder)
        if name != "best_fit_packing":
            assert got.columns == docs.columns
            assert got.where("_language <> 'a' or _p <> 1 or _key <> 'b' or key <> 2 or length <> 'c'").count() == 0
            kept[name] = [r["doc_id"] for r in got.collect()]
        else:
            assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in docs.collect()}
            assert got.where("sequence_id is null or offset is null").count() == 0
        assert stage(spark, docs.limit(0), folder).count() == 0
    assert not {100, 101, 102} & set(kept["language_id"]) and set(range(60)) <= set(kept["language_id"])
    assert not {i for i in range(60) if i % 5 == 0} & set(kept["toxicity"])
    assert {i for i in range(60) if i % 5} | {100, 101} <= set(kept["toxicity"])
    near = kept["minhash_near_dedup"]
    assert {100, 101, 102} <= set(near) and near.count(103) == 1 and (104 in near) and (105 not in near) and near.count(None) == 2


def test_run_on_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


def test_only_letters_have_a_language(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs, "text", "lang")
    for t in ["½ ²", "Ⅷ", "①②", "123", "!?", "", None]:
        assert model.predict(t)[0] == "und"
    assert model.predict("ª")[0] != "und" and model.predict(EN)[0] == "en" and model.predict(DE)[0] == "de"


def shuffled_bytes(plan) -> int:
    """Bytes given to the exchanges of an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_bytes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_bytes(plan.plan())
    own = plan.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_bytes(plan.children().apply(i)) for i in range(plan.children().size()))


@pytest.mark.parametrize("ids", ["once", "repeated"])
def test_near_dedup_shuffles_no_text_that_surely_stays(spark, tmp_path, ids):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(300)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i]) for i in range(6)]   # six copies
    stay = list(enumerate(texts))
    if ids == "repeated":   # one row twice, one id with two texts
        rows += [rows[20], (21, "another text of the same id")]
        stay += [(21, "another text of the same id")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # tables of any size are joined so
    try:
        got = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
        assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted(stay)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert shuffled_bytes(got._jdf.queryExecution().executedPlan()) < sum(len(t) for t in texts) / 4


def test_bit_table_grows_with_its_keys(spark):
    assert [bloom_bits(n) for n in (0, 1, 200_000, 2_000_000, 10**9)] == [22, 22, 22, 25, 26]
    keys = spark.range(0, 2_000_000, 2)
    likely = probably_in("id", keys)
    assert keys.where(~likely).isEmpty()
    assert spark.range(1, 400_000, 2).where(likely).count() < 200_000 / 8    # 22 bits let a fifth pass
