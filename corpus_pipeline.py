"""Corpus pipeline: language ID, toxicity, near-duplicates, packing.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from incidex.llm import langid, toxicity
from incidex.llm.common import table, workers_find_package, write_shared
from incidex.llm.minhash import near_duplicates, probably_in
from incidex.llm.packing import pack_documents
from incidex.llm.queries import TOXIC_FROM, tokenizer_path, toxicity_categories

SIMILARITY_PERCENT = 80
CAPACITY = 2048
REMEMBERED_BYTES = 96 << 20    # of encoded words a worker: it has served three stages before


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from all rows with a language.

    Null and empty texts and texts without letters have no language and go;
    without rows to learn from, every document goes.  Repeated rows are judged
    alike; ids and other columns play no part."""
    workers_find_package(spark)
    model = langid.fit(docs, "text", "lang")
    return docs.where(~langid.predict_language("text", model).getField("rejected"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic.

    Null and empty texts get the base rate of the labels, and without labels
    every text has probability 0: all stay.  Repeated rows are judged alike;
    rows with a null id are judged but do not train."""
    workers_find_package(spark)
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", toxicity_categories())
    return docs.where(toxicity.predict_toxicity("text", chain).getField("toxic") < TOXIC_FROM)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id.

    Rows of one id with different texts are documents of their own, ordered by
    the text's SHA-1; of rows with equal id and text the smallest stays.  Rows
    with a null id, a null text or a text without words all stay (the latter
    two once an id)."""
    workers_find_package(spark)
    name = "key"      # of the helper column: no column of the documents
    while name in docs.columns:
        name += "_"
    named = docs.where("doc_id is not null")
    repeated = not named.groupBy("doc_id").count().where("count > 1").isEmpty()
    if repeated:
        # text keys in the order of the ids; sha1 tells the texts of one id apart
        key = "doc_id"
        if isinstance(docs.schema["doc_id"].dataType, IntegralType):
            key = "lpad(hex(CAST(doc_id AS BIGINT) ^ (-9223372036854775807L - 1)), 16, '0')"
        named = named.withColumn(name, F.expr(f"concat({key}, char(0), sha1(coalesce(text, '')))"))
    else:
        named = named.withColumn(name, F.col("doc_id"))
    found = write_shared(near_duplicates(named, name, "text", SIMILARITY_PERCENT), "classes")
    # rows surely of no dropped and no repeated key stay where they are: only the others' texts are shuffled
    dropped = found.where("not kept").select(name)
    touched = dropped
    if repeated:
        touched = write_shared(dropped.union(found.groupBy(name).count().where("count > 1").select(name)), "touched")
    likely = probably_in(name, touched)
    stay = named.where(likely).join(dropped, name, "left_anti")
    if repeated:
        stay = stay.groupBy(name).agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*")
    return (named.where(~likely).select(docs.columns).union(stay.select(docs.columns))
            .union(docs.where("doc_id is null")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and offset.

    A null or empty text is its end token alone; null ids and repeated rows
    are packed like any other; an empty table gives no piece."""
    workers_find_package(spark)
    return pack_documents(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"), CAPACITY,
                          remembered=REMEMBERED_BYTES)


STAGES = [("language_id", language_id), ("toxicity", toxicity_filter),
          ("minhash_near_dedup", near_dedup), ("best_fit_packing", packing)]

# the classifiers and the tokenizer cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
