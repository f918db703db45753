"""The registered queries of this subpackage: thin contracts over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidex.llm import langid, quality, toxicity
from incidex.llm.ann import nearest
from incidex.llm.bpe import bpe_round_trip
from incidex.llm.chat import CONTROL, PrefixTree
from incidex.llm.common import table, workers_find_package
from incidex.llm.embed_dedup import near_duplicate_vectors
from incidex.llm.lexical import ranked_search
from incidex.llm.minhash import near_duplicates
from incidex.llm.negatives import hard_negatives
from incidex.llm.packing import pack_documents
from incidex.llm.token_counts import token_count
from incidex.llm.warc import archive_records


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_adaptive_scan(spark: SparkSession, sf_dir: str, k: int = 20) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    workers_find_package(spark)
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k)


def op2_minhash(spark: SparkSession, sf_dir: str, percent: int = 85) -> DataFrame:
    """Near-duplicate classes of all documents at a similarity of 85 percent."""
    workers_find_package(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", percent)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those not held out."""
    workers_find_package(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = langid.fit(docs.where("not held_out"), "text", "lang")
    return (docs.select("doc_id", "held_out", langid.predict_language("text", model).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.rejected"))


TOXIC_FROM = 0.5


def toxicity_categories() -> dict:
    """The chain's categories in order, from the columns of ``labels``."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def op4_grid_order_join(spark: SparkSession, sf_dir: str, cosine: float = 0.98) -> DataFrame:
    """Links and classes of near-duplicate vectors of equal label."""
    workers_find_package(spark)
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", cosine)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the chain's categories for all documents."""
    workers_find_package(spark)
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", toxicity_categories())
    return (docs.select("doc_id", toxicity.predict_toxicity("text", chain).alias("p"))
            .select("doc_id", F.col("p.low_quality").alias("p_low_quality"), F.col("p.toxic").alias("p_toxic"),
                    (F.col("p.toxic") >= TOXIC_FROM).alias("toxic"), (F.col("p.toxic") < TOXIC_FROM).alias("kept")))


def op6_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, read back from the prefix tree."""
    workers_find_package(spark)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role"))
                                                      for i, r in enumerate(("user", "assistant"))])).alias("x"))
    extra = extra.select(F.lit(-1).cast("long").alias("conv_id"), F.col("x.turn").cast("long").alias("turn"), "x.role",
                         F.lit(hard).alias("text"))
    return PrefixTree(rows.union(extra)).read_back()


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    workers_find_package(spark)
    return archive_records(table(spark, sf_dir, "pages"), "page_id", "url", "html")


def op8_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None,
                     limit: int = 512) -> DataFrame:
    """Token counts of all documents under the byte-level vocabulary."""
    workers_find_package(spark)
    text = F.coalesce("text", F.lit(""))
    return (table(spark, sf_dir, "documents")
            .select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                    token_count(F.col("text"), tokenizer or tokenizer_path("byte_bpe_50k.json")).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None,
                         capacity: int = 2048) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    workers_find_package(spark)
    return pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text",
                          tokenizer or tokenizer_path("word_bpe_49k.json"), capacity, end_id=0)


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents encoded to token ids and decoded again."""
    workers_find_package(spark)
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    return (table(spark, sf_dir, "documents")
            .select("doc_id", bpe_round_trip(F.col("text"), path).alias("r"))
            .select("doc_id", F.size("r.ids").cast("long").alias("n_tokens"),
                    F.sha2(F.concat_ws(",", F.col("r.ids").cast("array<string>")), 256).alias("ids_sha256"),
                    F.sha2(F.encode("r.text", "UTF-8"), 256).alias("decoded_sha256")))


QUALITY_FROM = 0.7


def op11_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from those not held out."""
    workers_find_package(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = quality.fit(docs, labels, "doc_id", "text", F.col("quality") == 1)
    return (docs.select("doc_id", held_out.alias("held_out"), quality.predict_quality("text", model).alias("score"))
            .withColumn("predicted", (F.col("score") >= QUALITY_FROM).cast("int")))


def op12_ranked_search(spark: SparkSession, sf_dir: str, k: int = 50) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    workers_find_package(spark)
    return ranked_search(table(spark, sf_dir, "documents"), "doc_id", "text",
                         table(spark, sf_dir, "benchmark"), "item_id", "text", k)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50."""
    workers_find_package(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_adaptive_scan, op2_minhash, op3_language_id, op4_grid_order_join, op5_toxicity, op6_chat_prefix_tree, op7_warc, op8_token_counts, op9_best_fit_packing, op10_bpe_round_trip,
                                  op11_quality_model, op12_ranked_search, op13_hard_negatives)}

# shingles as lists of words; candidate pairs share a shingle; closure by recursion
OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4])) END AS s
  FROM words),
n AS (SELECT doc_id, len(s) AS n FROM sets),
rows AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM rows a JOIN rows b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM n
  UNION
  SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.node),
comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN comp c ON c.node = n.doc_id
"""

OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM v
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp ON node = vec_id
"""

OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(regexp_replace(text, '@CONTROL@', '\1\\\2\3', 'g'))
    + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 18 ELSE 6 END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
""".replace("@CONTROL@", CONTROL)

OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""

# terms as lists; one row a term of an item and document
OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM benchmark),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM words GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, total),
part AS (
  SELECT doc_id, term, CAST(1000000000 * tf AS BIGINT) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)) AS c
  FROM tf, total),
score AS (
  SELECT item_id, doc_id, CAST(sum(w * c) AS BIGINT) AS score
  FROM b JOIN weight USING (term) JOIN part USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
s AS (
  SELECT a.vec_id AS a, a.label = c.label AS same, c.vec_id AS c, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS s
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT a, c, s, row_number() OVER (PARTITION BY a ORDER BY s DESC, c) AS k FROM s WHERE same),
n AS (
  SELECT p.a, p.c AS p, p.s AS ps, s.c AS n, s.s AS ns,
    CAST(row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.s DESC, s.c) AS INTEGER) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s
  WHERE p.k <= 5)
SELECT a AS anchor_id, p AS positive_id, rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE rank <= 3
"""

ORACLE_SQL: dict[str, str] = {"op2_minhash": OP2_SQL, "op4_grid_order_join": OP4_SQL, "op6_chat_prefix_tree": OP6_SQL, "op7_warc": OP7_SQL,
                              "op12_ranked_search": OP12_SQL, "op13_hard_negatives": OP13_SQL}
