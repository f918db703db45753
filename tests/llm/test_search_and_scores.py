"""Lexical search and hard negatives against brute force; the additive quality
model against a table-by-table sum, planted rules and held-out rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from incidex.llm import quality
from incidex.llm.common import table, workers_find_package
from incidex.llm.lexical import distinct_terms, ranked_search, slices, terms_of
from incidex.llm.negatives import bit_planes, hard_negatives, subset_sums, table_scores

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_find_package(spark)


def brute_terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


# -- lexical search ----------------------------------------------------------------
def brute_search(docs, items, k):
    docs = [(i, Counter(brute_terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in docs if c)
    n_terms = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(brute_terms(t))
    out = []
    for item, own in terms.items():
        found = []
        for i, c in docs:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in own if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        found.sort(key=lambda f: f[:3])
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(found[:k], 1)]
    return out


def test_terms_are_the_maximal_runs():
    for t in [None, "", "A b", "a b c　d", "x-Y_z{1}É\x7fß", "日本 語", "ÀB", "a\x00b\x1fc", "..", "the" * 50_000]:
        assert terms_of(t) == brute_terms(t)
        assert distinct_terms(t) == sorted(set(brute_terms(t)))


def test_slices_share_a_guard(monkeypatch):
    monkeypatch.setattr("incidex.llm.lexical.SCAN_BYTES", 7)
    data = b" one two threeandmore  four "
    parts = list(slices(data))
    assert all(p[0] == p[-1] == " " and data.decode()[at:at + len(p)] == p for at, p in parts)
    assert parts[0][1] + "".join(p[1:] for _, p in parts[1:]) == data.decode()


def test_ranked_search_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    words = ["a", "the", "The", "b1", "é", "É", "日本", "not-here", "x_y", "zebra", "rare" * 20, "q"]
    docs = [(i // 2 if i % 9 == 0 else i, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 30))))
            for i in range(400)]
    docs += [(500, None), (501, ""), (502, "..."), (None, "zebra q"), (None, "zebra q"), (503, "zebra q"), (503, "zebra q"),
             (504, "the " * 60_000 + "zebra"), (505, "thezebra zebrat")]
    items = [(1, "the zebra"), (2, "Q q x_y"), (3, None), (4, "nowhere"), (5, "日本 é É"), (1, "b1"), (None, "rare" * 20), (6, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("clash")).withColumn("item", F.lit(0))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash")).withColumn("doc_id", F.lit(1))
    want = sorted(brute_search(docs, items, 7), key=repr)
    monkeypatch.setattr("incidex.llm.lexical.SCAN_BYTES", 1000)
    for block_bytes in (1 << 20, 40):          # one block of items, several blocks
        got = ranked_search(d, "doc_id", "text", b, "item_id", "text", 7, block_bytes)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert ranked_search(d.limit(0), "doc_id", "text", b, "item_id", "text").count() == 0
    assert ranked_search(d, "doc_id", "text", b.limit(0), "item_id", "text").count() == 0


# -- hard negatives ------------------------------------------------------------------
def test_tables_give_inner_products():
    rng = np.random.default_rng(4)
    for low, high in ((-160, 160), (0, 1), (-1, 1), (-(1 << 27), 1 << 27), (5, 6)):
        a, c = rng.integers(low, high, (9, 24)), rng.integers(low, high, (31, 24))
        assert (table_scores(subset_sums(a), bit_planes(c)) == c @ a.T).all()
    small = rng.integers(-160, 160, (5, 8)), rng.integers(-160, 160, (6, 8))
    assert (table_scores(subset_sums(small[0]), bit_planes(small[1]), np.int32) == small[1] @ small[0].T).all()


def brute_negatives(rows, positives, negatives):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, label if i % 7 else (label + 1) % 10, [math.floor(256 * x) for x in v]))
    out = []
    anchors = {}
    for i, label, v in kept:
        if i % 5 == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for a, (label, v) in anchors.items():
        s = sorted((-sum(x * y for x, y in zip(v, w)), i, own == label) for i, own, w in kept if i != a)
        for ps, p, _ in [x for x in s if x[2]][:positives]:
            fit = [(n, ns) for ns, n, same in s if not same and 50 * -ps <= 100 * -ns <= 95 * -ps][:negatives]
            out += [(a, p, r, n, -ps, -ns) for r, (n, ns) in enumerate(fit, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.4, 12) + 0.3], int(rng.integers(0, 3))) for i in range(160)]
    rows += [(i + 200, rows[i][1], rows[i][2]) for i in range(40)]                 # ties
    rows += [(7, rows[3][1], 1), (10, rows[4][1], 2), (10, rows[5][1], 0)]         # ids that return
    rows += [(300, None, 1), (301, [0.1] * 12, None), (None, [0.1] * 12, 1), (302, [0.1, None], 1), (305, [float("nan")] * 12, 1),
             (310, [float("inf")] * 12, 1), (311, [], 1), (315, [0.0] * 12, 2), (316, [0.5] * 3, 0), (320, [0.9] * 12, 9)]
    d = (spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
         .withColumn("id", F.lit("clash")).withColumn("score", F.lit(0)).withColumn("anchor", F.lit("x")))
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    want = brute_negatives(single, 4, 3)
    assert want
    monkeypatch.setattr("incidex.llm.negatives.CANDIDATES_AT_ONCE", 16)
    for at_once in (4096, 9):
        got = hard_negatives(d, "vec_id", "embedding", label, F.col("vec_id") % 5 == 0, 4, 3, anchors_at_once=at_once)
        assert sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                            "negative_score").collect())) == want
    assert hard_negatives(d.limit(0), "vec_id", "embedding", label, F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives(d, "vec_id", "embedding", label, F.col("vec_id") < 0).count() == 0


# -- quality model ---------------------------------------------------------------------
def test_features_are_finite_and_cover_the_whole_text():
    for t in [None, "", " ", "\n\n", "a", "…", "日本語", "a" * 300_000, "x y " * 100_000, "\x00"]:
        f = quality.features(t)
        assert len(f) == len(quality.FEATURES) and all(map(math.isfinite, f))
    clean = " ".join(f"word{i}" for i in range(400))
    assert quality.features(clean + " junk###" * 40)[quality.FEATURES.index("worst_marks")] == 1.0


def test_tables_learn_steps_and_interactions():
    rng = np.random.default_rng(2)
    x = rng.random((6000, 3))
    y = ((x[:, 0] > 0.7) | ((x[:, 1] > 0.5) != (x[:, 2] > 0.5))).astype(float)     # one step, one interaction
    m = quality.fit_additive(x[:4000], y[:4000], np.arange(4000) % 6 != 0)
    assert ((m.score(x[4000:]) > 0.5) == (y[4000:] > 0)).mean() > 0.93
    assert (1, 2) in [(i, j) for i, j, _ in m.pairs]
    row = x[4100]                                          # the sum of the looked-up entries
    total = m.base + sum(t[int((m.edges[f] <= row[f]).sum())] for f, t in enumerate(m.tables))
    total += sum(t[int((m.pair_edges[i] <= row[i]).sum()), int((m.pair_edges[j] <= row[j]).sum())] for i, j, t in m.pairs)
    assert math.isclose(m.score(row[None])[0], 1 / (1 + math.exp(-total)))


def test_quality_on_held_out_rows(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = quality.fit(docs, labels.where(~held), "doc_id", "text", F.col("quality") == 1)
    got = (docs.join(labels.where(held), "doc_id").select("quality", (quality.predict_quality("text", model) >= 0.7).alias("p"))
           .toPandas())
    assert len(got) > 60 and ((got["quality"] == 1) == got["p"]).mean() >= 0.95


def test_quality_bears_odd_rows(spark):
    rows = [(1, None, 1), (1, "other text", 0), (None, "x", 1), (2, "", None), (3, "word " * 30_000, 1), (3, "word " * 30_000, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumn("y", F.lit("clash")).withColumn("key", F.lit(1))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int").withColumn("text", F.lit("clash"))
    for d, known in ((docs, labels), (docs.limit(0), labels), (docs, labels.limit(0))):
        model = quality.fit(d, known, "doc_id", "text", F.col("quality") == 1)
        p = quality.predict_quality("text", model)
        got = [r["p"] for r in docs.select(p.alias("p")).collect()]
        assert len(got) == len(rows) and all(0 <= x <= 1 for x in got)
        assert docs.limit(0).select(p).count() == 0
    assert quality.AdditiveModel([np.zeros(0)] * len(quality.FEATURES)).score(quality.feature_matrix(pa.array([None, "a"]))).tolist() == [0.5, 0.5]
