"""Operators against brute force, round trips and held-out accuracy, with the
cases every operator has to bear: nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidex.llm import langid, toxicity
from incidex.llm.ann import nearest
from incidex.llm.bpe import ByteVocabulary, bpe_decode, bpe_encode, load
from incidex.llm.chat import PrefixTree, escape, format_turn, parse_turn, unescape
from incidex.llm.common import connected_components, workers_find_package
from incidex.llm.embed_dedup import near_duplicate_vectors
from incidex.llm.minhash import near_duplicates, shingle_set, signature
from incidex.llm.packing import best_fit, dominating_set, pack, pack_documents, packing_plan
from incidex.llm.pieces import safe_pieces
from incidex.llm.queries import tokenizer_path
from incidex.llm.token_counts import token_count
from incidex.llm.warc import archive_records, chunk_table, read_archives, write_archives

HARD = [None, "", " ", "a", "naïve café\r\n\tDon't I'll 123abc!!! 日本語 😀😀", "foo\xa0\n\nbar <|endoftext|>x  <|endoftext|>  y",
        "x\x1cy \x1c z　q", "  lead", "trail  \n ", "a" * 5000 + "  b", "\x00 a \x00", "word " * 20000, "word " * 20000]


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_find_package(spark)


def texts(spark, values):
    rows = [(i, t, "clash") for i, t in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumn("_salt", F.lit(1))


def test_pieces_join_to_the_text():
    for t in HARD:
        assert "".join(safe_pieces(t or "")) == (t or "")


def test_token_counts_and_bpe_match_the_library(spark):
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    want = [t.encode(x or "", add_special_tokens=False).ids for x in HARD]
    df = texts(spark, HARD)
    got = df.select("doc_id", token_count("text", path).alias("n"), bpe_encode("text", path).alias("ids")) \
            .withColumn("back", bpe_decode("ids", path)).orderBy("doc_id").collect()
    assert [r["n"] for r in got] == [len(x) for x in want]
    assert [r["ids"] for r in got] == want
    assert [r["back"] for r in got] == [t.decode(x, skip_special_tokens=False) for x in want]
    assert df.limit(0).select(token_count("text", path), bpe_encode("text", path)).count() == 0


def test_segment_trees_agree_and_broken_bytes_decode():
    model = load(tokenizer_path("byte_bpe_50k.json"))
    rng = random.Random(3)
    words = [bytes(rng.choice(b"abcdeth in") for _ in range(rng.randint(2, 64))) for _ in range(300)]
    begin, number, ids = model.merge_words(words)
    for w, b, n in zip(words, begin, number, strict=True):
        assert ids[b:b + n].tolist() == model.merge_alone(w).tolist()
    v = load(tokenizer_path("byte_bpe_50k.json"), ByteVocabulary)
    first = model.first[[0xE6, 0x97, 0x61]]   # two bytes of a longer character
    assert v.decode(np.array([0, 3]), first) == [b"\xe6\x97a".decode("utf-8", "replace")]


def test_dominance_keeps_the_optimum():
    def optimum(sizes, capacity):   # fewest sequences by search
        sizes, best = sorted(sizes, reverse=True), [len(sizes)]

        def go(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(sizes):
                best[0] = len(bins)
                return
            for room in set(bins):
                if room >= sizes[i]:
                    left = list(bins)
                    left.remove(room)
                    go(i + 1, [*left, room - sizes[i]])
            go(i + 1, [*bins, capacity - sizes[i]])
        go(0, [])
        return best[0]

    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([10, 20])
        sizes = [rng.randint(2, capacity) for _ in range(9)]
        count = np.bincount(sizes, minlength=capacity + 1)
        found = dominating_set(count, max(sizes), capacity)
        if found:
            rest = Counter(sizes) - Counter(found)
            assert 1 + optimum(list(rest.elements()), capacity) == optimum(sizes, capacity)
        plan = packing_plan(Counter(sizes), capacity)
        assert Counter(s for held, n in plan for s in held * n) == Counter(sizes)
        assert all(sum(held) <= capacity for held, _ in plan + best_fit(count, capacity))


def test_packing(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    got = pack_documents(texts(spark, HARD), "doc_id", "text", tokenizer_path("word_bpe_49k.json"), 64).toPandas()
    want = {}
    for i, x in enumerate(HARD):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        for p in range(0, len(ids), 64):
            want[i, p // 64] = (p, len(ids[p:p + 64]), zlib.crc32(ids[p:p + 64].tobytes()))
    assert want == {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()}
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 64
    odd = spark.createDataFrame([(1, None), (2, 0), (3, 99), (4, 5)], "doc_id long, length long")
    assert {r["doc_id"] for r in pack(odd, ["doc_id"], "length", 64).where("sequence_id is null").collect()} == {1, 2, 3}
    assert pack_documents(texts(spark, []), "doc_id", "text", tokenizer_path("word_bpe_49k.json"), 64).count() == 0


def test_minhash_against_all_pairs(spark):
    rng = random.Random(1)
    base = [rng.choice("alpha beta gamma delta eps zeta eta theta iota".split()) + str(rng.randint(0, 50)) for _ in range(200)]
    docs = [None, "", "one two", "one two", "One TWO", "three"]
    for i in range(60):   # a group of near copies of many degrees, and a chain
        words = list(base)
        for _ in range(i % 15):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        docs.append(" ".join(words))
    docs += ["", docs[10]]
    sets = [set(shingle_set(d, 5).tolist()) for d in docs]
    for percent in (80, 85):
        parent = list(range(len(docs)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a in range(len(docs)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
        got = {r["doc_id"]: r for r in near_duplicates(texts(spark, docs), "doc_id", "text", percent).collect()}
        assert [got[i]["component_id"] for i in range(len(docs))] == [root(i) for i in range(len(docs))]
        assert [got[i]["n_shingles"] for i in range(len(docs))] == [len(s) for s in sets]
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_minhash_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "x y z"), (2, "a b c"), (3, "x y z"), (None, "a b c")], "doc_id long, text string")
    got = near_duplicates(df, "doc_id", "text").collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(1, 1, True), (2, 1, False), (3, 1, False), (None, 1, True)} or \
        {r["component_id"] for r in got if r["doc_id"]} == {1}
    assert near_duplicates(df.limit(0), "doc_id", "text").count() == 0


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    for n in (1, 3, 40, 3000):
        s = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert set(signature(s)) <= set(s.tolist()) and (signature(s) == signature(s.copy())).all()
    s = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64))
    same = (signature(s) == signature(s[rng.random(len(s)) < 0.85])).mean()
    assert abs(same - 0.85) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (None, 3), (7, 7)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def vectors(spark, x, labels=None):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], None if labels is None else labels[i])
            for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("block", F.lit("clash"))


def odd_vectors(n=150, d=12, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[20:60] = x[0] + 0.05 * rng.standard_normal((40, d))
    x[60:70] = x[1]
    return [None, [0.0] * d, [None] + [1.0] * (d - 1), [float("nan")] + [1.0] * (d - 1), [float("inf")] * d, *x.tolist()]


def test_ann_finds_the_nearest(spark):
    x = odd_vectors()
    got = nearest(vectors(spark, x), "vec_id", "embedding", F.col("vec_id") % 5 == 0, 20).toPandas()
    good = np.array(x[5:], np.float32).astype(float)
    for q in range(5, len(x), 5):
        score = (good * good[q - 5]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(good)), -score)) if i != q - 5][:20]
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        assert len(set(own.vec_id) & {i + 5 for i in order}) >= 18
        assert np.allclose(own.score, good[own.vec_id - 5] @ good[q - 5], rtol=1e-12, atol=0)
    assert 0 not in set(got.query_id) and set(got.vec_id) <= set(range(5, len(x)))
    few = nearest(vectors(spark, x[5:9]), "vec_id", "embedding", F.lit(True), 20)
    assert few.count() == 12
    assert nearest(vectors(spark, x[:0]), "vec_id", "embedding", F.lit(True)).count() == 0


def test_ann_over_dozens_of_lists(spark):
    """One share of the lists at every size: recall against brute force with 3 and with 40 lists."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((4000, 16)).astype(np.float32)
    df = vectors(spark, x.tolist())
    good = x.astype(float)
    for rows_a_list in (1300, 100):
        got = nearest(df, "vec_id", "embedding", F.col("vec_id") % 40 == 0, 20, rows_a_list=rows_a_list).toPandas()
        hits = 0
        for q, own in got.groupby("query_id"):
            score = good @ good[q]
            score[q] = -np.inf
            assert sorted(own["rank"]) == list(range(1, 21))
            assert np.allclose(own.score, good[own.vec_id] @ good[q], rtol=1e-12, atol=1e-12)
            hits += len(set(own.vec_id) & set(np.argsort(-score)[:20].tolist()))
        assert got.query_id.nunique() == 100 and hits >= 0.9 * 2000


def test_grid_order_join_against_all_pairs(spark):
    x = odd_vectors(seed=4)
    labels = [None if i % 17 == 3 else i % 2 for i in range(len(x))]
    got = {r["vec_id"]: r for r in near_duplicate_vectors(vectors(spark, x, labels), "vec_id", "embedding", "label").collect()}
    good = {i: np.array(v, np.float32).astype(float) for i, v in enumerate(x) if i >= 5 and labels[i] is not None}
    parent, links = {i: i for i in range(len(x))}, Counter()

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in good:
        for b in good:
            if a < b and labels[a] == labels[b] and good[a] @ good[b] >= 0.98 * np.linalg.norm(good[a]) * np.linalg.norm(good[b]):
                links[a] += 1
                links[b] += 1
                x1, y1 = sorted((root(a), root(b)))
                parent[y1] = x1
    assert sum(links.values()) > 100
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (links[i], root(i), root(i) == i)
    assert near_duplicate_vectors(vectors(spark, [], []), "vec_id", "embedding", "label").count() == 0


def test_copies_of_vectors_are_one(spark):
    near = [1.0, 0.1]
    rows = [(i, [1.0, 0.0], 1) for i in range(1000, 0, -1)] + [(5000, near, 1), (5001, [1.0, 0.0], 2), (7, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = near_duplicate_vectors(df, "vec_id", "embedding", "label").collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert by[5000] == (1000, 1, False) and by[5001] == (0, 5001, True) and by[None] == (0, None, True)
    two = near_duplicate_vectors(df.where("vec_id in (1, 5000)"), "vec_id", "embedding", "label").collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in two} == {(1, 1, 1), (5000, 1, 1)}
    assert by[1] == (1000, 1, True) and all(by[i] == (1000, 1, False) for i in range(2, 1001))


def test_places_of_a_hot_length(spark):
    pieces = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 60 + 1).alias("length"))
    got = pack(pieces, ["doc_id"], "length", 64).toPandas().sort_values(["sequence_id", "offset"])
    assert len(got) == 20_000 and not got.sequence_id.isna().any()
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 64


def test_repeated_documents_train_once(spark):
    rows = [(i, f"plain text {i}") for i in range(40)] + [(i, "grobian here") for i in range(40, 60)] + [(3, "plain text again")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, 1, int(i >= 40)) for i in range(60)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(docs, known, "doc_id", "text", {"toxic": F.col("toxic") == 1})
    p = {r["doc_id"]: r["p"]["toxic"] for r in docs.select("doc_id", toxicity.predict_toxicity("text", chain).alias("p")).collect()}
    assert all((p[i] >= 0.5) == (i >= 40) for i in range(60))


def test_language_model(spark):
    rng = random.Random(0)
    words = {"en": "the and with from ring thing".split(), "de": "der und mit von über schön".split()}
    rows = [(" ".join(rng.choice(words[k]) for _ in range(rng.randint(5, 60))), k) for k in words for _ in range(40)]
    model = langid.fit(spark.createDataFrame([*rows, (None, "en"), ("the", None), ("12", "de")], "text string, lang string"), "text", "lang")
    df = texts(spark, ["the thing and the ring", "mit der und über von", None, "", "123 !!", "ζηθ ικλ μνξ οπρ", "the thing " * 200_000])
    got = df.select("doc_id", langid.predict_language("text", model).alias("p")).orderBy("doc_id").collect()
    p = [r["p"] for r in got]
    assert [x["lang"] for x in p[:5]] == ["en", "de", "und", "und", "und"] and p[6]["lang"] == "en"
    assert [x["rejected"] for x in p] == [False, False, True, True, True, True, False]
    assert all(0 <= x["score"] <= 1 for x in p)
    empty = langid.fit(spark.createDataFrame([], "text string, lang string"), "text", "lang")
    assert empty.predict("the") == ("und", 0.0, True)


def test_toxicity_chain(spark):
    rng = random.Random(0)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(30)]
        toxic, low = i % 5 == 0, i % 7 == 0
        if toxic:
            words += [rng.choice(["grobian", "grobiane", "grobianen"])]
        if low:
            words += ["$$$"]
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(not low), int(toxic)))
    rows.append((1000, None))
    labels += [(1000, 1, 0), (None, 1, 1), (3, None, 1), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit("clash"))
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.fit(docs.where("doc_id % 3 <> 1"), known, "doc_id", "text", categories)
    assert [len(w) for w in chain.weights] == [len(chain.wanted) + 1, len(chain.wanted) + 2]   # the later sees the earlier
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", toxicity.predict_toxicity("text", chain).alias("p")).collect()}
    held = [i for i in range(600) if i % 3 == 1]
    assert np.mean([(got[i]["toxic"] >= 0.5) == (i % 5 == 0) for i in held]) > 0.98
    assert got[1000]["toxic"] < 0.5
    none = toxicity.fit(docs.limit(0), known, "doc_id", "text", categories)
    assert none.predict(np.zeros((1, 0))).shape == (1, 2)


def test_near_dedup_keeps_different_texts_of_one_id(spark):
    import corpus_pipeline
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "abc")
    rows = [(10, a, "x"), (10, b, "x"), (10, a, "w"), (9, a + " end", "x"), (-3, c, "x"), (11, c, "x"), (11, None, "x"), (11, "", "y"), (None, a, "x"), (None, a, "x")]
    for kind in ("long", "string"):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("doc_id", F.col("doc_id").cast(kind))
        got = corpus_pipeline.near_dedup(spark, docs, "").collect()
        near = (9, a + " end", "x") if kind == "long" else (10, a, "w")       # "10" < "9"
        want = [near, (10, b, "x"), (-3, c, "x"), (11, None, "x"), (None, a, "x"), (None, a, "x")]
        assert sorted((str(r.doc_id), str(r.text), r.lang) for r in got) == sorted((str(r[0]), str(r[1]), r[2]) for r in want)


def test_escaping_is_reversible():
    rng = random.Random(0)
    parts = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "|", ">", "x", " ", "</s>", "[INST] "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        assert unescape(escape(text)) == text
        assert not re.search(r"</?s>|\[/?INST\]|<</?SYS>>", escape(text))
        for role in ("user", "assistant", "system", "tool|>", ""):
            assert parse_turn(format_turn(role, text)) == (role, text)


def test_prefix_tree(spark):
    rows = [(c, t, ["user", "assistant"][t % 2], f"turn {t}" if t < 2 else f"{c % 3} {t}") for c in range(9) for t in range(2 + c % 4)]
    rows += [(50, 0, None, None), (51, 0, "user", ""), (None, 1, "assistant", "b"), (None, 0, "user", "a"), (52, 0, "user", "x"), (52, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("clash"))
    tree = PrefixTree(df)
    nodes = {bytes(r["node"]): r for r in tree.nodes.collect()}
    spans = sorted((r["start"], r["start"] + r["chars"]) for r in nodes.values())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))   # each once, gapless
    for r in tree.paths.collect():
        at, held = 0, []
        for n in r["path"]:
            node = nodes[bytes(n)]
            held.append((node["start"], node["start"] + node["chars"]))
            assert node["position"] == at
            assert sum(i["b"] - i["a"] for i in node["intervals"]) == at + node["chars"]
            covered = {x for i in node["intervals"] for x in range(i["a"], i["b"])}
            assert covered == {x for a, b in held for x in range(a, b)}
            at += node["chars"]
    got = {r["conv_id"]: r for r in tree.read_back().collect()}
    want: dict = {}
    for c, _, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256("".join(x for r, x in turns if r == "assistant").encode()).hexdigest()
        assert got[c]["formatted_chars"] == sum(len(format_turn(r, x)) for r, x in turns)
    assert PrefixTree(df.limit(0)).read_back().count() == 0


def test_prefix_tree_reads_back_from_the_layout(spark):
    """Conversations come from intervals, places and positions: a broken one is noticed."""
    from pyspark.errors import PythonException
    rows = [(c, t, "user", f"{t}" if t < 3 else f"{c} {t}") for c in range(4) for t in range(6)]
    tree = PrefixTree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = tree.nodes
    for name, broken in (("position", F.col("position") + 1),
                         ("start", F.when(F.col("depth") == 2, F.col("start") + 100_000).otherwise(F.col("start"))),
                         ("intervals", F.expr("transform(intervals, x -> named_struct('a', x.a, 'b', x.b - chars))"))):
        tree.nodes = whole.withColumn(name, broken)
        with pytest.raises(PythonException):
            tree.read_back().collect()
    tree.nodes = whole.withColumn("intervals", F.expr("slice(intervals, 1, 0)"))
    assert [r["n_turns"] for r in tree.read_back().collect()] == [None] * 4


def test_prefix_tree_cuts_long_conversations(spark, monkeypatch):
    """One conversation over several range blocks: ids, places and positions go on across them,
    no row holds it whole, and the driver gets one row a block."""
    from incidex.llm import chat
    rows = [(None, t // 3, "user", "same") for t in range(900)]
    rows += [(c, t, "user", f"{t}" if t < 40 * c else f"{c} {t}") for c in range(1, 6) for t in range(300)] + [(9, t, "user", f"{t}") for t in range(80)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    base = chat.hash_base(b"")
    hashed = chat.hashed_turns(df, "conv_id", "turn", "role", "text", base)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = hashed.where("kind = 0 and conv = 'null'").select("block").distinct().count()
        tree = PrefixTree(df)
        nodes = {bytes(r["node"]): r for r in tree.nodes.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert cut > 1
    spans = sorted((r["start"], r["start"] + r["chars"]) for r in nodes.values())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    prefixes, texts = set(), {}
    for c, _, _, x in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        texts[c] = (*texts.get(c, ()), x)
        prefixes.add(texts[c])
    assert len(nodes) == len(prefixes)
    assert max(len(r["intervals"]) for r in nodes.values()) <= 6
    monkeypatch.setattr(chat, "PATH_CHUNK", 100)
    steps: dict = {}
    for r in PrefixTree(df).paths.collect():
        assert len(r["path"]) <= 100
        steps.setdefault(bytes(r["leaf"]), []).append((r["chunk"], r["path"]))
    assert sorted(sum(len(p) for _, p in x) for x in steps.values()) == sorted(len(x) for x in texts.values())
    for parts in steps.values():
        at, held = 0, set()
        for _, path in sorted(parts):
            for n in path:
                node = nodes[bytes(n)]
                held |= set(range(node["start"], node["start"] + node["chars"]))
                assert node["position"] == at
                assert sum(i["b"] - i["a"] for i in node["intervals"]) == at + node["chars"]
                at += node["chars"]
        assert {x for i in nodes[bytes(path[-1])]["intervals"] for x in range(i["a"], i["b"])} == held
    got = {r["conv_id"]: r["turns_sha256"] for r in tree.read_back().collect()}
    assert got == {c: hashlib.sha256("".join(f"user\n{x}\n" for x in t).encode()).hexdigest() for c, t in texts.items()}


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>é</p>", "x\r\ny\r\n", "", None, "<p>é</p>", "WARC/1.1\r\nContent-Length: 3\r\n\r\n", "\r", "日本語😀" * 500, "日本語😀" * 500, "\n\r\n\r"]
    rows = [(i, None if i == 2 else f"http://x/{i}\r\nEvil: 1", h) for i, h in enumerate(html)] + [(None, "u", "x\r\ny\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("chunk", F.lit("clash"))
    got = {r["page_id"]: r for r in archive_records(df, "page_id", "url", "html").collect()}
    first: dict = {}
    for i, h in enumerate(html):
        data = (h or "").encode()
        assert got[i]["payload_bytes"] == len(data)
        import base64
        assert got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert got[i]["refers_to"] == first.get(data) and got[i]["record_type"] == ("revisit" if data in first else "response")
        first.setdefault(data, i)
    assert got[None]["refers_to"] == 1
    # small chunks: payloads come back whole from response and continuation records
    path = write_archives(chunk_table(df.where("page_id is not null"), "page_id", "url", "html", min_bytes=10**9, chunk_bytes=64), str(tmp_path / "w"))
    parts: dict = {}
    for r in read_archives(spark, path).collect():
        parts.setdefault(int(r["record"]), []).append((r["chunk"], r["data"]))
    assert {k: "".join(d for _, d in sorted(v)) for k, v in parts.items()} == {i: h or "" for i, h in enumerate(html)}
    assert len(parts[7]) > 50
    assert archive_records(df.limit(0), "page_id", "url", "html").count() == 0
