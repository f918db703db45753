"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items go into one automaton, every term between two guards
(blanks).  A document is folded byte by byte: A-Z lower-cased, every byte that
belongs to no term replaced by the guard.  One pass of the automaton over the
folded text then reports exactly the whole-term occurrences, so term counts
come straight from the text and no index of the documents is built.  Each
output of the automaton maps to the items that hold the term.

Two scans run for a block of items: the first counts document frequencies (and
once the number of documents and terms), the second scores every document and
keeps each task's best rows of every item.  Blocks are made by hash so that
their term lists stay near ``BLOCK_BYTES``: only a block's terms and weights
travel to the tasks, and benchmarks of any size become more blocks.

Terms are the maximal runs of digits, ASCII letters and characters from U+0080
on in the whole text.  Null and empty texts (documents or items) have no term:
such a document counts nowhere, such an item finds nothing.  Rows of one item
id are one item with the terms of all of them (null is an id like any other).
Every document row stands for itself, whatever its id; equal scores go by
ascending id, null ids last.  Without documents or items the result is empty.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidex.llm.common import write_shared

BLOCK_BYTES = 1 << 20      # term bytes of a block, about
SCAN_BYTES = 1 << 20       # text bytes scanned at a time
CELLS = 1 << 21            # (document, item) scores held at a time
GUARD = 0x20

_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else GUARD
              for c in range(256))

_automata: dict = {}


def terms_of(text: str | None) -> list[str]:
    """All terms of a text in order, folded."""
    folded_text = (text or "").encode("utf-8", "replace").translate(_FOLD).decode("utf-8")
    return [t for t in folded_text.split(" ") if t]


def distinct_terms(text: str | None) -> list[str]:
    return sorted(set(terms_of(text)))


def automaton(terms: list[str]):
    """Automaton of the guarded terms; an output is the term's place in the list.
    The worker keeps the last one it built."""
    key = tuple(terms)
    if key not in _automata:
        import ahocorasick
        a = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            # one character a byte: texts are scanned as bytes, whatever their script
            a.add_word(" " + t.encode("utf-8").decode("latin-1") + " ", i)
        a.make_automaton()
        _automata.clear()
        _automata[key] = a
    return _automata[key]


def folded(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, folded texts) of consecutive rows, about ``SCAN_BYTES`` a time."""
    first, part, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t.as_py()
        part.append(t.encode("utf-8", "replace").translate(_FOLD) if t else b"")
        size += len(part[-1])
        if size >= SCAN_BYTES:
            yield first, part
            first, part, size = i + 1, [], 0
    if part:
        yield first, part


def slices(data: bytes) -> Iterator[tuple[int, str]]:
    """(start, slice) of guarded text in slices of about ``SCAN_BYTES`` that share a guard."""
    at = 0
    while at < len(data) - 1:
        end = data.find(b" ", min(at + SCAN_BYTES, len(data) - 1))
        yield at, data[at:end + 1].decode("latin-1")
        at = end


def count_terms(texts: list[bytes], a) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms with repeats of each folded text, and (row, term, occurrences) of the automaton's terms."""
    data = b" " + b" ".join(texts) + b" "
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])   # guard before each text
    blank = np.frombuffer(data, np.uint8) == GUARD
    starts = np.concatenate([[0], np.cumsum(blank[:-1] & ~blank[1:])])
    n = np.diff(starts[begin])
    found = []
    if len(a):
        for at, part in slices(data):
            hits = np.fromiter(chain.from_iterable(a.iter(part)), np.int64).reshape(-1, 2)
            # an occurrence ends at the guard behind the term; the character before it is the term's own
            row = np.searchsorted(begin, hits[:, 0] + (at - 1), side="right") - 1
            found.append(row * len(a) + hits[:, 1])
    pair, tf = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    return n, pair // max(len(a), 1), pair % max(len(a), 1), tf


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """Rows ``(item, term)``, each pair once."""
    kind = items.schema[item].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):   # one item at a time: an item may be long
                terms = distinct_terms(batch.column(1)[at].as_py())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([at] * len(terms), pa.int64())),
                                                  pa.array(terms, pa.string())], names=["item", "term"])

    schema = T.StructType([T.StructField("item", kind), T.StructField("term", T.StringType())])
    return items.select(F.col(item), F.col(text).cast("string")).mapInArrow(cut, schema).distinct()


class TermBlock:
    """A block of items: its terms, and for each term the items that hold it."""

    def __init__(self, rows: pa.Table):
        self.items = rows["item"].unique()
        self.terms = sorted(set(rows["term"].to_pylist()))
        place = {t: i for i, t in enumerate(self.terms)}
        term = np.fromiter(map(place.__getitem__, rows["term"].to_pylist()), np.int64, len(rows))
        own = pc.index_in(rows["item"], self.items).to_numpy(zero_copy_only=False) if len(rows) else np.zeros(0, np.int64)
        order = np.lexsort((own, term))
        self.own = own[order].astype(np.int64)              # items, term by term
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(self.terms)))])


def frequencies(docs: DataFrame, text: str, terms: list[str]) -> tuple[np.ndarray, int, int]:
    """Documents holding each term, documents with a term, terms of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, df, docs_n, all_n = automaton(terms), np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for _, texts in folded(batch.column(0)):
                n, _, term, _ = count_terms(texts, a)
                docs_n += int((n > 0).sum())
                all_n += int(n.sum())
                df += np.bincount(term, minlength=len(terms))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, [-1, -2]]), pa.int64()),
                                          pa.array(np.concatenate([df[at], [docs_n, all_n]]), pa.int64())], names=["term", "n"])

    found = (docs.select(F.col(text).cast("string")).mapInArrow(count, "term long, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).collect())   # one row a term of the block
    got = {r["term"]: r["n"] for r in found}
    return np.array([got.get(i, 0) for i in range(len(terms))], np.int64), got.get(-1, 0), got.get(-2, 0)


def term_weights(df: np.ndarray, n: int) -> np.ndarray:
    """Integer weight of each term: 1000 times the logarithm of its rarity, rounded down."""
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def best_rows(item: np.ndarray, score: np.ndarray, key: pa.Array, k: int) -> np.ndarray:
    """Rows that are among their item's first ``k`` by (score descending, key ascending, nulls last)."""
    order = pc.sort_indices(pa.table({"i": item, "s": score, "k": key}),
                            sort_keys=[("i", "ascending"), ("s", "descending"), ("k", "ascending")]).to_numpy()
    i = item[order]
    first = np.concatenate([[0], np.flatnonzero(np.diff(i)) + 1]) if len(i) else np.zeros(0, np.int64)
    place = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
    return order[place < k]


def scores(block: TermBlock, docs: DataFrame, key: str, text: str, weights: np.ndarray, n_docs: int, n_terms: int,
           k: int) -> DataFrame:
    """Each task's best ``k`` rows ``(item place, key, score)`` of every item."""
    terms, own, ends, n_items = block.terms, block.own, block.ends, len(block.items)
    kind = docs.schema[key].dataType
    # sums below 2 ** 53 are exact in double precision
    exact = int(np.bincount(own, np.repeat(weights, np.diff(ends)).astype(float), n_items).max(initial=0)) * 1_000_000 < 1 << 53

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(terms)
        per_time = max(1, CELLS // max(1, n_items))
        least = np.ones(n_items, np.int64)     # a row below it is none of the item's best
        held: list[tuple] = []

        def keep(most: int) -> None:
            if sum(len(h[0]) for h in held) <= most:
                return
            i, s = (np.concatenate([h[c] for h in held]) for c in (0, 1))
            ids = pa.concat_arrays([h[2] for h in held])
            at = best_rows(i, s, ids, k)
            held[:] = [(i[at], s[at], ids.take(pa.array(at)))]
            full = np.flatnonzero(np.bincount(i[at], minlength=n_items) == k)
            low = np.full(n_items, np.iinfo(np.int64).max)
            np.minimum.at(low, i[at], s[at])
            least[full] = low[full]

        for batch in batches:
            keys = batch.column(0)
            for first, texts in folded(batch.column(1)):
                n, row, term, tf = count_terms(texts, a)
                m = np.array([50 + (50 * int(x) * n_docs) // n_terms for x in n], np.int64) if n_terms else n
                part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
                for low in range(0, len(texts), per_time):
                    high = min(low + per_time, len(texts))
                    a0, a1 = np.searchsorted(row, [low, high])
                    number = (ends[1:] - ends[:-1])[term[a0:a1]]
                    to = np.repeat(ends[:-1][term[a0:a1]] - (np.cumsum(number) - number), number) + np.arange(number.sum())
                    cell = np.repeat(row[a0:a1] - low, number) * n_items + own[to]
                    value = np.repeat(part[a0:a1], number)
                    if exact:
                        total = np.bincount(cell, value.astype(float), (high - low) * n_items).astype(np.int64)
                    else:
                        total = np.zeros((high - low) * n_items, np.int64)
                        np.add.at(total, cell, value)
                    total = total.reshape(high - low, n_items)
                    d, i = np.nonzero(total >= least)
                    held.append((i, total[d, i], keys.take(pa.array(d + (first + low)))))
                    keep(max(4 * k * n_items, CELLS // 4))
        keep(0)
        for i, s, ids in held:
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), ids, pa.array(s, pa.int64())], names=["i", "key", "score"])

    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("key", kind), T.StructField("score", T.LongType())])
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(score, schema)


def ranked_search(docs: DataFrame, key: str, text: str, items: DataFrame, item: str, item_text: str, k: int = 50,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of every item: rows ``(item, rank, key, score)``.

    ``item`` and ``key`` keep their names; with one name for both, the item's
    column is called ``item_<name>``.  Only scores above 0 are returned.
    """
    spark = docs.sparkSession
    name = item if item != key else f"item_{item}"
    rows = write_shared(item_terms(items, item, item_text), "item-terms", spark)
    size = rows.agg(F.sum(F.octet_length("term") + 9)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    kind = T.StructType([T.StructField(name, rows.schema["item"].dataType), T.StructField("rank", T.IntegerType()),
                         T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType())])
    found, total = [], None
    for b in range(blocks):
        block = TermBlock(rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow())   # about block_bytes
        if not block.terms:
            continue
        df, *counted = frequencies(docs, text, block.terms)
        total = total or counted
        best = scores(block, docs, key, text, term_weights(df, total[0]), *total, k)
        rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), F.asc_nulls_last("key")))
        ids = spark.createDataFrame(pa.table({"i": pa.array(range(len(block.items)), pa.int32()), "item": block.items}))
        got = (best.withColumn("rank", rank).where(F.col("rank") <= k).join(F.broadcast(ids), "i")   # one row an item of the block
               .select(F.col("item").alias(name), "rank", F.col("key").alias(key), "score"))
        found.append(got if blocks == 1 else write_shared(got, "ranked", spark))
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], kind)
