"""MinHash near-duplicates of texts by one-permutation hashing.

A text's set holds the 64-bit hashes of its distinct word shingles.  One
permutation splits the hash range into bins and keeps each bin's smallest
value; empty bins borrow from a bin chosen by universal hashing (optimal
densification), so equal sets have equal signatures and every bin agrees with
the probability of the sets' similarity.  Bands of a few bins are the buckets.

Equal sets are one member from the start.  In each bucket of two or more
members the candidate edges form a star around its smallest member, so a
bucket of ``m`` members has ``m - 1`` pairs.  Pairs are confirmed on full
sets, and links give components: a bucket of copies is settled by its star.
Buckets whose members still lie in different components get a second pass that
is exact: members are dealt into bounded chunks, and each pair of chunks that
meets in such a bucket is one unit of work, in which members of different
components are compared on full sets.  Only links leave a unit, so no link
between members of a bucket is lost and no list of pairs is ever made.

With 42 bands of 6 bins, a pair at the threshold of 85 (80) percent shares no
bucket with a probability of 2e-9 (3e-6).  There are no other losses.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidex.llm.common import connected_components, write_shared
from incidex.llm.memory import held

BINS_BITS = 8
BANDS, ROWS = 42, 6
CHUNK = 512
BLOOM_BITS, BLOOM_BITS_MOST = 22, 26
REMEMBERED = 400_000
U = np.uint64
_STEP, _FINAL1, _FINAL2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * _FINAL1
    x = (x ^ (x >> U(27))) * _FINAL2
    return x ^ (x >> U(31))


class WordHashes(dict):
    """64-bit hash of each word, remembered by the worker."""

    @property
    def nbytes(self) -> int:
        return 160 * len(self)

    def __missing__(self, word: bytes) -> int:
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h



def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles of ``width`` words.

    Words are runs of anything but blank and 0x09-0x0D, A-Z in lower case.
    With fewer words the whole sequence is the one shingle; without words the
    set is empty.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, U)
    known = held("minhash", "words", WordHashes)
    if len(known) > REMEMBERED:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), U, len(words))
    n = min(width, len(h))
    s = np.full(len(h) - n + 1, n, U)
    for x in range(n):
        s = mix(s * _STEP + h[x:len(h) - n + 1 + x])
    return np.unique(s)


def _probes(bins: int, attempts: int) -> np.ndarray:
    """Bins an empty bin asks in turn, by universal hashing of (bin, attempt)."""
    x = np.arange(bins, dtype=U)[:, None] * _STEP + np.arange(1, attempts + 1, dtype=U)[None, :] * _FINAL1
    return (mix(x) >> U(32)).astype(np.int64) % bins


_PROBES = _probes(1 << BINS_BITS, 1024)


def signature(hashes: np.ndarray, bits: int = BINS_BITS) -> np.ndarray:
    """One-permutation signature of a non-empty sorted set, densified."""
    bins = 1 << bits
    edges = np.searchsorted(hashes, np.arange(bins, dtype=U) << U(64 - bits))
    filled = np.diff(np.append(edges, len(hashes))) > 0
    out = hashes[np.minimum(edges, len(hashes) - 1)]
    empty = np.flatnonzero(~filled)
    for lo, hi in ((0, 8), (8, 64), (64, _PROBES.shape[1])):
        if not len(empty):
            return out
        hit = filled[_PROBES[empty, lo:hi]]
        first = hit.argmax(axis=1)
        found = hit[np.arange(len(empty)), first]
        out[empty[found]] = out[_PROBES[empty[found], lo + first[found]]]
        empty = empty[~found]
    if len(empty):  # one bin in a million: the next filled bin
        full = np.flatnonzero(filled)
        out[empty] = out[full[np.searchsorted(full, empty) % len(full)]]
    return out


def buckets(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket number a band."""
    h = np.arange(1, bands + 1, dtype=U)
    for r in range(rows):
        h = mix(h * _STEP + sig[r:bands * rows:rows])
    return h.view(np.int64)


def signatures(docs: DataFrame, key: str, text: str, width: int = 5) -> DataFrame:
    """Rows ``(key, n_shingles, set_id, buckets)``; empty sets have null ``set_id``."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_id", T.BinaryType()), T.StructField("buckets", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, bands = [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py(), width)
                n.append(len(s))
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(buckets(signature(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=schema.names)

    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def common_count(a, b) -> int:
    """Size of the intersection of two sets as :func:`kept_set` holds them."""
    if isinstance(a, frozenset) and isinstance(b, frozenset):
        return len(a & b)
    a, b = (np.fromiter(sorted(x), U, len(x)) if isinstance(x, frozenset) else x for x in (a, b))
    return len(np.intersect1d(a, b, assume_unique=True))


def kept_set(text: str | None, width: int):
    s = shingle_set(text, width)
    return frozenset(s.tolist()) if len(s) <= 2000 else s


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets meet ``100 * intersection >= percent * union``.

    ``pairs`` has ``(work, a, b)``: ``work`` names two chunks of members, so a
    text travels once for each pair of chunks it is needed in, not once for
    each pair.  In every task the texts of a work unit come first, then its
    pairs; a unit is bounded by the chunk size.  ``texts`` has ``(node, text)``.
    """
    kind = pairs.schema["a"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    pairs = write_shared(pairs, "pairs")
    nodes = pairs.select("work", F.col("a").alias("node")).union(pairs.select("work", "b")).distinct()
    rows = (nodes.join(texts, "node")
            .select("work", F.lit(0).alias("kind"), F.col("node").alias("a"), F.lit(None).cast(kind).alias("b"), "text")
            .union(pairs.select("work", F.lit(1), "a", "b", F.lit(None).cast("string"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}
        for batch in batches:
            left, right = [], []
            for work, what, a, b, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if work != now:
                    now, sets = work, {}
                if what == 0:
                    sets[a] = kept_set(text, width)
                    continue
                x, y = sets[a], sets[b]
                both = common_count(x, y)
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    left.append(a)
                    right.append(b)
            out = batch.schema.field(2).type
            yield pa.RecordBatch.from_arrays([pa.array(left, out), pa.array(right, out)], names=["a", "b"])

    return rows.repartition("work").sortWithinPartitions("work", "kind").mapInArrow(run, schema)


def confirm_units(rows: DataFrame, percent: int, width: int) -> DataFrame:
    """Links ``(a, b)`` between members of different components within units of work.

    ``rows`` has ``(work, chunk, node, component, text)``; a unit holds the
    members of one chunk or of two, and members of two are compared across."""
    kind = rows.schema["node"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def links(members):
        out = []
        for x, (chunk, node, component, own) in enumerate(members):
            for chunk2, node2, component2, other in members[:x]:
                if component == component2 or (chunk == chunk2) != (members[0][0] == members[-1][0]):
                    continue
                small, large = sorted((len(own), len(other)))
                if 100 * small >= percent * large:
                    both = common_count(own, other)
                    if 100 * both >= percent * (small + large - both):
                        out.append((node2, node))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, out_type = None, [], None
        for batch in batches:
            found, out_type = [], batch.schema.field(2).type
            for work, chunk, node, component, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if work != now:
                    found += links(members)
                    now, members = work, []
                members.append((chunk, node, component, kept_set(text, width)))
            yield pairs_of(found, out_type)
        if members:
            yield pairs_of(links(members), out_type)

    def pairs_of(found, out_type):
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], out_type) for i in (0, 1)], names=["a", "b"])

    return (rows.select("work", "chunk", "node", "component", "text").repartition("work")
            .sortWithinPartitions("work", "chunk").mapInArrow(run, schema))


def with_chunks(members: DataFrame, home: str, size: int = CHUNK) -> DataFrame:
    """Members in chunks of about ``size`` that mostly share a ``home``: a large home
    is split by hash, small homes are put together."""
    homes = members.groupBy(home).agg(F.count("*").alias("_n"))
    total = F.lit(1 + members.count() // size)
    large = F.col("_n") > size
    return (members.join(homes, home)
            .withColumn("chunk", F.when(large, F.xxhash64(home, F.pmod(F.xxhash64("node"), F.ceil(F.col("_n") / size))))
                        .otherwise(F.pmod(F.xxhash64(home), total)))
            .drop("_n", home))


def bloom_bits(keys: int) -> int:
    """16 bits a key, so that about one other value in 16 passes, from 512 KB to 8 MB."""
    return min(max((16 * keys).bit_length(), BLOOM_BITS), BLOOM_BITS_MOST)


def probably_in(column: str, keys: DataFrame):
    """Condition that is true for every value of ``keys`` and false for most others:
    a bit table put together by aggregation.  It grows with the keys up to
    ``BLOOM_BITS_MOST``; beyond that more of the other values pass."""
    bits = bloom_bits(keys.count())
    place = F.shiftrightunsigned(F.xxhash64(keys.columns[0]), 64 - bits)
    words = (keys.select(F.shiftright(place, 5).alias("word"), F.expr("1L").alias("one"), place.alias("place"))
             .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", "one", F.col("place").bitwiseAND(31).cast("int"))).alias("set"))
             .toArrow())  # at most 2 ** (bits - 5) rows
    filled = np.zeros(1 << (bits - 5), "<u4")
    filled[words["word"].to_numpy()] = words["set"].to_numpy().astype("<u4")
    packed = filled.view(np.uint8)

    @F.arrow_udf("boolean")
    def test(places: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for p in places:
            p = p.to_numpy(zero_copy_only=False)
            yield pa.array((packed[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1)

    return test(F.shiftrightunsigned(F.xxhash64(column), 64 - bits))


def near_duplicates(docs: DataFrame, key: str, text: str, percent: int = 80, width: int = 5) -> DataFrame:
    """Rows ``(key, n_shingles, component_id, kept)``, one per row of ``docs``.

    ``component_id`` is the smallest key reachable over links, the key itself
    included; ``kept`` marks that key.  Null and empty texts have no shingles
    and link with nothing.  Rows of one key are one node: they share a
    component.  A null key takes no part (its component is null, it is kept).
    Columns other than ``key`` and ``text`` are not read.  An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    sig = write_shared(signatures(docs, key, text, width).withColumnRenamed(key, "node"), "signatures")
    # one member for each distinct set
    sets = write_shared(sig.where("set_id is not null and node is not null").groupBy("set_id")
                        .agg(F.min(F.struct("node", F.col("n_shingles").alias("n"), "buckets")).alias("m"))
                        .select("set_id", "m.*"), "sets")
    # both sides of the join read the same shuffle
    placed = sets.select("node", F.explode("buckets").alias("bucket")).repartition("bucket")
    shared = placed.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("high")).where("a <> high")
    placed = write_shared(placed.join(shared.select("bucket", "a"), "bucket").distinct(), "buckets")
    homes = placed.groupBy("node").agg(F.min("a").alias("home"))
    sizes = sets.groupBy("node").agg(F.max("n").alias("n"), F.min("n").alias("n_low"))
    needed = write_shared(with_chunks(write_shared(homes.join(sizes, "node"), "members"), "home"), "members")
    texts = docs.select(F.col(key).alias("node"), F.col(text).cast("string").alias("text")).where("node is not null")
    # texts of other rows that pass the bit table meet no pair in the joins below
    texts = write_shared(texts.where(probably_in("node", needed.select("node"))), "texts")

    stars = placed.where("a <> node").select("a", F.col("node").alias("b")).distinct()
    x, y = needed.alias("x"), needed.alias("y")
    stars = (stars.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
             .where((F.col("x.n") * 100 >= F.col("y.n_low") * percent) & (F.col("y.n") * 100 >= F.col("x.n_low") * percent))
             .select(F.xxhash64("x.chunk", "y.chunk").alias("work"), "a", "b"))
    links = write_shared(confirm(stars, texts, percent, width), "links")
    labels = write_shared(connected_components(links), "labels")

    labelled = (placed.join(labels, "node", "left")
                .select("bucket", "node", F.coalesce("component", "node").alias("component")))
    split = (labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("bucket"))
    left_over = write_shared(labelled.join(split, "bucket").join(needed.select("node", "chunk"), "node"), "left-over")
    # the chunks each member meets in its buckets (a bucket lists chunks, not members)
    meets = left_over.groupBy("bucket").agg(F.collect_set("chunk").alias("chunks"))
    units = (left_over.join(meets, "bucket").groupBy("node", "component", "chunk")
             .agg(F.array_distinct(F.flatten(F.collect_set("chunks"))).alias("chunks"))
             .select("node", "component", "chunk", F.explode("chunks").alias("other"))
             .select(F.xxhash64(F.least("chunk", "other"), F.greatest("chunk", "other")).alias("work"),
                     "chunk", "node", "component"))
    again = texts.where(probably_in("node", left_over.select("node")))
    more = write_shared(confirm_units(units.join(again, "node"), percent, width), "links")
    if not more.isEmpty():
        labels = write_shared(connected_components(links.union(more)), "labels")

    label = sets.select("set_id", "node").join(labels, "node", "left").select("set_id", F.coalesce("component", "node").alias("component"))
    out = sig.select("node", "n_shingles", "set_id").join(label, "set_id", "left")
    # rows of one key share a component, and a key in two components joins them
    if out.where("node is not null").groupBy("node").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").isEmpty():
        comp = F.coalesce("component", "node")
    else:
        bridge = (out.where("component is not null and node is not null").select("node", "component"))
        joined = connected_components(bridge, "node", "component").withColumnRenamed("component", "joined")
        out = out.join(joined, "node", "left")
        comp = F.coalesce("joined", "component", "node")
    out = out.withColumn("component_id", comp)
    return out.select(F.col("node").alias(key), "n_shingles", "component_id",
                      F.coalesce(F.col("node") == F.col("component_id"), F.lit(True)).alias("kept"))
