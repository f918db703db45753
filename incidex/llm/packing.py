"""Packing documents into fixed-length token sequences.

Method: Martello-Toth dominance reduction, then best fit.  The plan is made on
the histogram of piece lengths, which has at most ``capacity`` rows however
many documents there are.  For the longest remaining length, sets of at most
three pieces are examined: a set is fixed for good, as often as its lengths
allow, when it provably dominates every other set the piece could share a
sequence with (every alternative can be exchanged into it piece by piece).
What no proof covers is packed by best fit, longest first, into the fullest
sequence that still has room.

Pieces then take the plan's places by their rank among pieces of the same
length.  Ranks are counted in salted groups, so a length that holds a third of
all pieces is ranked by many tasks.  Only the histogram passes through the
driver; the plan travels with the function that looks places up.

Null and empty texts are one end token; null keys and repeated rows are packed
like any other (equal rows are interchangeable, ties in length go by key);
texts of any length are cut piece by piece; an empty table stays empty; the
caller's columns stay as they are, whatever their names (``sequence_id`` and
``offset`` are appended).
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from incidex.llm.common import write_shared
from incidex.llm.memory import held
from incidex.llm.pieces import PieceStore, blank_free_pieces, by_bytes, texts_by_size

CHUNK_CHARS = 1 << 20
ENCODE_BYTES = 1 << 18
ROWS_IN_GROUP = 50_000
REMEMBERED_BYTES = 192 << 20    # of a worker


# -- tokens -------------------------------------------------------------------
def _store(path: str, budget: int) -> PieceStore:
    """Encoder of a tokenizer file that drops white space, piece by piece."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers
    t = tokenizers.Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()

    def learn(new):
        ids, sizes = [], []
        for batch in by_bytes(new, ENCODE_BYTES):
            found = t.encode_batch_fast(batch, add_special_tokens=False)
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(chain.from_iterable(e.ids for e in found), np.int32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    return PieceStore(blank_free_pieces, learn, budget)


def token_pieces(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int,
                 end_id: int = 0, with_ids: bool = False, remembered: int = REMEMBERED_BYTES) -> DataFrame:
    """Cut every document's token ids into pieces of at most ``capacity``.

    A document is its ids (a tokenizer that drops white space, no special
    tokens added) and then ``end_id``; null and empty texts are ``end_id``
    alone.  Only documents longer than ``capacity`` are cut, the last piece may
    be shorter.  Rows: the key, ``piece`` (from 0), ``start`` (the document's
    ids before it), ``length``, ``ids_crc32`` (CRC-32 of the little-endian
    32-bit ids) and, if asked for, ``ids``.  A null key or a repeated row is
    cut like any other; other columns are not read.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = held("packing", (tokenizer, remembered), lambda: _store(tokenizer, remembered))
        for batch in batches:
            at = 0
            for texts in texts_by_size(batch.column(1), CHUNK_CHARS):
                keys = batch.column(0).slice(at, len(texts))
                at += len(texts)
                ends, ids = store.encode(texts)
                doc, piece, start, length, crc, lists = [], [], [], [], [], []
                for x, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                    own = np.append(ids[a:b], end_id).astype("<u4")
                    for p, begin in enumerate(range(0, len(own), capacity)):
                        part = own[begin:begin + capacity]
                        doc.append(x)
                        piece.append(p)
                        start.append(begin)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            lists.append(part.astype(np.int32))
                cols = [keys.take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(cut, schema)


# -- the plan -------------------------------------------------------------------
def dominating_set(count: np.ndarray, size: int, capacity: int) -> list[int] | None:
    """The set holding ``size`` that provably dominates all others, or None.

    ``count[s]`` is the number of pieces of length ``s``.  With ``a`` the
    longest piece that fits beside ``size``:

    * nothing fits: the piece alone;
    * ``a`` fills the rest, or no two pieces fit: ``{size, a}``;
    * no three pieces fit, and ``a`` is as long as any two that fit:
      ``{size, a}``;
    * no three pieces fit, ``b`` is the longest that fits beside both, and no
      two pieces longer than ``b`` fit: ``{size, a, b}`` (of any other two, the
      longer can be exchanged with ``a`` and the shorter with ``b``).
    """
    room = capacity - size
    left = count.copy()
    left[size] -= 1
    sizes = np.flatnonzero(left[:room + 1])
    if not len(sizes):
        return [size]
    a = int(sizes[-1])
    if a == room:
        return [size, a]
    smallest = np.repeat(sizes[:3], np.minimum(left[sizes[:3]], 3))[:3]
    if len(smallest) < 2 or smallest[:2].sum() > room:
        return [size, a]
    if len(smallest) == 3 and smallest.sum() <= room:
        return None
    best = 0  # the longest two that fit together
    lo, hi = 0, len(sizes) - 1
    while lo <= hi:
        pair = int(sizes[lo] + sizes[hi])
        if pair > room:
            hi -= 1
        else:
            if lo != hi or left[sizes[lo]] > 1:
                best = max(best, pair)
            lo += 1
    if a >= best:
        return [size, a]
    left[a] -= 1
    beside = np.flatnonzero(left[:room - a + 1])
    if not len(beside):
        return None
    b = int(beside[-1])
    left[a] += 1
    longer = b + 1 + np.flatnonzero(left[b + 1:room + 1])
    two = np.repeat(longer[:2], np.minimum(left[longer[:2]], 2))[:2]
    if len(two) < 2 or two.sum() > room:
        return [size, a, b]
    return None


def reduce_by_dominance(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets, longest piece first, until no proof applies; ``count``
    keeps what remains.  A set is fixed as often as its lengths allow: taking
    pieces away only removes alternatives."""
    fixed = []
    again = True
    while again:
        again = False
        for size in range(capacity, 0, -1):
            while count[size]:
                found = dominating_set(count, size, capacity)
                if found is None:
                    break
                need = Counter(found)
                times = min(int(count[s]) // n for s, n in need.items())
                for s, n in need.items():
                    count[s] -= n * times
                fixed.append((tuple(found), times))
                again = True
    return fixed


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on a histogram: equal sequences are one entry."""
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room, held, times):
        if times:
            if room not in bins:
                bins[room] = []
                insort(rooms, room)
            bins[room].append((held, times))

    for size in range(capacity, 0, -1):
        n = int(count[size])
        while n:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                held, times = bins[room].pop()
                if not bins[room]:
                    del bins[room], rooms[at]
            else:
                room, held, times = capacity, (), n
            each = room // size  # the fullest sequence that fits takes as many as it can
            full, rest = divmod(min(n, each * times), each)
            put(room - each * size, held + (size,) * each, full)
            if rest:
                put(room - rest * size, held + (size,) * rest, 1)
            if held:
                put(room, held, times - full - bool(rest))
            n -= full * each + rest
    return [entry for some in bins.values() for entry in some]


def packing_plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences) for all pieces."""
    count = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        count[size] = n
    fixed = reduce_by_dominance(count, capacity)
    return fixed + best_fit(count, capacity)


# -- places ---------------------------------------------------------------------
def pack(pieces: DataFrame, keys: list[str], length: str, capacity: int) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset``; other columns stay.

    ``pieces`` should be a written table: it is read twice.  ``keys`` name a
    piece (ties are told apart by the remaining columns' hash; equal rows are
    interchangeable).  Lengths must lie in 1..capacity; a row with another or
    a null length gets a null place.  An empty table stays empty.
    """
    spark = pieces.sparkSession
    hist = {int(r[0]): int(r[1]) for r in
            pieces.where(F.col(length).between(1, capacity)).groupBy(length).count().collect()}  # <= capacity rows
    plan = packing_plan(hist, capacity)
    # places of one length in the order they are handed out: rank -> sequence, offset
    size, low, first, offset = [], [], [], []
    taken: Counter = Counter()
    sequence = 0
    for held, times in plan:
        at = 0
        for s in held:
            size.append(s)
            low.append(taken[s])
            first.append(sequence)
            offset.append(at)
            taken[s] += times
            at += s
        sequence += times
    size, low = np.array(size, np.int64), np.array(low, np.int64)
    order = np.lexsort((low, size))
    total = max(taken.values(), default=0) + 1
    begins = size[order] * total + low[order]
    low, first, offset = low[order], np.array(first, np.int64)[order], np.array(offset, np.int64)[order]

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(sizes: pa.Array, ranks: pa.Array) -> pa.Array:
        null = np.asarray(sizes.is_null()) | np.asarray(ranks.is_null())
        s = sizes.fill_null(1).to_numpy(zero_copy_only=False)
        r = ranks.fill_null(0).to_numpy(zero_copy_only=False)
        null |= (s < 1) | (s > capacity)
        at = np.searchsorted(begins, np.where(null, 0, s * total + r), side="right") - 1
        at = np.maximum(at, 0)
        return pa.StructArray.from_arrays(
            [pa.array(first[at] + r - low[at], pa.int64(), mask=null) if len(first) else pa.nulls(len(s), pa.int64()),
             pa.array(offset[at], pa.int64(), mask=null) if len(first) else pa.nulls(len(s), pa.int64())],
            names=["sequence_id", "offset"])

    # a length gets as many salted groups as its pieces need, so there are at most
    # capacity + all pieces / share groups
    spread = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, min(ROWS_IN_GROUP, sum(hist.values()) // spread))
    groups = F.lit([max(1, -(-hist.get(s, 0) // share)) for s in range(capacity + 1)])
    salts = F.coalesce(F.get(groups, F.when(F.col(length).between(1, capacity), F.col(length)).cast("int")), F.lit(spread))
    known = pieces.columns
    row = "r"        # all of the caller's columns travel as one, so no name can clash
    salted = pieces.select(F.struct(*known).alias(row), F.col(length).alias("size"), F.struct(*keys).alias("key"),
                           F.xxhash64(*known).alias("hash"), salts.alias("salts"))
    salted = salted.withColumn("salt", F.pmod("hash", "salts")).drop("salts")
    before = (salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("salt")) - F.col("n"))
              .select(F.col("size").alias("size2"), F.col("salt").alias("salt2"), "before"))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("size", "salt").orderBy("key", "hash")) - 1)
    joined = ranked.join(before, (F.col("size") == F.col("size2")) & (F.col("salt") == F.col("salt2")), "left")
    return (joined.withColumn("place", place(F.col("size").cast("long"), F.col("rank") + F.col("before")))
            .select(f"{row}.*", F.col("place.sequence_id").alias("sequence_id"), F.col("place.offset").alias("offset")))


def pack_documents(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int,
                   end_id: int = 0, remembered: int = REMEMBERED_BYTES) -> DataFrame:
    """Token pieces of all documents with their places: the pieces are written to
    the shared folder once (without ids) and packed from there.  ``remembered``
    bounds what a worker keeps of encoded words."""
    pieces = write_shared(token_pieces(docs, key, text, tokenizer, capacity, end_id, remembered=remembered), "pieces")
    return pack(pieces, [key, "piece"], "length", capacity)
