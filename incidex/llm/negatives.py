"""Hard negatives by Four-Russians scoring.

Vectors are integers: every component x becomes ``floor(256 * x)``.  An anchor
is cut into groups of eight dimensions, and for every group a table of its 256
subset sums is precomputed.  A candidate is stored as bit planes: plane ``b``
packs bit ``b`` of eight neighbouring components into one byte.  The inner
product of an anchor with a whole block of candidates is then a lookup for
each plane and group: the looked-up sums of a plane are added, shifted by the
plane's weight and added up (the sign plane counts negative).  Scores are
complete and exact, no candidate is skipped.

Anchors are a stated query set.  They go to the tasks in blocks of at most
``ANCHORS`` vectors, and each block meets all candidates where these lie, so
candidates are never shuffled and no anchor's candidates meet in one task: a
task keeps the best few of its rows for each anchor, and only those are ranked
together.  The first scan finds the positives, the second one the negatives in
each positive's score window.

A row takes no part with a null id or label, a null vector, or a component
that is null, not finite or beyond ``2 ** 27`` after scaling (scores then fit
64 bits).  Shorter vectors count as filled up with zeros; zero and empty
vectors take part.  Repeated rows are rows of their own as candidates, but one
anchor (the first by label and vector); rows with the anchor's own id are none
of its candidates.  Ties go to the smaller id.  Without anchors the result is
empty.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidex.llm.common import write_shared

ANCHORS = 4096            # anchors that travel together
ANCHORS_AT_ONCE = 64      # anchors whose tables are held at a time
CANDIDATES_AT_ONCE = 4096
SCALE = 256
MOST = 1 << 27
NONE = np.iinfo(np.int64).min


def integer_vectors(rows: DataFrame, key: str, vec: str, label: Column, is_anchor: Column) -> DataFrame:
    """Rows ``(id, label, v, anchor)`` that take part, with integer components."""
    v = F.transform(F.col(vec), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    finite = F.forall(F.col(vec), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= MOST / SCALE))
    return (rows.where(F.col(vec).isNotNull() & finite)
            .select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), v.cast("array<int>").alias("v"),
                    F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
            .where("id is not null and label is not null"))


def dense(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of an Arrow list array, filled up with zeros to ``dims``."""
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), dims), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = \
        lists.flatten().to_numpy(zero_copy_only=False)
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables ``[group, byte, anchor]``: the sum of the anchor's components whose bit is set."""
    n, dims = anchors.shape
    groups = anchors.reshape(n, dims // 8, 8)
    out = np.zeros((dims // 8, 256, n), np.int64)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + groups[:, :, j].T[:, None, :]
    return out


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes ``[plane, group, row]`` of the two's complement bits; the last plane is the sign."""
    most = max(int(vectors.max(initial=0)), ~int(vectors.min(initial=0)))
    planes = most.bit_length() + 1
    out = np.empty((planes, vectors.shape[1] // 8, len(vectors)), np.uint8)
    for b in range(planes):
        out[b] = np.packbits((vectors >> b & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def table_scores(tables: np.ndarray, planes: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """Exact inner products ``[candidate, anchor]`` by lookups, shifts and additions."""
    n_planes, groups, n = planes.shape
    tables = tables.astype(kind, copy=False)
    total = np.zeros((n, tables.shape[2]), kind)
    plane, looked = np.empty_like(total), np.empty_like(total)
    for b in range(n_planes):
        plane.fill(0)
        for g in range(groups):
            np.take(tables[g], planes[b, g], axis=0, out=looked, mode="clip")
            plane += looked
        plane <<= b
        if b == n_planes - 1:
            total -= plane
        else:
            total += plane
    return total


def blocks_of(batches: Iterator[pa.RecordBatch], dims: int):
    """(ids, labels, vectors) of about ``CANDIDATES_AT_ONCE`` rows of a task, in the order of the ids."""
    held, size = [], 0

    def flush():
        ids, labels, v = (np.concatenate([h[c] for h in held]) for c in range(3))
        order = np.argsort(ids, kind="stable")
        held.clear()
        return ids[order], labels[order], v[order]

    for batch in batches:
        for at in range(0, len(batch), CANDIDATES_AT_ONCE):
            b = batch.slice(at, CANDIDATES_AT_ONCE)
            held.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), dense(b.column(2), dims)))
            size += len(b)
            if size >= CANDIDATES_AT_ONCE:
                yield flush()
                size = 0
    if size:
        yield flush()


class Best:
    """The first ``k`` candidates of each of ``n`` queries by (score descending, id ascending)."""

    def __init__(self, n: int, k: int):
        self.score, self.id = np.full((n, k), NONE), np.zeros((n, k), np.int64)

    def least(self, queries: np.ndarray) -> np.ndarray:
        """A lower score is none of the query's best."""
        return np.maximum(self.score[queries, -1], NONE + 1)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer ``scores[candidate, i]`` to ``queries[i]``; ``NONE`` marks no candidate."""
        k = self.score.shape[1]
        high = self.least(queries)
        if len(scores) > k:
            high = np.maximum(high, np.partition(scores, len(scores) - k, axis=0)[len(scores) - k])
        row, q = np.nonzero(scores >= high)
        if not len(row):
            return
        hit = np.unique(q)
        query = np.concatenate([np.repeat(hit, k), q])
        score = np.concatenate([self.score[queries[hit]].ravel(), scores[row, q]])
        own = np.concatenate([self.id[queries[hit]].ravel(), ids[row]])
        order = np.lexsort((own, ~score, query))     # ~ reverses the order without overflow
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[place < k]                     # k rows of every query that was hit
        self.score[queries[hit]] = score[order].reshape(-1, k)
        self.id[queries[hit]] = own[order].reshape(-1, k)

    def rows(self) -> pa.RecordBatch:
        query, place = np.nonzero(self.score > NONE)
        return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(self.id[query, place], pa.int64()),
                                           pa.array(self.score[query, place], pa.int64())], names=["query", "id", "score"])


def _scan(rows: DataFrame, dims: int, anchors: tuple, k: int, windows: np.ndarray | None = None) -> DataFrame:
    """Each task's first ``k`` candidates ``(query, id, score)`` of the anchors of a block.

    Without ``windows`` a query is an anchor, its candidates are the other rows
    of its label.  With ``windows[anchor, slot] = (low, high)`` a query is a
    slot of an anchor, its candidates are the rows of other labels with a score
    between the two.
    """
    a_id, a_label, a_vec = anchors
    slots = 1 if windows is None else windows.shape[1]
    largest = int(np.abs(a_vec).max(initial=0))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(a_id) * slots, k)
        order = np.argsort(a_label, kind="stable")      # anchors of a label lie together
        for ids, labels, v in blocks_of(batches, dims):
            # 32 bits where no sum of a table or a plane can pass them
            small = 2 * dims * max(largest, 1) * max(1, int(np.abs(v).max(initial=0))) < 1 << 30
            kind = np.int32 if small else np.int64
            if windows is None:
                for own in np.unique(a_label):
                    here = np.flatnonzero(labels == own)
                    which = order[a_label[order] == own]
                    if not len(here):
                        continue
                    planes = bit_planes(v[here])
                    for at in range(0, len(which), ANCHORS_AT_ONCE):
                        q = which[at:at + ANCHORS_AT_ONCE]
                        s = table_scores(subset_sums(a_vec[q]), planes, kind).astype(np.int64)
                        s[ids[here][:, None] == a_id[q][None, :]] = NONE
                        best.add(q, s, ids[here])
            else:
                planes = bit_planes(v)
                for at in range(0, len(a_id), ANCHORS_AT_ONCE):
                    q = np.arange(at, min(at + ANCHORS_AT_ONCE, len(a_id)))
                    s = table_scores(subset_sums(a_vec[q]), planes, kind).astype(np.int64)
                    other = labels[:, None] != a_label[q][None, :]
                    other &= ids[:, None] != a_id[q][None, :]
                    for slot in range(slots):
                        low, high = windows[q, slot, 0], windows[q, slot, 1]
                        low = np.maximum(low, best.least(q * slots + slot))
                        fits = other & (s >= low) & (s <= high)
                        here = np.flatnonzero(fits.any(axis=1))
                        if len(here):
                            best.add(q * slots + slot, np.where(fits[here], s[here], NONE), ids[here])
        yield best.rows()

    return rows.select("id", "label", "v").mapInArrow(score, "query long, id long, score long")


def hard_negatives(rows: DataFrame, key: str, vec: str, label: Column, is_anchor: Column, positives: int = 5,
                   negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
                   anchors_at_once: int = ANCHORS) -> DataFrame:
    """The first ``negatives`` rows of other labels for each anchor and each of
    its first ``positives`` rows of its own label, with a score of
    ``low_percent`` to ``high_percent`` of the positive's: rows ``(anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score)``.
    """
    spark = rows.sparkSession
    kept = write_shared(integer_vectors(rows, key, vec, label, is_anchor), "negatives-vectors", spark)
    dims = 8 * max(1, math.ceil((kept.agg(F.max(F.size("v"))).first()[0] or 0) / 8))
    wanted = kept.where("anchor").groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    wanted = write_shared(wanted, "negatives-anchors", spark)
    blocks = max(1, math.ceil(wanted.count() / anchors_at_once))
    found = []
    for b in range(blocks):
        got = wanted.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow().combine_chunks()   # about anchors_at_once rows
        if not len(got):
            continue
        v = got["v"].chunk(0) if got["v"].num_chunks else pa.array([], pa.list_(pa.int32()))
        anchors = (got["id"].to_numpy(), got["label"].to_numpy(), dense(v, dims))
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
        first = _scan(kept, dims, anchors, positives).withColumn("rank", rank).where(F.col("rank") <= positives)
        pos = first.toArrow()      # at most ``positives`` rows an anchor of the block
        q, slot = pos["query"].to_numpy(), pos["rank"].to_numpy().astype(np.int64) - 1
        score = pos["score"].to_numpy()
        windows = np.zeros((len(anchors[0]), positives, 2), np.int64)
        windows[:, :, 0], windows[:, :, 1] = 1, 0            # empty
        windows[q, slot, 0] = [-(-low_percent * int(s) // 100) for s in score]
        windows[q, slot, 1] = [high_percent * int(s) // 100 for s in score]
        names = spark.createDataFrame(pa.table({
            "query": q * positives + slot, "anchor_id": anchors[0][q], "positive_id": pos["id"], "positive_score": score}))
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
        best = _scan(kept, dims, anchors, negatives, windows).withColumn("rank", rank).where(F.col("rank") <= negatives)
        part = (best.join(F.broadcast(names), "query")       # at most ``positives`` rows an anchor of the block
                .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score")))
        found.append(part if blocks == 1 else write_shared(part, "negatives", spark))
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out
