"""Near-duplicate vectors by an epsilon grid order join.

Vectors of length one within the wanted cosine lie within a distance eps.
They are rotated to principal dimensions and sorted by their grid cells (of
width eps) on the leading ones, within each label.  The sequence is cut into
intervals of bounded size, each with its bounding box.  Interval pairs are
found by an equi-join on the cells of the first two dimensions and kept when
their boxes are at most eps apart.  In a task, a pair of intervals is joined
recursively: halves whose boxes are provably distant are skipped, small parts
are compared directly.

Exact copies are one weighted vector, so a group of copies is compared once
however many rows it holds; its rows take the result of the smallest id.

An interval pair gives back each vector's number of links and one edge to the
representative of its component inside the pair, so a group of ``m`` copies
makes rows in proportion to ``m`` for each pair of intervals and no list of
pairs.  Edges give components.

Vectors that are null, zero or hold null or non-finite components, and rows
with a null label or id, link with nothing.  Vectors of different lengths are
not compared.  Rows of one id are not linked with each other and share their
number of links; repeated rows count once; equal vectors are ordinary links.  An empty table gives an
empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidex.llm.common import connected_components, write_shared
from incidex.llm.vectors import common_length, matrix, usable

LEADING = 6
INTERVAL = 512
SMALL = 64
SLACK = 1e-9


def principal_axes(vectors: DataFrame, vec: str, d: int) -> np.ndarray:
    """Orthogonal axes by falling variance of the unit vectors of length ``d``."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((d + 1, d)), 0
        for batch in batches:
            x = matrix(batch.column(0))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total[:d] += x.T @ x
            total[d] += x.sum(axis=0)
            n += len(x)
        yield pa.RecordBatch.from_pydict({"place": np.arange(-1, total.size), "value": np.concatenate([[float(n)], total.ravel()])})

    got = (vectors.where(F.size(vec) == d).select(vec).mapInArrow(moments, "place long, value double")
           .groupBy("place").agg(F.sum("value").alias("value")).toPandas())   # d * (d + 1) + 1 rows
    value = got.sort_values("place")["value"].to_numpy()
    if not len(value) or value[0] < 1:
        return np.eye(d)
    m = value[1:].reshape(d + 1, d) / value[0]
    spread, axes = np.linalg.eigh(m[:d] - np.outer(m[d], m[d]))
    return axes[:, np.argsort(-spread)]


def join_intervals(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, cosine: float, eps: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (unit vectors, with leading projections) are
    within the cosine: recursion over halves of the two sequences."""
    hit = np.zeros((len(a), len(b)), bool)
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        gap = np.maximum(0, np.maximum(pa_[i:j].min(axis=0) - pb[k:m].max(axis=0), pb[k:m].min(axis=0) - pa_[i:j].max(axis=0)))
        if (gap * gap).sum() > eps * eps + SLACK:
            continue
        if j - i <= SMALL and m - k <= SMALL:
            hit[i:j, k:m] = a[i:j] @ b[k:m].T >= cosine
            continue
        cut_a = [(i, (i + j) // 2), ((i + j) // 2, j)] if j - i > SMALL else [(i, j)]
        cut_b = [(k, (k + m) // 2), ((k + m) // 2, m)] if m - k > SMALL else [(k, m)]
        todo += [(*x, *y) for x in cut_a for y in cut_b]
    return hit


def representatives(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For linked rows and columns, the row that stands for their component (-1: no link)."""
    n = hit.shape[0]
    rows = np.where(hit.any(axis=1), np.arange(n), n)
    while True:
        cols = np.where(hit, rows[:, None], n).min(axis=0)
        new = np.minimum(rows, np.where(hit, cols[None, :], n).min(axis=1))
        if (new == rows).all():
            break
        rows = new
    return np.where(rows < n, rows, -1), np.where(cols < n, cols, -1)


def near_duplicate_vectors(vectors: DataFrame, key: str, vec: str, label: str, cosine: float = 0.98) -> DataFrame:
    """Rows ``(key, n_links, component_id, kept)``, one per row of ``vectors``."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    id_type = "long" if dict(vectors.dtypes)[key] in ("int", "bigint", "smallint", "tinyint") else dict(vectors.dtypes)[key]
    takes_part = F.col("label").isNotNull() & F.col("id").isNotNull() & F.coalesce(usable("v"), F.lit(False))
    # rows that take part are known by a 128-bit print of group and vector, others by their id
    prints = [F.when(takes_part, F.xxhash64(F.lit(i), "group", "v")).otherwise(F.xxhash64(F.lit(-1 - i), "id")).alias(f"h{i}")
              for i in range(2)]
    source = (vectors.select(F.col(key).cast(id_type).alias("id"), F.col(vec).alias("v"), F.col(label).alias("label"))
              .withColumn("group", F.concat_ws("/", F.col("label").cast("string"), F.size("v").cast("string"))))
    rows = source.select("id", takes_part.alias("good"), *prints)
    copies = write_shared(rows.where("good").groupBy("h0", "h1").agg(F.min("id").alias("first"), F.count("*").alias("c"),
                                                                      F.count_distinct("id").alias("m"))
                          .where("c > 1").select("h0", "h1", "first", "m"), "vector-copies")
    good = source.where(takes_part).groupBy("group", "v").agg(F.min("id").alias("id"))
    good = (good.withColumns({f"h{i}": F.xxhash64(F.lit(i), "group", "v") for i in range(2)})
            .join(copies.select("h0", "h1", "m"), ["h0", "h1"], "left")
            .select("group", "id", F.col("v").cast("array<double>").alias("v"), F.coalesce("m", F.lit(1)).alias("m")))
    plain = source.where(takes_part).select(F.col("v").cast("array<double>").alias("v"))
    d = common_length(plain, "v")
    axes = principal_axes(plain, "v", d) if d else np.eye(1)

    @F.arrow_udf("array<double>")
    def projections(lists: pa.Array) -> pa.Array:
        out = []
        for v in lists:
            x = np.array(v.as_py())
            x /= np.linalg.norm(x)
            x = x @ axes[:, :LEADING] if len(x) == len(axes) else x[:LEADING]
            out.append(np.pad(x, (0, LEADING - len(x))))
        return pa.array(out, pa.list_(pa.float64()))

    cells = [F.floor(F.col("p")[i] / eps).alias(f"c{i}") for i in range(LEADING)]
    names = ["group", *(f"c{i}" for i in range(LEADING)), "id"]
    ordered = (good.withColumn("p", projections("v"))
               .select("group", "id", "v", "p", "m", *cells)
               .repartitionByRange(*names).sortWithinPartitions(*names))

    # intervals of the sequence as rows
    interval = f"block long, grp string, n int, lo array<double>, hi array<double>, ids array<{id_type}>, m binary, v binary, p binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, at = TaskContext.get().partitionId(), 0
        group, ids, vs, ps, ms = None, [], [], [], []

        def row():
            nonlocal at
            v, p = np.array(vs), np.array(ps)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            out = pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + at], pa.int64()), pa.array([group]), pa.array([len(ids)], pa.int32()),
                 pa.array([p.min(axis=0)], pa.list_(pa.float64())), pa.array([p.max(axis=0)], pa.list_(pa.float64())),
                 pa.array([ids], pa.list_(id_arrow)), pa.array([np.array(ms, np.int64).tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary()), pa.array([p.tobytes()], pa.binary())],
                names=["block", "grp", "n", "lo", "hi", "ids", "m", "v", "p"])
            at += 1
            return out

        for batch in batches:
            id_arrow = batch.schema.field(1).type
            for g, i, v, p, m in zip(*(batch.column(x).to_pylist() for x in range(5)), strict=True):
                if ids and (g != group or len(ids) >= INTERVAL):
                    yield row()
                    ids, vs, ps, ms = [], [], [], []
                group = g
                ids.append(i)
                vs.append(v)
                ps.append(p)
                ms.append(m)
        if ids:
            yield row()

    blocks = write_shared(ordered.select("group", "id", "v", "p", "m").mapInArrow(cut, interval), "intervals")

    # interval pairs that share a cell of the first two dimensions, boxes at most eps apart
    def cells_of(i, margin):
        return F.sequence(F.floor((F.col("lo")[i] - margin) / eps), F.floor((F.col("hi")[i] + margin) / eps))

    def spread(margin, name):
        return (blocks.select("grp", "block", "lo", "hi", F.explode(cells_of(0, margin)).alias("x0"))
                .select("grp", "block", "lo", "hi", "x0", F.explode(cells_of(1, margin)).alias("x1")).alias(name))

    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col("a.lo")[i] - F.col("b.hi")[i], F.col("b.lo")[i] - F.col("a.hi")[i]), 2)
               for i in range(LEADING)), F.lit(0.0))
    pairs = (spread(eps, "a").join(spread(0.0, "b"), (F.col("a.grp") == F.col("b.grp")) & (F.col("a.x0") == F.col("b.x0"))
                                   & (F.col("a.x1") == F.col("b.x1")) & (F.col("a.block") <= F.col("b.block"))
                                   & (gap <= eps * eps + SLACK))
             .select(F.col("a.block").alias("a"), F.col("b.block").alias("b")).distinct())
    left = blocks.select(F.col("block").alias("a"), F.col("ids").alias("ids_a"), F.col("m").alias("m_a"), F.col("v").alias("v_a"), F.col("p").alias("p_a"))
    right = blocks.select(F.col("block").alias("b"), F.col("ids").alias("ids_b"), F.col("m").alias("m_b"), F.col("v").alias("v_b"), F.col("p").alias("p_b"))
    work = pairs.join(left, "a").join(right, "b").select("a", "b", "ids_a", "v_a", "p_a", "m_a", "ids_b", "v_b", "p_b", "m_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_arrow = batch.schema.field(2).type.value_type
            for x in range(batch.num_rows):
                same = batch.column(0)[x].as_py() == batch.column(1)[x].as_py()
                ia, ib = (np.array(batch.column(c)[x].as_py()) for c in (2, 6))
                a, b = (np.frombuffer(batch.column(c)[x].as_buffer(), np.float64).reshape(len(i), -1) for c, i in ((3, ia), (7, ib)))
                qa, qb = (np.frombuffer(batch.column(c)[x].as_buffer(), np.float64).reshape(len(i), -1) for c, i in ((4, ia), (8, ib)))
                ma, mb = (np.frombuffer(batch.column(c)[x].as_buffer(), np.int64) for c in (5, 9))
                hit = join_intervals(a, b, qa, qb, cosine, eps)
                hit &= ia[:, None] != ib[None, :]
                if not hit.any():
                    continue
                # inside one interval a row and its column are one vector
                rows, cols = representatives(hit | np.diag(hit.any(axis=1)) if same else hit)
                ids = [ia[rows >= 0]] + ([] if same else [ib[cols >= 0]])
                n = [(hit @ mb)[rows >= 0]] + ([] if same else [(ma @ hit)[cols >= 0]])
                to = [ia[rows[rows >= 0]]] + ([] if same else [ia[cols[cols >= 0]]])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), id_arrow), pa.array(np.concatenate(n), pa.int64()),
                                                  pa.array(np.concatenate(to), id_arrow)], names=["id", "n", "to"])

    found = write_shared(work.mapInArrow(compare, f"id {id_type}, n long, to {id_type}"), "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n_links"))
    label_of = connected_components(found.where("id <> to"), "id", "to").withColumnRenamed("node", "id")
    known = (rows.join(copies, ["h0", "h1"], "left")
             .select(F.col("id").alias("row"), F.coalesce("first", "id").alias("id"), F.coalesce(F.col("m") - 1, F.lit(0)).alias("alike")))
    out = (known.join(counts, "id", "left").join(label_of, "id", "left")
           .select(F.col("row").alias(key), (F.coalesce("n_links", F.lit(0)) + F.col("alike")).alias("n_links"),
                   F.coalesce("component", "id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
