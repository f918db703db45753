"""Nearest neighbours by an adaptive dimension scan over inverted lists.

Inner products become distances by one more component (``sqrt(M^2 - |x|^2)``
with the largest norm ``M``; 0 for queries).  Vectors are rotated by a random
orthogonal matrix and stored dimension-wise in column blocks.  The lists come
from k-means on a bounded sample (``SAMPLE``), and every vector is filed under
its nearest centroid.  A query scans its nearest lists block by block: after
each column block, a hypothesis test on the partial distance abandons the
candidates that cannot come under the query's k-th distance so far.  That
limit comes from the query's nearest list, scanned first; in the other lists
most candidates are abandoned after one block.  The few that stay to the end
are ranked by the inner product of the original vectors in double precision.

A list is cut into chunks of bounded size and its queries into groups, so a
hot list is scanned by many tasks; each gives back at most k candidates a
query.

Vectors that are null, zero or hold null or non-finite components, have
another length than most, or a null id take no part.  Ties go to the smaller
id.  A query's own id is no candidate; a query with fewer candidates than k
gets them all.  Rows of one id are separate candidates.  An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidex.llm.common import write_shared
from incidex.llm.vectors import common_length, matrix, usable

SAMPLE = 16_384
ROWS_A_LIST = 800
MOST_LISTS = 4_096
PROBE_SHARE = 0.68   # of the lists, at every size
CHUNK = 2_048
GROUP = 256
BLOCK = 16
ERROR = 2.1          # of the hypothesis test: larger abandons later
TOLERANCE = 1e-9


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of a sample; starts at evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = ((c * c).sum(axis=1)[None, :] - 2 * x @ c.T).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def adaptive_scan(columns: np.ndarray, query: np.ndarray, limit: float, block: int = BLOCK,
                  error: float = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that survive, and their squared distances.

    ``columns`` holds one rotated dimension a row.  After ``k`` of ``d``
    dimensions the partial squared distance, scaled by ``d / k``, estimates the
    whole; a candidate is abandoned when the estimate exceeds the limit by more
    than the test's error allows."""
    d = len(columns)
    alive, partial = np.arange(columns.shape[1]), np.zeros(columns.shape[1])
    for at in range(0, d, block):
        part = columns[at:at + block][:, alive] - query[at:at + block, None]
        partial = partial + (part * part).sum(axis=0)
        k = min(at + block, d)
        bound = limit if k == d else limit * (k / d) * (1 + error / math.sqrt(k)) ** 2
        stay = partial <= bound + TOLERANCE
        if not stay.all():
            alive, partial = alive[stay], partial[stay]
        if not len(alive):
            break
    return alive, partial


def scan_chunk(ids, columns, vectors, query_id, rotated, query, limit, k: int):
    """The query's k best of a chunk under the limit: ids and exact inner products."""
    own = ids != query_id
    if limit == math.inf:   # the first rows of the chunk set it
        first = min(len(ids), 4 * k)
        head = ((columns[:, :first] - rotated[:, None]) ** 2).sum(axis=0)[own[:first]]
        limit = np.partition(head, k - 1)[k - 1] if len(head) >= k else math.inf
    alive, dist = adaptive_scan(columns, rotated, limit)
    keep = own[alive]
    alive, dist = alive[keep], dist[keep]
    if len(alive) > k:
        close = dist <= np.partition(dist, k - 1)[k - 1] + TOLERANCE
        alive = alive[close]
    score = (vectors[alive] * query).sum(axis=1)
    best = np.lexsort((ids[alive], -score))[:k]
    return ids[alive][best], score[best]


def nearest(vectors: DataFrame, key: str, vec: str, is_query: Column, k: int = 20,
            probe_share: float = PROBE_SHARE, rows_a_list: int = ROWS_A_LIST) -> DataFrame:
    """Rows ``(query_id, rank, key, score)``: for each row where ``is_query``
    holds, its ``k`` nearest other rows by inner product."""
    spark = vectors.sparkSession
    source = (vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
              .select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"), F.col("_query").alias("q")))
    good = source.where(F.col("id").isNotNull() & usable("v"))
    d = common_length(good, "v")
    empty = f"query_id long, rank int, {key} long, score double"
    if d is None:
        return spark.createDataFrame([], empty)
    good = good.where(F.size("v") == d)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, top = good.agg(F.count("*"), F.max(squares)).first()
    lists = min(MOST_LISTS, max(1, n // rows_a_list))
    rotation = np.linalg.qr(np.random.default_rng(20).standard_normal((d + 1, d + 1)))[0]

    def rotated(x: np.ndarray, query: bool) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, top - (x * x).sum(axis=1)))
        return np.column_stack([x, more]) @ rotation

    drawn = good.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < math.ceil(min(1.0, SAMPLE / n) * (1 << 30)))
    sample = np.array([r["v"] for r in drawn.select("id", "v").orderBy("id").limit(2 * SAMPLE).collect()])  # bounded
    centroids = kmeans(rotated(sample.reshape(-1, d), False), lists) if lists > 1 else np.zeros((1, d + 1))
    probes = math.ceil(probe_share * lists)

    @F.arrow_udf("int")
    def own_list(x: pa.Array) -> pa.Array:
        r = rotated(matrix(x), False)
        return pa.array(((centroids * centroids).sum(axis=1) - 2 * r @ centroids.T).argmin(axis=1), pa.int32())

    @F.arrow_udf("array<int>")
    def probed(x: pa.Array) -> pa.Array:
        r = rotated(matrix(x), True)
        order = np.argsort((centroids * centroids).sum(axis=1) - 2 * r @ centroids.T, axis=1, kind="stable")
        return pa.array([row for row in order[:, :probes].astype(np.int32)], pa.list_(pa.int32()))

    def packed(rows: DataFrame, size: int, query: bool) -> DataFrame:
        """Rows ``(list, id, v, limit)`` as rows of at most ``size`` vectors of one list."""
        counts = rows.groupBy("list").agg(F.count("*").alias("n"))
        dealt = (rows.join(F.broadcast(counts), "list")   # one row a list, at most MOST_LISTS
                 .withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / size))))
        schema = "list int, ids array<long>, vectors binary, columns binary, limits array<double>"

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, ids, vs, limits = None, [], [], []

            def row():
                x = np.array(vs)
                r = rotated(x, query)
                return pa.RecordBatch.from_arrays(
                    [pa.array([now[0]], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()),
                     pa.array([np.ascontiguousarray(r if query else r.T).tobytes()], pa.binary()),
                     pa.array([limits], pa.list_(pa.float64()))],
                    names=["list", "ids", "vectors", "columns", "limits"])

            for batch in batches:
                for a, part, i, v, limit in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                    if ids and ((a, part) != now or len(ids) >= size):
                        yield row()
                        ids, vs, limits = [], [], []
                    now = (a, part)
                    ids.append(i)
                    vs.append(v)
                    limits.append(limit)
            if ids:
                yield row()

        return (dealt.repartition("list", "part").sortWithinPartitions("list", "part", "id")
                .select("list", "part", "id", "v", "limit").mapInArrow(pack, schema))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(batch.num_rows):
                ids, v, c, query_ids, queries, r, limits = (batch.column(i)[x] for i in range(7))
                ids, query_ids, limits = np.array(ids.as_py()), query_ids.as_py(), limits.as_py()
                v = np.frombuffer(v.as_buffer(), np.float64).reshape(len(ids), d)
                c = np.frombuffer(c.as_buffer(), np.float64).reshape(d + 1, len(ids))
                queries = np.frombuffer(queries.as_buffer(), np.float64).reshape(len(query_ids), d)
                r = np.frombuffer(r.as_buffer(), np.float64).reshape(len(query_ids), d + 1)
                got = [scan_chunk(ids, c, v, q, r[i], queries[i], limits[i], k) for i, q in enumerate(query_ids)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, [len(g[0]) for g in got]), pa.int64()),
                     pa.array(np.concatenate([g[0] for g in got]), pa.int64()),
                     pa.array(np.concatenate([g[1] for g in got]), pa.float64())], names=["query_id", "id", "score"])

    def scanned(queries: DataFrame) -> DataFrame:
        asked = packed(queries, GROUP, True).select("list", F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"),
                                                    F.col("columns").alias("rotated"), "limits")
        return (index.join(asked, "list").select("ids", "vectors", "columns", "query_ids", "queries", "rotated", "limits")
                .mapInArrow(scan, "query_id long, id long, score double"))

    index = write_shared(packed(good.select(own_list("v").alias("list"), "id", "v", F.lit(0.0).alias("limit")), CHUNK, False)
                         .drop("limits"), "index")
    queries = good.where("q").select("id", "v", probed("v").alias("lists"))
    first = write_shared(scanned(queries.select(F.col("lists")[0].alias("list"), "id", "v", F.lit(math.inf).alias("limit"))), "nearest-list")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    limits = first.withColumn("r", best).where(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("score").alias("worst"))
    found = first
    if probes > 1:
        distance = (F.lit(top) + F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)) * (1 + TOLERANCE) - 2 * F.col("worst")
        rest = (queries.join(limits, "id", "left")
                .select(F.explode(F.slice("lists", 2, probes)).alias("list"), "id", "v",
                        F.coalesce(distance + TOLERANCE, F.lit(math.inf)).alias("limit")))
        found = first.union(scanned(rest))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")).cast("int")
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(key), "score"))
