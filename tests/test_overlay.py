"""Union of overlapping parts against an exact slab sum."""

import random

import pytest
from pyspark.sql import functions as F

from incidex.operators.overlay import split_at_crossings, union_parts
from incidex.operators.spatial import dissolve, edges_area, zone_edges


def ring(points):
    points = [*points, points[0]]
    return [(float(x), float(y)) for x, y in points]


def frame(spark, parts):
    rows = [(k, [[(x, y) for x, y in r] for r in rings]) for k, rings in parts]
    return zone_edges(spark.createDataFrame(rows, "grp int, rings array<array<struct<x:double,y:double>>>"), ["grp"])


def covered_area(parts):
    """Area covered by any part: between neighbouring places of a corner or crossing
    the covered length is linear, so the middle of each slab gives it exactly."""
    edges = [[(a, b) for r in rings for a, b in zip(r[:-1], r[1:])] for rings in parts]
    flat = [e for es in edges for e in es]
    xs = {p[0] for e in flat for p in e}
    for i, ((x1, y1), (x2, y2)) in enumerate(flat):
        for (x3, y3), (x4, y4) in flat[:i]:
            d = (x2 - x1) * (y4 - y3) - (y2 - y1) * (x4 - x3)
            if d:
                t = ((x3 - x1) * (y4 - y3) - (y3 - y1) * (x4 - x3)) / d
                if 0 <= t <= 1:
                    xs.add(x1 + t * (x2 - x1))
    xs, total = sorted(xs), 0.0
    for a, b in zip(xs[:-1], xs[1:]):
        x, spans = (a + b) / 2, []
        for es in edges:
            ys = sorted(y1 + (x - x1) / (x2 - x1) * (y2 - y1) for (x1, y1), (x2, y2) in es if (x1 > x) != (x2 > x))
            spans += list(zip(ys[::2], ys[1::2]))
        length, end = 0.0, float("-inf")
        for low, high in sorted(spans):
            length += max(0.0, high - max(low, end))
            end = max(end, high)
        total += length * (b - a)
    return total


def random_parts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(12):
        x, y = rng.uniform(0, 4), rng.uniform(0, 4)
        out.append([ring([(x, y), (x + rng.uniform(.3, 2), y + rng.uniform(-.5, .5)), (x + rng.uniform(0, 1), y + rng.uniform(.6, 2))])])
    for _ in range(6):      # on a coarse lattice: shared corners, shared pieces of sides, equal parts
        x, y, w, h = rng.randint(0, 4), rng.randint(0, 4), rng.randint(1, 3), rng.randint(1, 3)
        out.append([ring([(x, y), (x + w, y), (x + w, y + h), (x, y + h)])])
    return out + out[-2:]


def box(x0, y0, x1, y1):
    return ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


SHAPES = {
    100: [[box(0, 0, 2, 2)], [box(1, 1, 3, 3)]],                                    # crossing
    101: [[box(0, 0, 4, 4)], [box(1, 1, 2, 2)]],                                    # one inside the other
    102: [[box(0, 0, 4, 4), box(1, 1, 3, 3)], [box(2, 2, 5, 5)]],                   # a hole partly filled
    103: [[box(0, 0, 1, 1)], [box(0, 0, 1, 1)], [box(0, 0, 1, 1)]],                 # equal parts
    104: [[box(0, 0, 1, 1)], [box(1, 0, 2, 1)], [box(1, 1, 2, 2)], [box(5, 5, 6, 6)]],   # touching, a corner, apart
    105: [[ring([(0, 0), (4, 4), (0, 4)])], [ring([(1, 0), (5, 0), (1, 4)])], [ring([(0, 2), (3, 2), (3, 3), (0, 3)])]],
    106: [[box(0, 0, 4, 4), box(1, 1, 3, 3)], [box(1, 1, 3, 3)]],                   # a hole filled exactly
}


@pytest.mark.parametrize("cell", [None, 0.37, 5.0])
def test_area_equals_the_covered_area(spark, cell):
    groups = {**SHAPES, **({s: random_parts(s) for s in range(6)} if cell is None else {1: random_parts(1)})}
    edges = frame(spark, [(k, p) for k, parts in groups.items() for p in parts])
    union = union_parts(edges, ["grp"], cell).cache()
    got = {r.grp: r.area for r in edges_area(union, ["grp"]).collect()}
    assert set(got) == set(groups)
    for k, parts in groups.items():
        assert abs(got[k] - covered_area(parts)) < 1e-7, k
    # every boundary closes: as many pieces begin at a place as end there
    ends = union.select("grp", F.round("x1", 8).alias("x"), F.round("y1", 8).alias("y"), F.lit(1).alias("n")) \
        .union(union.select("grp", F.round("x2", 8), F.round("y2", 8), F.lit(-1)))
    assert ends.groupBy("grp", "x", "y").agg(F.sum("n").alias("n")).where("n <> 0").count() == 0


def test_disjoint_parts_as_dissolve(spark):
    parts = [(1, [box(i, 0, i + 1, 1)]) for i in range(4)] + [(2, [box(0, 0, 1, 1)])]
    edges = frame(spark, parts)
    assert sorted(map(tuple, union_parts(edges, ["grp"]).collect())) == sorted(map(tuple, dissolve(edges, ["grp"]).collect()))
    assert union_parts(edges.limit(0), ["grp"]).count() == 0


def test_crossing_is_one_vertex_of_both_edges(spark):
    edges = frame(spark, [(1, SHAPES[100][0]), (1, SHAPES[100][1])])
    cut = split_at_crossings(edges, ["grp"], 0.7)
    assert cut.count() == 12 and cut.where("x1 = 1 AND y1 = 2").count() == 2 and cut.where("x1 = 2 AND y1 = 1").count() == 2


def test_no_join_of_edges_is_broadcast(spark):
    from incidex.operators.overlay import covered_sides
    from incidex.operators.spatial import net_edges, split_at_vertices
    edges = frame(spark, [(i % 3, p) for i, p in enumerate(random_parts(5))])
    pieces = net_edges(union_parts(edges, ["grp"], 1.0), ["grp"])
    for df in (split_at_crossings(edges, ["grp"], 1.0), split_at_vertices(edges, ["grp"], 1.0), covered_sides(pieces, ["grp"], 1.0)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
