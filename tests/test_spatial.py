"""Grid spatial join and dissolve against brute force."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from incidex.functions.geometry import area_km2_mercator, orient_rings
from incidex.operators.spatial import dissolve, edges_area, spatial_join, zone_edges

SQUARE = [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]
ELL = [[(0, 0), (1, 0), (1, .5), (.5, .5), (.5, 1), (0, 1), (0, 0)]]
HOLE = SQUARE + [[(.25, .25), (.25, .75), (.75, .75), (.75, .25), (.25, .25)]]


def zones_df(spark, shapes):
    """shapes: {zone_id: (dx, dy, rings)} -> zone parts DataFrame."""
    rows = [(zid, [[{"x": float(x + dx), "y": float(y + dy)} for x, y in ring] for ring in rings])
            for zid, (dx, dy, rings) in shapes.items()]
    return spark.createDataFrame(rows, "zone_id int, rings array<array<struct<x:double,y:double>>>")


def py_inside(px, py, rings):
    """Brute force: boundary inclusive even-odd test."""
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            cross = (x2 - x1) * (py - y1) - (px - x1) * (y2 - y1)
            if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            if (y1 > py) != (y2 > py) and cross * (1 if y2 > y1 else -1) > 0:
                inside = not inside
    return inside


SHAPES = {1: (0, 0, SQUARE), 2: (1, 0, ELL), 3: (0, 1, HOLE), 4: (1, 1, SQUARE)}


def brute(points, shapes):
    out = set()
    for pid, px, py in points:
        for zid, (dx, dy, rings) in shapes.items():
            if py_inside(px, py, [[(x + dx, y + dy) for x, y in r] for r in rings]):
                out.add((pid, zid))
    return out


def run_join(spark, points, cell, broadcast_limit=None):
    pts = spark.createDataFrame(points, "pid int, x double, y double")
    edges = zone_edges(zones_df(spark, SHAPES), ["zone_id"])
    j = spatial_join(pts, edges, ["zone_id"], cell=cell, broadcast_limit=broadcast_limit)
    return j, {(r.pid, r.zone_id) for r in j.collect()}


def test_borders_and_corners(spark):
    pts = [(0, .5, .5), (1, 1.0, .5), (2, 1.5, .5), (3, 1.75, .75), (4, .5, 1.5), (5, 1.0, 1.0),
           (6, .25, 1.5), (7, 2.0, 2.0), (8, 3.0, 3.0), (9, 1.5, .5), (10, 0.0, 0.0)]
    for cell in (1.0, 0.3, 2.5):
        _, got = run_join(spark, pts, cell)
        assert got == brute(pts, SHAPES), cell
    _, got = run_join(spark, pts, 1.0)
    assert (1, 1) in got and (1, 2) in got          # shared border matches both
    assert (4, 3) not in got and (6, 3) in got      # strictly inside the hole / on its ring
    assert (5, 1) in got and (5, 4) in got          # a corner shared by four cells


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8)), min_size=1, max_size=40),
       st.sampled_from([0.25, 0.5, 1.0, 1.7]))
def test_join_property(spark, coords, cell):
    pts = [(i, x / 4.0, y / 4.0) for i, (x, y) in enumerate(coords)]
    _, got = run_join(spark, pts, cell)
    assert got == brute(pts, SHAPES)


def test_plan_is_equi_join(spark):
    j, _ = run_join(spark, [(0, .5, .5)], 1.0)
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_cell_table_broadcast_only_under_measured_limit(spark):
    pts = [(0, .5, .5), (1, 1.0, .5), (2, 1.5, .5), (3, .25, 1.5), (4, 1.0, 1.0)]
    small, got_small = run_join(spark, pts, 0.5, broadcast_limit=1 << 30)
    large, got_large = run_join(spark, pts, 0.5, broadcast_limit=0)
    assert got_small == got_large == brute(pts, SHAPES)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin [_gx" not in plan


def test_dissolve_strip(spark):
    cells = {i: (0, i, SQUARE) for i in range(5)}
    z = zones_df(spark, cells).withColumn("grp", F.lit(1))
    d = dissolve(zone_edges(z, ["grp"]), ["grp"])
    r = edges_area(d, ["grp"]).collect()[0]
    assert (r.area, r.n_edges) == (5.0, 12)


def test_dissolve_area_is_sum_of_parts(spark):
    shapes = {1: (0, 0, ELL), 2: (1, 0, HOLE), 3: (0, 1, SQUARE), 4: (2, 0, SQUARE)}
    z = zones_df(spark, shapes).withColumn("grp", F.lit(7))
    parts = edges_area(zone_edges(z, ["zone_id"]), ["zone_id"]).agg(F.sum("area")).first()[0]
    whole = edges_area(dissolve(zone_edges(z, ["grp"]), ["grp"]), ["grp"]).first().area
    assert abs(parts - whole) < 1e-12 and abs(whole - (0.75 + 0.75 + 1 + 1)) < 1e-12


def test_orientation_and_mercator_area(spark):
    cw = [[(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)]]
    z = zones_df(spark, {1: (0, 0, cw), 2: (0, 0, SQUARE)})
    a = [r.a for r in z.withColumn("rings", orient_rings("rings"))
         .select(area_km2_mercator("rings").alias("a")).collect()]
    assert abs(a[0] - a[1]) < 1e-9 and 12300 < a[0] < 12400   # 1 deg x 1 deg at the equator


def sq(x, y):
    x, y = float(x), float(y)
    return [[(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]]


def test_rings_and_polygons(spark):
    """Block with a hole; squares touching at a corner; a frame with an island
    in its hole (nested: the hole belongs to the frame, not the island)."""
    from incidex.operators.rings import assemble_polygons, assemble_rings
    from incidex.sources.sinks import geojson_multipolygons
    import json
    parts = [(1, sq(x, y)) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    parts += [(2, sq(10, 0)), (2, sq(11, 1))]
    parts += [(3, sq(x, y)) for x in range(20, 25) for y in range(5) if x in (20, 24) or y in (0, 4)]
    parts += [(3, sq(22, 2))]
    rows = [(g, [[{"x": a, "y": b} for a, b in r] for r in rings]) for g, rings in parts]
    z = spark.createDataFrame(rows, "grp int, rings array<array<struct<x:double,y:double>>>")
    d = dissolve(zone_edges(z, ["grp"]), ["grp"])
    rings = sorted((r.grp, len(r.vertices) - 1, r.area) for r in assemble_rings(d, ["grp"]).collect())
    assert rings == [(1, 4, -1.0), (1, 12, 9.0), (2, 4, 1.0), (2, 4, 1.0),
                     (3, 4, 1.0), (3, 12, -9.0), (3, 20, 25.0)]
    for r in assemble_rings(d, ["grp"]).collect():          # closed, consecutive vertices joined
        v = [(p.x, p.y) for p in r.vertices]
        assert v[0] == v[-1] and len(set(v[:-1])) == len(v) - 1
    polys = {r.grp: r for r in assemble_polygons(d, ["grp"]).collect()}
    assert [len(p) for p in polys[1].polygons] == [2] and polys[1].area == 8.0
    assert [len(p) for p in polys[2].polygons] == [1, 1] and polys[2].area == 2.0
    frame = [p for p in polys[3].polygons if len(p) == 2]
    assert len(frame) == 1 and len(frame[0][0]) == 21 and polys[3].area == 17.0
    f = json.loads(geojson_multipolygons(assemble_polygons(d, ["grp"]).where("grp = 1").drop("area"))
                   .first().value)
    assert f["geometry"]["type"] == "MultiPolygon" and len(f["geometry"]["coordinates"][0]) == 2


def test_interior_cells_carry_no_edges(spark):
    from incidex.operators.spatial import zone_cells
    z = zones_df(spark, {1: (0, 0, SQUARE), 3: (0, 0, HOLE)})
    cells = zone_cells(zone_edges(z, ["zone_id"]), ["zone_id"], 0.25).collect()
    inside = {(r.zone_id, r._gx, r._gy) for r in cells if not r._edges}
    assert all(r._odd and r._lv == 0 for r in cells if not r._edges)
    # an edge on a cell border is listed on both sides of it
    assert {(g, y) for z_, g, y in inside if z_ == 1} == {(g, y) for g in (1, 2) for y in (1, 2)}
    assert not any(z_ == 3 for z_, _, _ in inside)


def test_large_zones_list_their_boundary_only(spark):
    """A round zone of many cells: entries grow with its width, and the join
    gives the brute-force answer inside, outside and on the boundary."""
    import math
    from incidex.operators.spatial import zone_cells
    counts = []
    for width in (50, 400):
        ring = [(width * math.cos(2 * math.pi * k / 600), width * math.sin(2 * math.pi * k / 600)) for k in range(600)]
        ring.append(ring[0])
        z = zones_df(spark, {1: (0.1, -0.3, [ring]), 2: (3, 4, SQUARE)})
        edges = zone_edges(z, ["zone_id"])
        counts.append(zone_cells(edges, ["zone_id"], 1.0).selectExpr("sum(greatest(size(_edges), 1))").first()[0])
        pts = [(i, (i * 37 % 211 - 105) / 100 * width, (i * 91 % 197 - 98) / 100 * width) for i in range(400)]
        pts += [(1000 + i, ring[i][0] + 0.1, ring[i][1] - 0.3) for i in range(0, 600, 7)]
        pts.append((9999, 3.5, 4.5))
        got = {(r.pid, r.zone_id) for r in spatial_join(spark.createDataFrame(pts, "pid int, x double, y double"),
                                                        edges, ["zone_id"], cell=1.0).collect()}
        shifted = [[(x + 0.1, y - 0.3) for x, y in ring]]
        want = {(i, 1) for i, x, y in pts if i >= 1000 or py_inside(x, y, shifted)} | {(9999, 2)}
        assert {g for g in got if g[0] < 1000 or g[0] == 9999} == {w for w in want if w[0] < 1000 or w[0] == 9999}
        assert {g for g in got if 1000 <= g[0] < 9999 and g[1] == 1} == {w for w in want if 1000 <= w[0] < 9999}
    assert counts[1] < 16 * counts[0]        # 8 times the width, 64 times the area


def test_decimal_diagonals(spark):
    """A vertex and points on a diagonal with decimal coordinates count as on it."""
    lower = [[(.1, .1), (.7, .1), (.7, 1.3), (.1, .1)]]
    upper = [[(.1, .1), (.3, .5), (.7, 1.3), (.1, 1.3), (.1, .1)]]
    z = zones_df(spark, {1: (0, 0, lower), 2: (0, 0, upper)})
    assert dissolve(zone_edges(z.withColumn("grp", F.lit(1)), ["grp"]), ["grp"], split_cell=0.5).count() == 4
    pts = [(k, round(.1 + k * .06, 2), round(.1 + k * .12, 2)) for k in range(11)]
    for cell in (0.6, 0.17, 5.0):
        got = {(r.pid, r.zone_id) for r in spatial_join(spark.createDataFrame(pts, "pid int, x double, y double"),
                                                        zone_edges(z, ["zone_id"]), ["zone_id"], cell=cell).collect()}
        assert got == {(k, zid) for k in range(11) for zid in (1, 2)}, cell


def test_dissolve_splits_t_junctions(spark):
    """A 2x1 part under two 1x1 parts: the corner (1, 1) of the small parts
    lies inside the big part's top side.  Without splitting the shared border
    survives as three extra edges; with it only the outer boundary remains."""
    rect = [[(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)]]
    shapes = {1: (0, 0, rect), 2: (0, 1, SQUARE), 3: (1, 1, SQUARE)}
    z = zones_df(spark, shapes).withColumn("grp", F.lit(1))
    plain = dissolve(zone_edges(z, ["grp"]), ["grp"]).collect()
    split = dissolve(zone_edges(z, ["grp"]), ["grp"], split_cell=0.5).collect()
    assert len(plain) == 10 and len(split) == 7
    assert {(r.x1, r.y1, r.x2, r.y2) for r in split} == {
        (0.0, 0.0, 2.0, 0.0), (2.0, 0.0, 2.0, 1.0), (2.0, 1.0, 2.0, 2.0), (2.0, 2.0, 1.0, 2.0),
        (1.0, 2.0, 0.0, 2.0), (0.0, 2.0, 0.0, 1.0), (0.0, 1.0, 0.0, 0.0)}
    area = edges_area(dissolve(zone_edges(z, ["grp"]), ["grp"], split_cell=0.5), ["grp"]).first().area
    assert area == 4.0
    from incidex.operators.rings import assemble_rings
    rings = assemble_rings(dissolve(zone_edges(z, ["grp"]), ["grp"], split_cell=0.5), ["grp"]).collect()
    assert len(rings) == 1 and len(rings[0].vertices) == 8 and rings[0].area == 4.0


def test_splitting_leaves_an_edge_matched_coverage_unchanged(spark):
    from incidex.plans import fixtures as fx
    parts = fx.sector_parts(spark, "/root/testdata/sf0.001")
    edges = zone_edges(parts, ["CD_MUN"])
    plain = {tuple(r) for r in dissolve(edges, ["CD_MUN"]).collect()}
    split = {tuple(r) for r in dissolve(edges, ["CD_MUN"], split_cell=0.001).collect()}
    assert plain == split and len(plain) > 0


def test_t_junction_on_a_diagonal_side(spark):
    """Two triangles share the diagonal of a 2x2 square; one of them has an
    extra vertex (1, 1) on it.  After the split the diagonal cancels."""
    lower = [[(0, 0), (2, 0), (2, 2), (0, 0)]]
    upper = [[(0, 0), (1, 1), (2, 2), (0, 2), (0, 0)]]
    z = zones_df(spark, {1: (0, 0, lower), 2: (0, 0, upper)}).withColumn("grp", F.lit(1))
    plain = dissolve(zone_edges(z, ["grp"]), ["grp"]).count()
    split = dissolve(zone_edges(z, ["grp"]), ["grp"], split_cell=0.5)
    assert plain == 7
    assert {(r.x1, r.y1, r.x2, r.y2) for r in split.collect()} == {
        (0.0, 0.0, 2.0, 0.0), (2.0, 0.0, 2.0, 2.0), (2.0, 2.0, 0.0, 2.0), (0.0, 2.0, 0.0, 0.0)}
    assert edges_area(split, ["grp"]).first().area == 4.0
