"""Geometry as plain Spark types.

* point: two DOUBLE columns (lon = x, lat = y)
* zone part: ``rings ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>``; closed rings,
  ``rings[0]`` the exterior, the rest holes
* working form: directed edges ``STRUCT<x1, y1, x2, y2>`` (as array or rows)

All functions are SQL higher-order-function expressions, evaluated inside the
JVM with no Python round trip.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
EARTH_RADIUS_M = 6378137.0        # spherical Mercator (EPSG:3857) radius
M2_PER_KM2 = 1_000_000.0
# ---------------------------------------------------------------------------

# how far from an edge a point still lies on it: a share of the edge's length, and
# at least what rounding of the coordinates can move it
ON_EDGE_SHARE = 1e-9
ON_EDGE_ROUNDING = 1e-15


def _ring_signed_area_sql(r: str) -> str:
    return (f"aggregate(sequence(1, size({r}) - 1), CAST(0 AS DOUBLE), "
            f"(acc, k) -> acc + ({r}[k - 1].x - {r}[k].x) * ({r}[k - 1].y + {r}[k].y)) / 2")


def orient_rings(rings: str = "rings") -> Column:
    """Exterior counter-clockwise, holes clockwise (needed so that shared
    borders cancel in a dissolve and shoelace sums give the area)."""
    area = _ring_signed_area_sql("r")
    return F.expr(f"transform({rings}, (r, i) -> "
                  f"if((i = 0) = ({area} >= 0), r, reverse(r)))")


def ring_edges(rings: str = "rings") -> Column:
    """Closed rings -> flat array of directed edges."""
    return F.expr(
        f"flatten(transform(filter({rings}, r -> size(r) >= 4), r -> "
        f"transform(sequence(1, size(r) - 1), k -> named_struct("
        f"'x1', r[k - 1].x, 'y1', r[k - 1].y, 'x2', r[k].x, 'y2', r[k].y))))")


def rings_bbox(rings: str = "rings") -> Column:
    pts = f"flatten({rings})"
    return F.expr(
        f"named_struct('x0', array_min(transform({pts}, p -> p.x)), "
        f"'y0', array_min(transform({pts}, p -> p.y)), "
        f"'x1', array_max(transform({pts}, p -> p.x)), "
        f"'y1', array_max(transform({pts}, p -> p.y)))")


def mercator_rings(rings: str = "rings") -> Column:
    """Geographic lon/lat degrees -> spherical Mercator metres."""
    return F.expr(mercator_rings_sql(rings))


def area_km2_mercator(rings: str = "rings") -> Column:
    """Planar area of the Mercator-projected part in km^2 (inflated by
    1/cos^2(lat), like any area measured in EPSG:3857).  Holes count
    negatively because rings are oriented first."""
    proj = mercator_rings_sql(rings)
    terms = (f"flatten(transform({proj}, r -> transform(sequence(1, size(r) - 1), "
             f"k -> (r[k - 1].x - r[k].x) * (r[k - 1].y + r[k].y))))")
    return F.expr(f"aggregate({terms}, CAST(0 AS DOUBLE), (acc, v) -> acc + v) / 2") \
        / F.lit(M2_PER_KM2)


def mercator_rings_sql(rings: str) -> str:
    r = EARTH_RADIUS_M
    return (f"transform({rings}, ring -> transform(ring, p -> named_struct("
            f"'x', {r} * radians(p.x), "
            f"'y', {r} * ln(tan(pi() / 4 + radians(p.y) / 2)))))")


def edge_tolerance() -> Column:
    """Distance within which a point lies on the edge ``(x1, y1, x2, y2)``."""
    size = sum((F.abs(c) for c in ("y1", "x2", "y2")), F.abs("x1"))
    return F.greatest(F.lit(ON_EDGE_SHARE) * F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")),
                      F.lit(ON_EDGE_ROUNDING) * size)


def point_in_cell(px: str, py: str, yc: str, odd: str, edges: str) -> Column:
    """Boundary-inclusive point-in-polygon from the edges of the point's grid cell.

    ``odd`` says whether the horizontal line ``yc`` through the cell is crossed
    an odd number of times right of the cell.  The path from the point goes up
    or down to ``yc`` and then right; each edge is tested once for both legs
    (``c``: it crosses ``yc`` in this cell) and for touching the point (cross
    product at most ``t``, inside the edge's box widened by ``m``).  Both legs
    use the sign of one cross product at the corner of the path, so they
    cannot disagree.
    """
    def cross(y):
        return f"((e.x2 - e.x1) * ({y} - e.y1) - ({px} - e.x1) * (e.y2 - e.y1))"
    def side(y):    # of the path, taken just right of the point
        return f"({cross(y)} > 0 OR ({cross(y)} = 0 AND e.y2 < e.y1))"
    # the box first: most edges of a cell end there, without a cross product
    on = (f"{py} BETWEEN least(e.y1, e.y2) - e.m AND greatest(e.y1, e.y2) + e.m "
          f"AND {px} BETWEEN least(e.x1, e.x2) - e.m AND greatest(e.x1, e.x2) + e.m AND abs({cross(py)}) <= e.t")
    up = f"((e.x1 > {px}) <> (e.x2 > {px})) AND ({side(py)} <> {side(yc)})"
    right = f"e.c AND ({side(yc)} = (e.y2 > e.y1))"
    touched = 1 << 40
    total = (f"aggregate({edges}, CAST(0 AS BIGINT), (n, e) -> n + CASE WHEN {on} THEN {touched} "
             f"ELSE if({up}, 1, 0) + if({right}, 1, 0) END)")
    return F.expr(f"CASE WHEN size({edges}) = 0 THEN {odd} ELSE transform(array({total}), "
                  f"n -> n >= {touched} OR ((n % 2 = 1) <> {odd}))[0] END")


def axis_place(c, limit: float) -> Column:
    """31-bit place of a coordinate between -``limit`` and ``limit``."""
    c = F.col(c)
    share = (c.cast("double") + limit) / (2 * limit)
    v = F.floor(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share)) * ((1 << 31) - 1))
    return F.when(c.isNotNull() & ~F.isnan(c.cast("double")), v)      # least and greatest skip nulls


def place_key(x, y) -> Column:
    """Morton key of a longitude and latitude: their 31-bit places on the globe
    with bits interleaved, so rows close on the map are close in key order.
    Coordinates off the globe go to its edge; NULL for a missing or NaN one."""
    def spread(v):
        for step in (16, 8, 4, 2, 1):
            mask = sum(((1 << step) - 1) << at for at in range(0, 64, 2 * step))
            v = (v.bitwiseOR(F.shiftleft(v, step))).bitwiseAND(F.lit(mask))
        return v
    return spread(axis_place(x, 180.0)).bitwiseOR(F.shiftleft(spread(axis_place(y, 90.0)), 1))


# A Hilbert curve through the four quarters of a square (Morton numbers), for
# each of its four ways: the quarters in order, and the way through each.
CURVE = (((0, 1, 3, 2), (1, 0, 0, 3)), ((0, 2, 3, 1), (0, 1, 1, 2)), ((3, 2, 0, 1), (3, 2, 2, 1)), ((3, 1, 0, 2), (2, 3, 3, 0)))


def curve_steps() -> list[int]:
    """For each way and each of 256 cells (four bits of y, four of x): its place
    on the curve, followed by the way through it in two bits."""
    out = []
    for start in range(4):
        for cell in range(256):
            way, place = start, 0
            for bit in (3, 2, 1, 0):
                order, ways = CURVE[way]
                at = order.index((cell >> bit & 1) | (cell >> bit + 4 & 1) << 1)
                place, way = place << 2 | at, ways[at]
            out.append(place << 2 | way)
    return out


def curve_key(x, y) -> Column:
    """Place on the map as in ``place_key``, but along a Hilbert curve, which has
    no jumps: rows between two keys lie in one connected patch of the map."""
    steps = F.expr(f"array({', '.join(f'{v}L' for v in curve_steps())})")

    def bits(v, shift):
        return F.call_function("shiftright", v, shift).bitwiseAND(F.lit(15))

    def along(p):
        def step(done, shift):      # the curve so far, followed by its way in two bits
            cell = F.shiftleft(bits(p["y"], shift), 4).bitwiseOR(bits(p["x"], shift))
            at = F.get(steps, (done.bitwiseAND(F.lit(3)) * 256 + cell).cast("int"))
            return F.shiftleft(done.bitwiseAND(F.lit(-4)), 8).bitwiseOR(at)
        return F.aggregate(F.array(*[F.lit(s) for s in range(28, -1, -4)]), F.lit(0).cast("long"), step,
                           lambda done: F.shiftrightunsigned(done, 2))
    # an array of one: the places are worked out once, not at every step
    return F.get(F.transform(F.array(F.struct(axis_place(x, 180.0).alias("x"), axis_place(y, 90.0).alias("y"))), along), 0)
