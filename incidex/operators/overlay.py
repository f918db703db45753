"""Union of parts that may overlap.

``dissolve`` cancels borders that two parts share; it needs parts that meet
but do not overlap.  ``union_parts`` takes any parts of a key:

1. edges are split where they cross (``split_at_crossings``) and at vertices
   that lie on them (``split_at_vertices``), both by grid equi-joins of edges
   within a key, so pieces meet at their ends only;
2. equal pieces are put together with their net direction;
3. the winding number (how many parts cover a place) is taken on both sides of
   each piece: from the piece's middle a path goes up or down to the test line
   of its grid row and then right.  Crossings in the piece's own cell are
   counted by a join of the pieces of the cell, all cells right of it by one
   running sum per key and row, so no piece meets all edges of its key;
4. pieces with the number zero on exactly one side are the union's boundary,
   directed with the inside on the left.

The work follows the pieces in a cell, not the size of a key.  Every step is a
DataFrame join, aggregate or window; no row holds an array of edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import edge_tolerance
from ..session import cut_lineage
from .spatial import cut_edges, edge_cells, net_edges, row_line, shuffled, split_at_vertices

# --- fixed values -----------------------------------------------------------
CROSSING_DIGITS = 11     # crossings are rounded, so edges that meet in a place get one vertex
# ---------------------------------------------------------------------------


def suggest_edge_cell(edges: DataFrame) -> float:
    """Median edge extent: most edges then pass through one to three cells."""
    row = edges.agg(F.percentile_approx(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))),
                                        0.5).alias("c")).first()
    return float(row["c"]) if row and row["c"] else 1.0


def _cross(e: str, x: str, y: str) -> Column:
    """Positive where the point lies left of the edge."""
    return F.expr(f"({e}x2 - {e}x1) * ({y} - {e}y1) - ({x} - {e}x1) * ({e}y2 - {e}y1)")


def split_at_crossings(edges: DataFrame, keys, cell: float, digits: int = CROSSING_DIGITS) -> DataFrame:
    """Split edges of a key where two of them cross inside both.  Edges meet
    only within a (key, cell); a pair's crossing is computed once and used for
    both, so both sides get the same vertex."""
    keys = list(keys)
    e = cut_lineage(edges.select(*keys, "x1", "y1", "x2", "y2")
                    .withColumn("_eid", F.monotonically_increasing_id()).withColumn("_m", edge_tolerance()))
    listed = edge_cells(e, cell)
    names = ["x1", "y1", "x2", "y2", "_eid", "_m"]
    a = listed.select(*keys, "_gx", "_gy", *[F.col(n).alias(f"a_{n}") for n in names])
    b = listed.select(*keys, "_gx", "_gy", *[F.col(n).alias(f"b_{n}") for n in names])

    def apart(edge, other):      # the ends of ``other`` lie on different sides of ``edge``
        d1, d2 = _cross(edge, f"{other}x1", f"{other}y1"), _cross(edge, f"{other}x2", f"{other}y2")
        least = F.expr(f"{edge}_m * hypot({edge}x2 - {edge}x1, {edge}y2 - {edge}y1)")
        return ((d1 > least) & (d2 < -least)) | ((d1 < -least) & (d2 > least)), d1 / (d1 - d2)
    one, t = apart("a_", "b_")
    two, _ = apart("b_", "a_")
    met = (a.join(shuffled(b), [*keys, "_gx", "_gy"]).where((F.col("a__eid") < F.col("b__eid")) & one & two)
           .withColumn("_vx", F.round(F.col("b_x1") + t * (F.col("b_x2") - F.col("b_x1")), digits))
           .withColumn("_vy", F.round(F.col("b_y1") + t * (F.col("b_y2") - F.col("b_y1")), digits)))
    hits = None
    for side in ("a_", "b_"):
        dx, dy = F.col(f"{side}x2") - F.col(f"{side}x1"), F.col(f"{side}y2") - F.col(f"{side}y1")
        along = ((F.col("_vx") - F.col(f"{side}x1")) * dx + (F.col("_vy") - F.col(f"{side}y1")) * dy) / (dx * dx + dy * dy)
        own = met.select(F.col(f"{side}_eid").alias("_eid"), along.alias("_t"), "_vx", "_vy")
        hits = own if hits is None else hits.union(own)
    return cut_edges(e, hits.distinct(), keys)


def covered_sides(pieces: DataFrame, keys, cell: float) -> DataFrame:
    """``pieces`` (keys, ax, ay, bx, by, net; meeting at their ends only) with
    the winding numbers ``left`` and ``right`` of their two sides."""
    keys = list(keys)
    c = F.lit(float(cell))
    end = ["ax", "ay", "bx", "by"]
    shaped = pieces.select(*keys, "net", F.col("ax").alias("x1"), F.col("ay").alias("y1"), F.col("bx").alias("x2"),
                           F.col("by").alias("y2"))
    listed = edge_cells(shaped.withColumn("_m", edge_tolerance()), cell, crossing=True)
    up = F.when(F.col("y2") > F.col("y1"), F.col("net")).otherwise(-F.col("net"))
    here = F.coalesce(F.col("_gx") == F.col("_gc"), F.lit(False))
    cells = listed.groupBy(*keys, "_gx", "_gy").agg(F.sum(F.when(here, up).otherwise(0)).alias("n"))
    row = Window.partitionBy(*keys, "_gy").orderBy(F.desc("_gx")).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("beyond", F.coalesce(F.sum("n").over(row), F.lit(0))).drop("n")
    tests = (pieces.withColumn("px", (F.col("ax") + F.col("bx")) / 2).withColumn("py", (F.col("ay") + F.col("by")) / 2)
             .withColumn("_gx", F.floor(F.col("px") / c)).withColumn("_gy", F.floor(F.col("py") / c))
             .withColumn("yc", row_line(c)).withColumnRenamed("net", "own"))
    near = listed.select(*keys, "_gx", "_gy", "net", here.alias("here"), *[F.col(n).alias(f"e_{n}") for n in ("x1", "y1", "x2", "y2")])
    met = tests.join(shuffled(near), [*keys, "_gx", "_gy"])

    def left_of(y):     # of the directed piece, taken just right of the path
        cr = _cross("e_", "px", y)
        return (cr > 0) | ((cr == 0) & (F.col("e_y2") < F.col("e_y1")))
    itself = (F.col("e_x1") == F.col("ax")) & (F.col("e_y1") == F.col("ay")) & (F.col("e_x2") == F.col("bx")) & (F.col("e_y2") == F.col("by"))
    at_point, at_line = left_of("py"), left_of("yc")
    upright = ~itself & ((F.col("e_x1") > F.col("px")) != (F.col("e_x2") > F.col("px"))) & (at_point != at_line)
    rising = F.col("e_y2") > F.col("e_y1")
    sideways = F.col("here") & (at_line == rising)
    count = (F.when(upright, F.when(at_point, F.col("net")).otherwise(-F.col("net"))).otherwise(0)
             + F.when(sideways, F.when(rising, F.col("net")).otherwise(-F.col("net"))).otherwise(0))
    local = met.groupBy(*keys, *end, "own", "py", "yc", "_gx", "_gy").agg(F.sum(count).alias("w"))
    total = local.join(shuffled(cells), [*keys, "_gx", "_gy"]).withColumn("w", F.col("w") + F.col("beyond"))
    # the path leaves a piece upwards or downwards, an upright one to the right
    leaves_left = (F.col("ax") < F.col("bx")) & (F.col("yc") >= F.col("py"))
    return total.select(*keys, *end, F.col("own").alias("net"),
                        F.when(leaves_left, F.col("w")).otherwise(F.col("w") + F.col("own")).alias("left"),
                        F.when(leaves_left, F.col("w") - F.col("own")).otherwise(F.col("w")).alias("right"))


def union_parts(edges: DataFrame, keys, cell: float | None = None) -> DataFrame:
    """Boundary edges of the union of each key's parts, which may overlap, touch,
    repeat or lie in one another.  ``edges``: directed edges of consistently
    oriented parts (``zone_edges``).  Output as ``dissolve`` gives it, with
    ``mult`` 1 throughout; ``cell`` defaults to the median edge extent."""
    keys = list(keys)
    if cell is None:
        edges = cut_lineage(edges.select(*keys, "x1", "y1", "x2", "y2"))
        cell = suggest_edge_cell(edges)
    split = split_at_vertices(split_at_crossings(edges, keys, cell), keys, cell)
    pieces = cut_lineage(net_edges(split, keys))
    sides = covered_sides(pieces, keys, cell).where("(left > 0) <> (right > 0)")
    ahead = F.col("left") > 0
    ends = [F.when(ahead, F.col(f)).otherwise(F.col(g)).alias(n)
            for f, g, n in (("ax", "bx", "x1"), ("ay", "by", "y1"), ("bx", "ax", "x2"), ("by", "ay", "y2"))]
    return sides.select(*keys, *ends, F.lit(1).alias("mult"))
