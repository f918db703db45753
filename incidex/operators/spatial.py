"""Spatial operators without a spatial extension.

``spatial_join`` assigns points to zones with a grid equi-join:

1. every zone edge is listed in the grid cells it passes through, so entries
   grow with the length of the boundary, whatever the size of the zone;
2. per (zone, grid row) a running sum over the boundary cells says on which
   side of the zone the right end of each cell lies;
3. cells between two boundary cells of a row lie wholly inside or outside;
   inside runs are kept as aligned blocks of 1, 16, 256 or 4,096 cells, so a
   large zone does not list its interior cell by cell;
4. each point falls in exactly one cell (and one block of each block size in
   use), so the join is an equi-join: no nested loop, no duplicates;
5. the exact boundary-inclusive test runs over the cell's own edges with a
   higher-order function (JVM side); inside blocks need no test.

A (zone, cell) that more than ``EDGES_A_CELL`` edges pass through is cut into 8 x
8 smaller cells, level by level, so no row holds all edges of a finely drawn
boundary (``finer_cells``; edges that meet in one point cannot be separated
and stay together after ``LEVELS`` levels).  Levels below 0 number these.

A hot cell (many points) is a skewed equi-join partition, which AQE splits.
The cell table is written to the shared folder once and its size measured from
the data (rows, edges, key bytes); it is broadcast only when that measured size
is under the broadcast threshold, and joined with a shuffled hash join (built
on the cell side, the points streamed) otherwise.  Row-count estimates are not
used for that decision because they know nothing of the edge-array lengths.

``dissolve`` unions the parts of each key by cancelling shared borders:
directed edges of consistently oriented parts are grouped by their undirected
segment and the net direction is kept.  This is a plain hash aggregate with
map-side partial aggregation, so one very large key is spread over all of its
edge groups.  ``split_at_vertices`` (``dissolve(split_cell=...)``) first
splits edges at T-junctions with a grid equi-join of vertices against edge
cells, for parts that do not share vertices along a common border.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.crs import same_srid, srid_of, with_srid
from ..functions.geometry import edge_tolerance, orient_rings, point_in_cell, ring_edges
from ..session import broadcast_threshold, cut_lineage

# --- fixed values -----------------------------------------------------------
EDGE_BYTES = 72          # one edge struct in an array: null bits and fields
BLOCK_SIZES = (1, 16, 256, 4096)      # inside blocks, in cells of a row
ROW_LINE = 0.6180339887498949         # where a row's test line lies in its cells
ROW_BYTES = 16           # row header and array header
SPLIT = 8                # finer cells a side; a power of two, so finer cells nest exactly
# ---------------------------------------------------------------------------

EDGE = ("x1", "y1", "x2", "y2")
EDGES_A_CELL = 512       # edges in one row of a cell table
LEVELS = 6               # of finer cells


def zone_edges(zones: DataFrame, keys, rings: str = "rings") -> DataFrame:
    """Zone parts with ``rings`` -> one row per directed edge (rings oriented).
    An SRID that the rings tell goes on to the edges."""
    keys = list(keys)
    edges = (zones.select(*keys, orient_rings(rings).alias("_r"))
                  .select(*keys, F.explode(ring_edges("_r")).alias("e"))
                  .select(*keys, *[f"e.{c}" for c in EDGE]))
    return of_srid(edges, srid_of(zones, rings))


def of_srid(edges: DataFrame, srid: int | None) -> DataFrame:
    """Edges with the SRID of what they are made of, if that tells one."""
    return edges if srid is None else with_srid(edges, srid, *EDGE)


def suggest_cell_size(edges: DataFrame, keys) -> float:
    """Median zone extent: most zones then cover one to four cells.  One small
    aggregate; a single number comes back to the driver."""
    bbox = edges.groupBy(*keys).agg(
        (F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2"))).alias("w"),
        (F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("h"))
    row = bbox.agg(F.percentile_approx(F.greatest("w", "h"), 0.5).alias("c")).first()
    c = row["c"] if row else None
    return float(c) if c and c > 0 else 1.0


def shuffled(df: DataFrame) -> DataFrame:
    """The second side of a join of edge rows, sort-merge joined at any size:
    Spark's estimates know nothing of the rows that come out of an exploded
    array, so it would gather tables many times its broadcast threshold on the
    driver."""
    return df.hint("merge")


def same_cell(a: DataFrame, b: DataFrame, cols, how: str) -> DataFrame:
    """Join on ``cols`` (null keys are equal); ``b``'s copies of them are dropped."""
    b = b.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], *[c for c in b.columns if c not in cols])
    names = [f"_k{i}" for i in range(len(cols))]
    on = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(cols, names)]
    return a.join(shuffled(b), on, how).drop(*names)


def edge_array(keep=None):
    """Edges of a group as one array (``keep``: only those rows)."""
    e = F.struct("x1", "y1", "x2", "y2", F.col("_here").alias("c"),
                 (F.col("m") * F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("t"), "m")
    return F.collect_list(e if keep is None else F.when(keep, e))


def crowded(rows: DataFrame, cell_keys, most: int) -> DataFrame:
    """Cells that more than ``most`` edges pass through."""
    return cut_lineage(rows.groupBy(*cell_keys).count().where(F.col("count") > most).select(*cell_keys))


def finer_cells(rows: DataFrame, odd: DataFrame, keys, cell: float) -> tuple[DataFrame, DataFrame]:
    """Edges listed in cells of size ``cell`` (``rows``), and the cells'
    ``_odd``, for cells cut into ``SPLIT`` x ``SPLIT``: the edges listed in
    the finer cells, and ``_odd`` of every finer cell.

    In each cell an anchor stands on the test line of each finer row.  The
    cell's own edges tell whether the anchor is inside, as they do for a
    point; from there the crossings of the finer row's line up to a finer
    cell's right end are counted.  All of it is sums over edge rows.
    """
    at_cell = [*keys, "_gx", "_gy"]
    f = F.lit(float(cell) / SPLIT)
    x1, y1, x2, y2, m = (F.col(n) for n in ("x1", "y1", "x2", "y2", "m"))
    px, line = row_line(F.lit(float(cell)), "_gx"), row_line(F.lit(float(cell)))
    sub = rows.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1)))) \
              .withColumn("_fy", F.col("_gy") * SPLIT + F.col("_j"))
    py = row_line(f, "_fy")

    def side(y):        # of the edge, seen from just right of (px, y)
        cross = (x2 - x1) * (y - y1) - (px - x1) * (y2 - y1)
        return (cross > 0) | ((cross == 0) & (y2 < y1))

    def at(y):
        return x1 + F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y - y1) / (y2 - y1))) * (x2 - x1)
    up = ((x1 > px) != (x2 > px)) & (side(py) != side(line))
    right = F.col("_here") & (side(line) == (y2 > y1))
    crosses = (y1 > py) != (y2 > py)
    sub = (sub.withColumn("_n", up.cast("int") + right.cast("int"))
              .withColumn("_gc", F.when(crosses, F.floor(at(py) / f) - F.col("_gx") * SPLIT))
              .withColumn("_right", side(py) == (y2 > y1)))
    counts = [F.count_if((F.col("_gc") == k) & (F.col("_right") if r else ~F.col("_right"))).alias(f"_{r}{k}")
              for r in (0, 1) for k in range(SPLIT)]
    sums = same_cell(sub.groupBy(*at_cell, "_fy").agg(F.sum("_n").alias("_n"), *counts), odd, at_cell, "inner")
    anchor = int(SPLIT * ROW_LINE)      # the finer cell of a row that holds its anchor
    ends = []
    for k in range(SPLIT):
        passed = [f"_1{i}" for i in range(k + 1)] if k >= anchor else [f"_0{i}" for i in range(k + 1, SPLIT)]
        n = sum((F.col(c) for c in passed), F.col("_n") + F.col("_odd").cast("int"))
        ends.append(F.struct((F.col("_gx") * SPLIT + k).alias("_gx"), (n % 2 == 1).alias("_odd")))
    finer_odd = (sums.select(*keys, F.col("_fy").alias("_gy"), F.explode(F.array(*ends)).alias("_e"))
                 .select(*keys, "_e._gx", "_gy", "_e._odd"))
    touched = (F.col("_fy") >= F.floor((F.least("y1", "y2") - m) / f)) & (F.col("_fy") <= F.floor((F.greatest("y1", "y2") + m) / f))
    tips = [F.when(y1 == y2, F.col(end)).otherwise(at(y)) for end, y in (("x1", F.col("_fy") * f - m), ("x2", (F.col("_fy") + 1) * f + m))]
    first = F.col("_gx") * SPLIT
    low = F.greatest(first, F.least(F.floor((F.least(*tips) - m) / f), first + F.col("_gc")))
    high = F.least(first + (SPLIT - 1), F.greatest(F.floor((F.greatest(*tips) + m) / f), first + F.col("_gc")))
    listed = (sub.where(touched).withColumn("_low", low).withColumn("_high", high).where("_low <= _high")
              .withColumn("_fx", F.explode(F.sequence("_low", "_high"))))
    finer = listed.select(*keys, F.col("_fx").alias("_gx"), F.col("_fy").alias("_gy"), "x1", "y1", "x2", "y2", "m",
                          F.coalesce(F.col("_fx") == first + F.col("_gc"), F.lit(False)).alias("_here"))
    return finer, finer_odd


def listed_edges(edges: DataFrame, keys, cell: float) -> DataFrame:
    """Edges in the cells they pass through; ``_here``: the edge crosses the
    row's test line in this cell."""
    e = edges.select(*keys, "x1", "y1", "x2", "y2", edge_tolerance().alias("_m"))
    here = F.coalesce(F.col("_gx") == F.col("_gc"), F.lit(False))
    return edge_cells(e, cell, crossing=True).select(*keys, "_gx", "_gy", "x1", "y1", "x2", "y2", F.col("_m").alias("m"),
                                                     here.alias("_here"))


def zone_cells(edges: DataFrame, keys, cell: float, attrs: DataFrame | None = None,
               most_edges: int = EDGES_A_CELL) -> DataFrame:
    """(zone keys, _lv, _gx, _gy, _edges, _odd) - the build side of the spatial
    join.  Level 0 rows with edges are the cells the boundary passes through;
    rows of higher levels (and of level 0 without edges) are blocks of ``16 **
    _lv`` cells of a row that lie inside the zone; rows of lower levels are
    cells of size ``cell * 8 ** _lv`` in place of a level 0 cell with more than
    ``most_edges`` edges.  ``_odd``: the point at the right end of the cell on
    the row's test line lies inside."""
    keys = list(keys)
    at_cell = [*keys, "_gx", "_gy"]
    rows = cut_lineage(listed_edges(edges, keys, cell))
    hot = crowded(rows, at_cell, most_edges)
    if hot.isEmpty():
        # no cell is crowded: one exchange for the cells and for the order of a row's cells
        cells = base_cells(rows.withColumn("_hot", F.lit(False)).repartition(*keys, "_gy"), keys)
        out = inside_blocks(cells, keys)
    else:
        rows = same_cell(rows, hot.withColumn("_hot", F.lit(True)), at_cell, "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
        cells = cut_lineage(base_cells(rows, keys))
        out = inside_blocks(cells, keys)
        rows, odd, size = rows.where("_hot"), cells.where("_hot").select(*at_cell, "_odd"), float(cell)
        for level in range(1, LEVELS + 1):
            rows, odd = map(cut_lineage, finer_cells(rows, odd, keys, size))
            size /= SPLIT
            hot = crowded(rows, at_cell, most_edges)
            last = level == LEVELS or hot.isEmpty()
            here = rows if last else same_cell(rows, hot, at_cell, "left_anti")
            own = odd if last else same_cell(odd, hot, at_cell, "left_anti")
            listed = here.groupBy(*at_cell).agg(edge_array().alias("_edges"))
            none = F.array().cast(listed.schema["_edges"].dataType)
            done = same_cell(own, listed, at_cell, "left").where("_odd or _edges is not null") \
                .withColumn("_edges", F.coalesce("_edges", none)).withColumn("_lv", F.lit(-level))
            out = out.unionByName(done)
            if last:
                break
            rows, odd = same_cell(rows, hot, at_cell, "left_semi"), same_cell(odd, hot, at_cell, "left_semi")
    return out if attrs is None else out.join(attrs, keys, "left")


def base_cells(rows: DataFrame, keys) -> DataFrame:
    """One row a cell that the boundary passes through, with ``_odd`` and the
    next such cell of the row; edges of ``_hot`` cells are left out."""
    cells = rows.groupBy(*keys, "_gx", "_gy").agg(edge_array(~F.col("_hot")).alias("_edges"), F.count_if("_here").alias("_n"),
                                                  F.max("_hot").alias("_hot"))
    row = Window.partitionBy(*keys, "_gy").orderBy(F.desc("_gx"))
    cells = cells.withColumn("_odd", F.coalesce(F.sum("_n").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1) \
                 .withColumn("_next", F.lag("_gx").over(row))
    return cells


def inside_blocks(cells: DataFrame, keys) -> DataFrame:
    """The cells, and the runs of inside cells between them as blocks."""
    # a run of inside cells right of a boundary cell, cut into aligned blocks
    first, last = F.col("_gx") + 1, F.col("_next") - 1
    spans = []
    for level, size in enumerate(BLOCK_SIZES):
        f, g = F.ceil(first / size), F.floor((last + 1) / size) - 1
        if level + 1 < len(BLOCK_SIZES):
            up = BLOCK_SIZES[level + 1]
            ratio = up // size
            uf, ug = F.ceil(first / up), F.floor((last + 1) / up) - 1
            spans += [(level, f, F.when(uf <= ug, uf * ratio - 1).otherwise(g)), (level, F.when(uf <= ug, (ug + 1) * ratio), g)]
        else:
            spans.append((level, f, g))
    none = F.array().cast("array<bigint>")

    def of_level(level):
        return lambda x: F.struct(F.lit(level).alias("_lv"), x.alias("_gx"))
    blocks = F.flatten(F.array(*[F.transform(F.when(f <= g, F.sequence(f, g)).otherwise(none), of_level(level))
                                 for level, f, g in spans]))
    boundary = F.array(F.struct(F.lit(0).alias("_lv"), F.col("_gx").alias("_gx")))
    every = F.when(F.col("_odd") & (F.col("_next") > F.col("_gx") + 1), F.concat(boundary, blocks)).otherwise(boundary)
    out = cells.select(*keys, "_gy", "_odd", "_hot", F.col("_edges").alias("_own"), F.col("_gx").alias("_at"), F.explode(every).alias("_b"))
    mine = (F.col("_b._lv") == 0) & (F.col("_b._gx") == F.col("_at"))
    return out.where(~(mine & F.col("_hot"))).select(*keys, F.col("_b._lv").alias("_lv"), F.col("_b._gx").alias("_gx"), "_gy", "_odd",
                     F.when(mine, F.col("_own")).otherwise(F.filter("_own", lambda e: F.lit(False))).alias("_edges"))


def row_line(c, row: str = "_gy"):
    """Height of a grid row's test line: off any regular fraction of the cell."""
    return (F.col(row) + F.lit(ROW_LINE)) * c


def measured_bytes(cells: DataFrame) -> tuple[int, list[int]]:
    """Size of a cell table measured from its data (one aggregate): fixed
    width columns, string bytes and edge-array lengths; and the block levels
    in use."""
    fixed, strings = 0, []
    for f in cells.schema.fields:
        if f.name == "_edges":
            continue
        fixed += 8
        if f.dataType.typeName() in ("string", "binary"):
            strings.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
    total = F.lit(ROW_BYTES + fixed) + F.lit(EDGE_BYTES) * F.size("_edges")
    for s_ in strings:
        total = total + s_
    row = cells.agg(F.sum(total.cast("long")).alias("b"), F.array_sort(F.collect_set("_lv")).alias("levels")).first()
    return int(row["b"] or 0), list(row["levels"]) or [0]


def spatial_join(points: DataFrame, edges: DataFrame, keys, *, x: str = "x", y: str = "y",
                 cell: float | None = None, attrs: DataFrame | None = None,
                 broadcast_limit: int | None = None, edges_written: bool = False,
                 most_edges: int = EDGES_A_CELL) -> DataFrame:
    """Inner join of points with every zone that contains or touches them.

    ``edges``: one row per directed zone edge (``zone_edges`` or ``dissolve``
    output) with the zone ``keys``.  ``attrs``: optional zone attributes
    (one row per zone) attached to the build side before the join.
    ``broadcast_limit``: bytes (default: the session's broadcast threshold).
    ``edges_written``: the edges are a scan of a written table, so the
    cell-size estimate and the cell table may both read them without a
    checkpoint of their own.  ``most_edges``: edges in one row of the cell
    table, beyond it a cell is cut into smaller ones.  Points and edges that
    tell different SRIDs are refused.
    """
    keys = list(keys)
    same_srid(points, (x, y), edges, EDGE)
    if cell is None:
        # the edges feed both the cell-size estimate and the cell table
        if not edges_written:
            edges = cut_lineage(edges.select(*keys, "x1", "y1", "x2", "y2"))
        cell = suggest_cell_size(edges, keys)
    cells = cut_lineage(zone_cells(edges, keys, cell, attrs, most_edges))
    limit = broadcast_threshold(cells.sparkSession) if broadcast_limit is None else broadcast_limit
    size, levels = measured_bytes(cells)
    if 0 <= size <= limit:
        cells = F.broadcast(cells)
    else:
        cells = cells.hint("shuffle_hash")
    # a point's place in each level in use: inside blocks, cells, finer cells
    sizes = [F.struct(F.lit(lv).alias("_lv"), F.lit(float(cell) * float(SPLIT) ** min(lv, 0)).alias("_c"),
                      F.lit(16 ** max(lv, 0)).cast("long").alias("_w")) for lv in levels]
    pts = points.withColumn("_l", F.explode(F.array(*sizes))).withColumn("_lv", F.col("_l._lv")) if len(sizes) > 1 else \
        points.withColumn("_l", sizes[0]).withColumn("_lv", F.lit(levels[0]))
    pts = (pts.withColumn("_gx", F.floor(F.floor(F.col(x) / F.col("_l._c")) / F.col("_l._w")))
              .withColumn("_gy", F.floor(F.col(y) / F.col("_l._c"))).drop("_l"))
    # behind the join: what follows from a point's cell is not shuffled
    side = F.lit(float(cell))
    for lv in levels:
        if lv < 0:
            side = F.when(F.col("_lv") == lv, F.lit(float(cell) * float(SPLIT) ** lv)).otherwise(side)
    joined = pts.join(cells, ["_lv", "_gx", "_gy"], "inner").withColumn("_yc", row_line(side))
    return joined.where(point_in_cell(f"`{x}`", f"`{y}`", "_yc", "_odd", "_edges")) \
        .drop("_lv", "_gx", "_gy", "_yc", "_edges", "_odd")


def edge_cells(e: DataFrame, cell: float, crossing: bool = False) -> DataFrame:
    """Edges (with tolerance ``_m``) listed in the grid cells they pass through,
    row by row: (length / cell) entries, also for a diagonal edge.  ``crossing``
    adds ``_gc``, the cell of the row in which the edge crosses the test line."""
    c = F.lit(float(cell))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    m = F.col("_m")

    def at(y):      # x of the edge at height y, kept on the edge
        share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y - F.col("y1")) / dy))
        return F.col("x1") + share * dx
    rows = e.withColumn("_gy", F.explode(F.sequence(F.floor((F.least("y1", "y2") - m) / c),
                                                    F.floor((F.greatest("y1", "y2") + m) / c))))
    ends = [F.when(dy == 0, F.col(end)).otherwise(at(y)) for end, y in
            (("x1", F.col("_gy") * c - m), ("x2", (F.col("_gy") + 1) * c + m))]
    low, high = F.floor((F.least(*ends) - m) / c), F.floor((F.greatest(*ends) + m) / c)
    if crossing:
        line = row_line(c)
        rows = rows.withColumn("_gc", F.when((F.col("y1") > line) != (F.col("y2") > line), F.floor(at(line) / c)))
        low, high = F.least(low, "_gc"), F.greatest(high, "_gc")
    return rows.withColumn("_gx", F.explode(F.sequence(low, high)))


def split_at_vertices(edges: DataFrame, keys, cell: float) -> DataFrame:
    """Split every edge at the vertices of its key that lie strictly inside it
    (T-junctions: a part's corner in the middle of a neighbour's side), so
    that shared borders consist of identical segments and cancel in
    ``dissolve``.

    Vertices are found with a grid equi-join: an edge is listed in the cells
    it passes through (``cell`` about the edge length, so these are few), a
    vertex in the one cell that holds it; candidates meet only
    within a (key, cell) and are tested with a tolerance scaled to the edge's
    length, strictly between its end points.  The cut is the vertex itself, so
    both sides of a border get identical segments.  An edge's cells are widened
    by the tolerance, so a vertex on a cell border is never missed."""
    keys = list(keys)
    c = F.lit(float(cell))
    e = cut_lineage(edges.select(*keys, "x1", "y1", "x2", "y2")
                    .withColumn("_eid", F.monotonically_increasing_id()).withColumn("_m", edge_tolerance()))
    verts = e.select(*keys, F.col("x1").alias("_vx"), F.col("y1").alias("_vy")).distinct()
    m = F.col("_m")
    ec = edge_cells(e, cell)
    vc = verts.withColumn("_gx", F.floor(F.col("_vx") / c)).withColumn("_gy", F.floor(F.col("_vy") / c))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cross = dx * (F.col("_vy") - F.col("y1")) - (F.col("_vx") - F.col("x1")) * dy
    along = (F.col("_vx") - F.col("x1")) * dx + (F.col("_vy") - F.col("y1")) * dy
    length2 = dx * dx + dy * dy
    hits = (ec.join(shuffled(vc), [*keys, "_gx", "_gy"])
              .where((F.abs(cross) <= m * F.sqrt(length2)) & (along > m * F.sqrt(length2))
                     & (along < length2 - m * F.sqrt(length2)))
              .select("_eid", (along / length2).alias("_t"), "_vx", "_vy").distinct())
    return cut_edges(e, hits, keys)


def cut_edges(e: DataFrame, hits: DataFrame, keys) -> DataFrame:
    """Edges ``e`` (with ``_eid``) cut at their ``hits`` (_eid, place ``_t`` along
    the edge, _vx, _vy)."""
    cuts = hits.groupBy("_eid").agg(F.array_sort(F.collect_list(F.struct("_t", "_vx", "_vy"))).alias("_c"))
    point = "struct<_t:double,_vx:double,_vy:double>"
    path = F.concat(F.array(F.struct(F.lit(0.0).alias("_t"), F.col("x1").alias("_vx"), F.col("y1").alias("_vy"))),
                    F.coalesce(F.col("_c"), F.array().cast(f"array<{point}>")),
                    F.array(F.struct(F.lit(1.0).alias("_t"), F.col("x2").alias("_vx"), F.col("y2").alias("_vy"))))
    pieces = F.expr("transform(sequence(1, size(_p) - 1), k -> named_struct("
                    "'x1', _p[k - 1]._vx, 'y1', _p[k - 1]._vy, 'x2', _p[k]._vx, 'y2', _p[k]._vy))")
    return (e.join(shuffled(cuts), "_eid", "left").select(*keys, path.alias("_p"))
             .select(*keys, F.explode(pieces).alias("_e")).select(*keys, "_e.*"))


def dissolve(edges: DataFrame, keys, snap_digits: int | None = None,
             split_cell: float | None = None) -> DataFrame:
    """Boundary edges of the union of each key's parts.

    Parts must be oriented consistently (``zone_edges`` does it); borders
    shared by two parts cancel.  With ``split_cell`` the edges are first split
    at T-junctions (``split_at_vertices``), so the parts need not be
    edge-matched.  Parts that overlap need ``overlay.union_parts``.  Output: keys, directed edge, ``mult`` (1 for a proper
    coverage).
    """
    keys = list(keys)
    e = split_at_vertices(edges, keys, split_cell) if split_cell else edges
    if snap_digits is not None:
        e = e.select(*keys, *[F.round(c, snap_digits).alias(c) for c in ("x1", "y1", "x2", "y2")])
    net = net_edges(e, keys)
    pos = F.col("net") > 0
    outer = net.select(
        *keys,
        F.when(pos, F.col("ax")).otherwise(F.col("bx")).alias("x1"),
        F.when(pos, F.col("ay")).otherwise(F.col("by")).alias("y1"),
        F.when(pos, F.col("bx")).otherwise(F.col("ax")).alias("x2"),
        F.when(pos, F.col("by")).otherwise(F.col("ay")).alias("y2"),
        F.abs(F.col("net")).cast("int").alias("mult"))
    return of_srid(outer, srid_of(edges, *EDGE))


def net_edges(e: DataFrame, keys) -> DataFrame:
    """Equal segments of a key put together: canonical ends and the net number
    of times the segment is passed from ``a`` to ``b``; those that cancel go."""
    fwd = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") < F.col("y2")))
    canon = e.select(
        *keys,
        F.when(fwd, F.col("x1")).otherwise(F.col("x2")).alias("ax"),
        F.when(fwd, F.col("y1")).otherwise(F.col("y2")).alias("ay"),
        F.when(fwd, F.col("x2")).otherwise(F.col("x1")).alias("bx"),
        F.when(fwd, F.col("y2")).otherwise(F.col("y1")).alias("by"),
        F.when(fwd, F.lit(1)).otherwise(F.lit(-1)).alias("d"))
    return canon.groupBy(*keys, "ax", "ay", "bx", "by").agg(F.sum("d").alias("net")).where("net <> 0")


def edges_area(edges: DataFrame, keys) -> DataFrame:
    """Area per key from directed edge rows (trapezoids, partial aggregation): its
    terms are as small as the edges, so little is lost far from the origin."""
    mult = F.col("mult") if "mult" in edges.columns else F.lit(1)
    term = (F.col("x1") - F.col("x2")) * (F.col("y1") + F.col("y2")) * mult
    return edges.groupBy(*keys).agg((F.sum(term) / 2).alias("area"),
                                    F.count(F.lit(1)).alias("n_edges"))
