"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.coords import coordinate_value, repair_coordinate, valid_coordinate
from ..functions.crs import SIRGAS_2000, WGS_84, srid_of, to_srid, with_srid
from ..functions.dates import assemble_date, day_with_default
from ..functions.geometry import mercator_rings, area_km2_mercator, orient_rings, rings_bbox
from ..functions.keys import entity_key, row_fingerprint, zone_year_sha1, zone_year_sha256
from ..functions.text import label_to_identifier, merge_labels, normalize_text
from ..operators import quality
from ..operators.aggregate import pivot_counts, total_and_type_counts
from ..operators.classify import classify
from ..operators.columns import drop_suffix_columns, drop_void_columns
from ..operators.dedup import keep_top_priority, union_sources
from ..operators.logs import LINE_ORDER, forward_fill, line_order, line_time, parse_log_lines, stage_metrics
from ..operators.rates import rate_index
from ..operators.overlay import union_parts
from ..operators.rings import assemble_polygons, assemble_rings
from ..operators.spatial import dissolve, edges_area, spatial_join, zone_edges
from ..session import concurrently, ensure_parallelism, shared_path, writing
from ..sources import readers, sinks
from . import fixtures as fx
from .layers import layer
from . import pipeline as pl

# --- fixed values -----------------------------------------------------------
FLAGSHIP_GUARD_YEAR = 1997       # rate index guard used on the order-based fixture
TYPE_VALUES = ["F", "O", "P"]    # order status values used as incident types
IN_LIST_ZONES = [3, 7, 11, 13, 2, 5, 17, 19, 23, 0, 1, 4, 6, 8, 9, 10, 12, 14, 16, 18, 7]
FX_CLASSES = {"PROMO": "CHEAP", "ECONOMY": "CHEAP", "LARGE": "BIG"}
FX_MERGE = (("SMALL", "MEDIUM"), "SMALL MEDIUM")
MAP_YEAR = 2024
MAP_MUNICIPALITIES = ["3500003", "3500007", "3500011", "3500013", "3500002", "3500005", "3500017",
                      "3500019", "3500023", "3500000", "3500001", "3500004", "3500006", "3500008",
                      "3500009", "3500010", "3500012", "3500014", "3500016", "3500018", "3500007"]
MAP_CITY = "3500007"
MAP_AFTER_YEAR = 2021
AREA_DIGITS = 9                  # square degrees, rounded for the comparison with SQL
# ---------------------------------------------------------------------------


def T(spark, sf, name):
    return fx.table(spark, sf, name)


# ------------------------------------------------------------ scans/sinks --
def scan_parquet(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice", "o_orderpriority")


def _orders_by_year(spark, sf):
    return T(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.year("o_orderdate").cast("int").alias("YEAR_INFO"),
        F.month("o_orderdate").cast("int").alias("MONTH_INFO"))


ORDERS_YEAR_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("YEAR_INFO", IntegerType())])


def scan_partition_pruned(spark, sf):
    path = shared_path(spark, "orders_by_year")
    sinks.write_partitioned(_orders_by_year(spark, sf).drop("MONTH_INFO"), path, "YEAR_INFO")
    return readers.read_partitioned(spark, path, ORDERS_YEAR_SCHEMA, F.col("YEAR_INFO") == 1998)


def sink_partitioned_roundtrip(spark, sf):
    path = shared_path(spark, "orders_roundtrip")
    sinks.write_partitioned(_orders_by_year(spark, sf).drop("MONTH_INFO"), path, "YEAR_INFO",
                            max_records=1000)
    return readers.read_partitioned(spark, path, ORDERS_YEAR_SCHEMA)


def sink_two_level_partition(spark, sf):
    path = shared_path(spark, "orders_two_level")
    sinks.write_partitioned(_orders_by_year(spark, sf), path, ["YEAR_INFO", "MONTH_INFO"])
    schema = StructType(ORDERS_YEAR_SCHEMA.fields + [StructField("MONTH_INFO", IntegerType())])
    return readers.read_partitioned(spark, path, schema)


def scan_multipart_union(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                      "o_orderpriority", F.year("o_orderdate").cast("int").alias("yr"))
    root = shared_path(spark, "orders_parts")
    even, odd = f"{root}/part=even", f"{root}/part=odd"
    o.where(F.col("yr") % 2 == 0).drop("o_orderpriority").write.mode("overwrite").parquet(even)
    o.where(F.col("yr") % 2 == 1).drop("o_totalprice").write.mode("overwrite").parquet(odd)
    return readers.read_multipart(spark, [even, odd])


def scan_delimited(spark, sf):
    path = shared_path(spark, "customer_csv")
    c = T(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
        "try_element_at(array('São Paulo', 'Campinas – SP', 'Ribeirão Preto'), "
        "CAST(c_custkey % 3 + 1 AS INT)) AS city")
    sinks.write_delimited(c, path)
    return readers.read_delimited(spark, path)


def project_rename(spark, sf):
    return T(spark, sf, "orders").selectExpr(
        "o_orderkey AS ID", "o_custkey AS ID_CUSTOMER", "o_orderstatus AS STATUS",
        "o_totalprice AS PRICE", "CAST(year(o_orderdate) AS INT) AS YEAR_INFO")


def distinct_rows(spark, sf):
    return T(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


def drop_suffix_columns_q(spark, sf):
    p = T(spark, sf, "part").selectExpr("p_partkey", "p_name", "p_type", "p_name AS `p_name.1`",
                                        "p_type AS `p_type.2`", "p_size AS `p_size.10`")
    return drop_suffix_columns(p)


def drop_void_columns_q(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_brand", F.lit(None).alias("void_col"), "p_size")
    return drop_void_columns(p)


# ---------------------------------------------------------------- filters --
def filter_equals_coerced(spark, sf):
    return fx.sector_demo(spark, sf).where(pl.in_state()).select("CD_SETOR", "CD_UF")


def filter_not_like(spark, sf):
    raw = fx.raw_incidents(spark, sf, "others")
    return raw.where(~F.col("LOGRADOURO").like(pl.REDACTION_PATTERN)).select(
        "LOGRADOURO", "NUMERO_LOGRADOURO", "NATUREZA_APURADA")


def filter_in_list(spark, sf):
    return fx.incidents(spark, sf).where(F.col("zone_id").isin(IN_LIST_ZONES) & (F.col("yr") > 1997))


def filter_valid_coords(spark, sf):
    d = fx.dirty_coords(spark, sf).select("event_id", coordinate_value(repair_coordinate("raw")).alias("v"))
    return d.where(valid_coordinate("v"))


def repair_coordinate_q(spark, sf):
    return fx.dirty_coords(spark, sf).select("event_id", "raw", repair_coordinate("raw").alias("repaired"))


def make_points(spark, sf):
    d = fx.dirty_coords(spark, sf)
    return d.select("event_id", coordinate_value(repair_coordinate("raw")).alias("x"),
                    coordinate_value(repair_coordinate("raw_lat")).alias("y"))


# --------------------------------------------------------------- keys/text --
def normalize_text_q(spark, sf):
    docs = ensure_parallelism(T(spark, sf, "documents"))
    return docs.select("doc_id", normalize_text("text").alias("t"))


def row_fingerprint_q(spark, sf):
    c = T(spark, sf, "customer").selectExpr("c_custkey", "c_name", "c_nationkey",
                                            "nullif(c_mktsegment, 'BUILDING') AS c_mktsegment")
    return c.select("c_custkey", row_fingerprint(c.columns).alias("fp"))


def entity_key_q(spark, sf):
    li = T(spark, sf, "lineitem").selectExpr("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                             "nullif(l_returnflag, 'N') AS l_returnflag", "l_linestatus")
    return li.select("l_orderkey", "l_linenumber", entity_key(li.columns).alias("key"))


def zone_year_keys(spark, sf):
    zy = fx.incidents(spark, sf).select("zone_id", "yr").distinct()
    return zy.select("zone_id", "yr", zone_year_sha256("zone_id", "yr").alias("key_sha256"),
                     zone_year_sha1("zone_id", "yr").alias("key_sha1"))


def classify_incident(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_type")
    t = p.withColumn("type_treated", label_to_identifier("p_type"))
    t = t.withColumn("class", classify("type_treated", FX_CLASSES, "OTHER"))
    return t.withColumn("class_treated", label_to_identifier("class"))


def merge_labels_q(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_type")
    return p.select("p_partkey", merge_labels("p_type", FX_MERGE[0], FX_MERGE[1]).alias("label"))


def day_with_default_q(spark, sf):
    d = fx.date_texts(spark, sf)
    return d.select("event_id", "raw", day_with_default("raw").alias("day_info"))


def assemble_date_q(spark, sf):
    d = fx.dates(spark, sf)
    return d.select("event_id", assemble_date("d", "m", "y").alias("date_text"))


# ----------------------------------------------------- union / dedup / agg --
def union_sources_priority(spark, sf):
    return union_sources(fx.sources(spark, sf))


def dedup_priority_rank(spark, sf):
    return keep_top_priority(union_sources(fx.sources(spark, sf)), "id", null_keys=False)


def agg_total_and_pivot(spark, sf):
    return total_and_type_counts(fx.incidents(spark, sf), ["zone_id", "yr"], "id", "ty",
                                 TYPE_VALUES, total_name="total",
                                 names=[f"{v.lower()}_cnt" for v in TYPE_VALUES])


def agg_pivot_counts(spark, sf):
    return pivot_counts(fx.incidents(spark, sf), ["zone_id", "yr"], "ty", TYPE_VALUES)


def _rates(inc, pop, zone, base, hash_fn, key_name):
    counts = total_and_type_counts(inc, [zone, "yr"], "id", "ty", TYPE_VALUES, total_name="total",
                                   names=[f"{v.lower()}_cnt" for v in TYPE_VALUES])
    d = counts.join(pop, zone, "inner")
    return d.select(
        zone, "yr", "total", "f_cnt", "o_cnt", "p_cnt",
        rate_index("total", "pop", base, "yr", FLAGSHIP_GUARD_YEAR).alias("total_index"),
        rate_index("f_cnt", "pop", base).alias("f_index"),
        rate_index("o_cnt", "pop", base).alias("o_index"),
        hash_fn(zone, "yr").alias(key_name))


def rate_index_sector(spark, sf):
    return _rates(fx.incidents(spark, sf), fx.population(spark, sf), "zone_id", 1000,
                  zone_year_sha256, "zone_year_key")


def _region_incidents(spark, sf):
    n = T(spark, sf, "nation").select(F.col("n_nationkey").alias("zone_id"),
                                      F.col("n_regionkey").alias("region_id"))
    return n


def rate_index_municipality(spark, sf):
    n = _region_incidents(spark, sf)
    inc = fx.incidents(spark, sf).join(n, "zone_id").drop("zone_id")
    pop = agg_population_rollup_fx(spark, sf)
    return _rates(inc, pop, "region_id", 100000, zone_year_sha1, "zone_year_key")


def agg_population_rollup_fx(spark, sf):
    n = _region_incidents(spark, sf)
    return fx.population(spark, sf).join(n, "zone_id").groupBy("region_id") \
        .agg(F.sum("pop").cast("int").alias("pop"))


def agg_population_rollup(spark, sf):
    return pl.municipality_population(fx.sector_demo(spark, sf))


def silver_sector_population(spark, sf):
    return pl.sector_population(fx.sector_demo(spark, sf))


# ---------------------------------------------------------------- quality --
def quality_not_null(spark, sf):
    li = T(spark, sf, "lineitem").selectExpr("l_orderkey", "l_partkey",
                                             "nullif(l_returnflag, 'N') AS l_returnflag")
    return quality.not_null_report(li, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag"])


def quality_unique(spark, sf):
    li = T(spark, sf, "lineitem")
    return quality.unique_report(li, "lineitem", "l_orderkey").unionByName(
        quality.unique_report(li, "lineitem", ["l_orderkey", "l_linenumber"]))


def quality_report(spark, sf):
    src = union_sources(fx.sources(spark, sf))
    return quality.quality_report(src, "sources", unique=[["id"], ["id", "ln", "priority"]],
                                  not_null=["id", "ty", "priority"])


# ------------------------------------------------------------------- logs --
def log_stage_metrics(spark, sf):
    lines = fx.log_lines(spark, sf)
    filled = forward_fill(lines, "event_id", "sec", "section")
    body = filled.where(F.col("section").isNotNull())

    def last(t):
        return F.expr(f"max_by(cents, event_id) FILTER (WHERE event_type = '{t}')")
    agg = body.groupBy("section").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "view", F.col("cents"))), F.lit(0)).cast("bigint")
         .alias("read_cents"),
        F.coalesce(last("click"), F.lit(0)).cast("bigint").alias("treat_cents"),
        F.coalesce(last("purchase"), F.lit(0)).cast("bigint").alias("write_cents"),
        F.coalesce(last("error"), F.lit(0)).cast("bigint").alias("test_cents"))
    return agg.withColumn("total_cents", F.col("read_cents") + F.col("treat_cents") + F.col("write_cents"))


def _write_logs(spark, sf):
    """Events written as run-log text files (two runs, one folder each) in the
    shared folder.  Each run is a folder of sorted part files (no single
    writer).  Line times are whole hours, so many lines share one and their
    order is that of the files.  Times are written from integer cents."""
    ev = T(spark, sf, "events")
    cents = F.round(F.col("value") * 100).cast("long")
    secs = F.concat((cents / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"), F.lit("s"))
    msg = (F.when(F.col("event_type") == "signup",
                  F.concat(F.lit("########## SILVER: table_"), F.col("user_id").cast("string")))
            .when(F.col("event_type") == "view", F.concat(F.lit("read_data: "), secs))
            .when(F.col("event_type") == "click", F.concat(F.lit("treat_data: "), secs))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("write_data: "), secs))
            .otherwise(F.concat(F.lit("rows: "), F.col("user_id").cast("string"))))
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:00:00"), F.lit(" - ETL - INFO - "), msg)
    root = shared_path(spark, "logs")
    for run in (1, 2):
        (ev.where(F.col("event_id") % 2 == run - 1).orderBy("ts", "event_id").select(line.alias("value"))
           .write.mode("overwrite").text(f"{root}/run{run}_ETL"))
    return root


def log_scan(spark, sf):
    """Stage metrics of the newest run log (as the reference reads its newest
    log file): the run folder holding the newest file, its lines parsed and
    filled into sections in time order."""
    root = _write_logs(spark, sf)
    lines = readers.read_text_lines(spark, f"{root}/*_ETL") \
        .withColumn("run", F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1))
    newest = readers.latest_file(lines, "run").select("run")            # one row
    lines = lines.join(newest, "run", "left_semi")
    m = stage_metrics(line_order(parse_log_lines(lines)), LINE_ORDER)
    m = m.withColumn("section_start", line_time("section_start"))
    times = ("read_time", "treat_time", "write_time", "test_time", "total_time")
    return m.select(*[F.round(c, 2).alias(c) if c in times else c for c in m.columns])


def log_latest_file(spark, sf):
    root = _write_logs(spark, sf)
    newest = readers.latest_file(readers.read_text_lines(spark, f"{root}/*_ETL"))
    return newest.select(F.regexp_extract("file_path", r"(run\d+)_ETL", 1).alias("run"))


# --------------------------------------------------------------- geometry --
def scan_zones(spark, sf):
    path = shared_path(spark, "zones")
    fx.sector_parts(spark, sf).write.mode("overwrite").parquet(path)
    z = readers.read_parquet(spark, path)
    return z.select("CD_SETOR", "part", F.size("rings").alias("n_rings"),
                    F.size(F.flatten("rings")).alias("n_points"), rings_bbox("rings").alias("b")) \
            .select("CD_SETOR", "part", "n_rings", "n_points",
                    F.col("b.x0").alias("x0"), F.col("b.y0").alias("y0"),
                    F.col("b.x1").alias("x1"), F.col("b.y1").alias("y1"))


def zone_area_km2(spark, sf):
    z = fx.sector_parts(spark, sf).withColumn("rings", orient_rings("rings"))
    return z.select("CD_SETOR", "part",
                    F.round(area_km2_mercator("rings"), 6).alias("area_km2"))


def reproject_mercator(spark, sf):
    z = fx.sector_parts(spark, sf).select("CD_SETOR", "part", mercator_rings("rings").alias("m"))
    b = z.select("CD_SETOR", "part", rings_bbox("m").alias("b"))
    return b.select("CD_SETOR", "part", *[(F.round(F.col(f"b.{k}"), 3) + F.lit(0.0)).alias(f"{k}m")
                                          for k in ("x0", "y0", "x1", "y1")])


def spatial_join_points_zones(spark, sf):
    """Both point sets against five zone shapes (one of them 1,500 times as
    large as the others) in one join: the shape is
    part of the zone key, so cells, cell size and the join are built once."""
    pts = fx.point_sets(spark, sf)
    zones = fx.cells(spark, sf).select(
        "zone_id", F.explode(F.array(*[F.struct(F.lit(shape).alias("shape"), F.expr(fx.shape_rings(shape))
                                                .alias("rings")) for shape in ("cell", "ell", "hole", "tri", "block")]))
        .alias("z")).select("z.shape", "zone_id", "z.rings")
    edges = zone_edges(zones, ["shape", "zone_id"])
    j = spatial_join(pts, edges, ["shape", "zone_id"], x="px", y="py")
    return j.select("shape", "pointset", "event_id", "zone_id")


def srid_checked_join(spark, sf):
    """Points and zones written in two reference systems; each table read back
    tells its own, and the join takes them once they are in one system."""
    points, zones = (shared_path(spark, name) for name in ("points-4674", "zones-4326"))
    with_srid(fx.point_sets(spark, sf), SIRGAS_2000, "px", "py").write.parquet(points)
    with_srid(fx.shaped_zones(spark, sf, "cell"), WGS_84, "rings").write.parquet(zones)
    edges = zone_edges(spark.read.parquet(zones), ["zone_id"])
    pts = to_srid(spark.read.parquet(points), srid_of(edges, "x1", "y1", "x2", "y2"), x="px", y="py")
    j = spatial_join(pts, edges, ["zone_id"], x="px", y="py")
    return j.groupBy("zone_id").agg(F.count("*").alias("n_points")).withColumn("srid", F.lit(srid_of(j, "px", "py")))


def _cell_edges(spark, sf):
    return zone_edges(fx.shaped_zones(spark, sf, "cell"), ["grp"])


def dissolve_boundary_edges(spark, sf):
    return dissolve(_cell_edges(spark, sf), ["grp"]).drop("mult")


def dissolve_area(spark, sf):
    return rounded(edges_area(dissolve(_cell_edges(spark, sf), ["grp"]), ["grp"]))


def rounded(df):
    return df.withColumn("area", F.round("area", AREA_DIGITS))


def dissolve_rings(spark, sf):
    """Dissolved boundaries stitched into ordered rings; per group the vertex
    count and the shoelace area over the ring order."""
    rings = assemble_rings(dissolve(_cell_edges(spark, sf), ["grp"]), ["grp"])
    return rounded(rings.groupBy("grp").agg(F.sum(F.size("vertices") - 1).alias("n_vertices"),
                                            F.sum("area").alias("area")))


def dissolve_polygons(spark, sf):
    """Rings grouped into polygons (holes under their smallest enclosing
    exterior); per group the vertex count and area over all polygons."""
    polys = assemble_polygons(dissolve(_cell_edges(spark, sf), ["grp"]), ["grp"])
    n = F.aggregate(F.col("polygons"), F.lit(0).cast("long"), lambda acc, poly: acc + F.aggregate(
        poly, F.lit(0).cast("long"), lambda a, r: a + F.size(r) - 1))
    return rounded(polys.select("grp", n.alias("n_vertices"), "area"))


def _shoelace(ring):
    """Signed area of a closed ring of [x, y] pairs (a Column of arrays)."""
    return F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0.0),
                       lambda acc, k: acc + (ring[k - 1][0] - ring[k][0]) * (ring[k - 1][1] + ring[k][1])) / 2


def geojson_municipalities(spark, sf):
    """Dissolved municipalities written as GeoJSON MultiPolygon features and
    read back: per feature its vertex count and area from the coordinates."""
    path = shared_path(spark, "geojson_mun")
    edges = pl.zone_boundaries(fx.sector_parts(spark, sf), pl.MUNICIPALITY_KEYS)
    polys = assemble_polygons(edges, pl.MUNICIPALITY_KEYS)
    sinks.geojson_multipolygons(polys.drop("area")).write.mode("overwrite").text(path)
    schema = ("geometry struct<type string, coordinates array<array<array<array<double>>>>>, "
              "properties struct<CD_MUN string, NM_MUN string>")
    f = spark.read.text(path).select(F.from_json("value", schema).alias("f")).select("f.*")
    coords = F.col("geometry.coordinates")
    n = F.aggregate(coords, F.lit(0).cast("long"), lambda acc, poly: acc + F.aggregate(
        poly, F.lit(0).cast("long"), lambda a, r: a + F.size(r) - 1))
    area = F.aggregate(coords, F.lit(0.0), lambda acc, poly: acc + F.aggregate(
        poly, F.lit(0.0), lambda a, r: a + _shoelace(r)))
    return f.select(F.col("properties.CD_MUN").alias("CD_MUN"), F.col("properties.NM_MUN").alias("NM_MUN"),
                    F.col("geometry.type").alias("geometry_type"), n.alias("n_points"),
                    F.round(area, AREA_DIGITS).alias("area"))


def dissolve_t_junctions(spark, sf):
    """Municipalities dissolved from sectors where the grid's even rows are
    whole cells and odd rows two halves: a whole cell's top or bottom side
    meets a split neighbour's corner mid-side.  Edges are split at those
    vertices first, so shared borders cancel; per municipality the boundary
    edge count and area."""
    parts = fx.sector_parts(spark, sf, whole_when=f"(c_custkey DIV {fx.GRID_WIDTH}) % 2 = 0")
    edges = dissolve(zone_edges(parts.where(pl.in_state()), ["CD_MUN"]), ["CD_MUN"], split_cell=0.001)
    return rounded(edges_area(edges, ["CD_MUN"]).select("CD_MUN", "n_edges", "area"))


def union_overlapping(spark, sf):
    """Union of overlapping parts by group: area and length of the boundary."""
    edges = union_parts(zone_edges(fx.overlapping_parts(spark, sf), ["grp"]), ["grp"])
    return edges.groupBy("grp").agg(
        F.round(F.sum((F.col("x1") - F.col("x2")) * (F.col("y1") + F.col("y2"))) / 2, AREA_DIGITS).alias("area"),
        F.round(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), 6).alias("length"))


def geojson_features_q(spark, sf):
    """Zone parts written as GeoJSON Polygon features and read back."""
    path = shared_path(spark, "geojson")
    z = fx.sector_parts(spark, sf).select("CD_SETOR", "CD_MUN", "part", "rings")
    sinks.write_geojson_lines(z, path)
    schema = ("geometry struct<type string, coordinates array<array<array<double>>>>, "
              "properties struct<CD_SETOR string, CD_MUN string, part int>")
    f = spark.read.text(path).select(F.from_json("value", schema).alias("f")).select("f.*")
    coords = F.col("geometry.coordinates")
    return f.select("properties.CD_SETOR", "properties.CD_MUN", "properties.part",
                    F.col("geometry.type").alias("geometry_type"), F.size(coords).alias("n_rings"),
                    F.aggregate(coords, F.lit(0), lambda acc, r: acc + F.size(r)).alias("n_points"),
                    F.round(_shoelace(coords[0]), AREA_DIGITS).alias("area"))


# -------------------------------------------------------------- pipeline --
def _sector_tables(spark, sf, persist: bool = False):
    keep = (lambda e: pl.materialize(e, "silver_sector_edges")) if persist else None
    geom, edges = pl.sector_geometry(fx.sector_parts(spark, sf), persist=keep)
    sectors = pl.zone_with_population(geom, pl.sector_population(fx.sector_demo(spark, sf)), "ID_SC")
    if persist:
        sectors = pl.materialize(sectors, "silver_sectors", "YEAR_INFO")
    return sectors, edges


def _municipality_table(spark, sf):
    def build():
        geom, _ = pl.municipality_geometry(fx.sector_parts(spark, sf))
        mun = pl.zone_with_population(geom, pl.municipality_population(fx.sector_demo(spark, sf)), "ID_MUN")
        return pl.materialize(mun, "silver_municipalities")
    return layer(spark, sf, "silver_municipalities", ("customer", "nation"), build)


def bronze_table(spark, sf):
    raw = fx.raw_incidents(spark, sf, "cellphones").withColumn("ANO.1", F.col("ANO")) \
        .withColumn("VAZIO", F.lit(None))
    return pl.bronze(raw, year_col="ANO")


def bronze_incremental(spark, sf):
    """Landing files, one partition folder per year (``ANO=<year>``), ingested
    by the streaming bronze job; the file source discovers the year from the
    folder names."""
    from ..streaming.ingest import ingest_landing
    root = shared_path(spark, "landing_cellphones")
    raw = fx.raw_incidents(spark, sf, "cellphones")
    raw.write.partitionBy("ANO").mode("overwrite").parquet(f"{root}/landing")
    table = ingest_landing(spark, f"{root}/landing", raw.schema, f"{root}/bronze", f"{root}/_checkpoint",
                           year_col="ANO", files_per_batch=64)
    return table.read().select(*[c for c in raw.columns], "ID", F.col("YEAR_INFO").cast("int").alias("YEAR_INFO"))


def silver_sector_geometry(spark, sf):
    geom, _ = pl.sector_geometry(fx.sector_parts(spark, sf))
    return geom.select("ID_SC", "ID_MUN", "MUN", "STATE", F.round("AREA_KM2", 6).alias("AREA_KM2"), "n_edges")


def silver_municipality_geometry(spark, sf):
    geom, _ = pl.municipality_geometry(fx.sector_parts(spark, sf))
    return geom.select("ID_MUN", "MUN", "STATE", F.round("AREA_KM2", 5).alias("AREA_KM2"), "n_edges")


def join_zone_demographics(spark, sf):
    sectors, _ = _sector_tables(spark, sf)
    return sectors.select("ID_SC", "ID_MUN", "MUN", "STATE", F.round("AREA_KM2", 6).alias("AREA_KM2"),
                          "POP_TOTAL", "YEAR_INFO")


def silver_incident_source(spark, sf):
    return pl.incident_source(fx.raw_incidents(spark, sf, "cellphones"), crime_type=pl.CELLPHONE_TYPE)


def silver_incident_other(spark, sf):
    return pl.incident_source(fx.raw_incidents(spark, sf, "others"), month="MES_ESTATISTICA",
                              year="ANO_ESTATISTICA", type_col="NATUREZA_APURADA")


def _bronze(spark, sf, source):
    """Bronze table of one landing source, written once (partitioned by year)."""
    year = "ANO_ESTATISTICA" if source == "others" else "ANO"
    rows, late = pl.bronze_parts(fx.raw_incidents(spark, sf, source), year_col=year)
    return pl.materialize(rows, f"bronze_{source}", "YEAR_INFO", late=late)


def _silver_incidents(spark, sf):
    """Silver layer as the pipeline runs it: each source and the sector
    tables are written once, union / de-dup / spatial join read them, and the
    result is written partitioned by year and month.  Gold steps in the same
    application read the written tables."""
    def source(name, **kw):
        rows, late = pl.incident_source_parts(_bronze(spark, sf, name), **kw)
        return pl.materialize(rows, f"silver_incidents_{name}", "YEAR_INFO", late=late)

    def build():
        # the sector tables and the three source chains are independent
        (sectors, edges), cel, veh, oth = concurrently(
            lambda: _sector_tables(spark, sf, persist=True),
            lambda: source("cellphones", crime_type=pl.CELLPHONE_TYPE),
            lambda: source("vehicles", crime_type=pl.VEHICLE_TYPE),
            lambda: source("others", month="MES_ESTATISTICA", year="ANO_ESTATISTICA",
                           type_col="NATUREZA_APURADA"))
        rows, late = pl.incident_parts(cel, veh, oth, edges, sectors)
        silver = pl.materialize(rows, "silver_incidents", ["YEAR_INFO", "MONTH_INFO"], late=late)
        return silver, sectors
    return layer(spark, sf, "silver_incidents", ("lineitem", "customer", "nation"), build)


def silver_incidents(spark, sf):
    return _silver_incidents(spark, sf)[0]


def gold_incidents(spark, sf):
    return pl.gold_incidents(_silver_incidents(spark, sf)[0])


def gold_sector_rates(spark, sf):
    silver, sectors = _silver_incidents(spark, sf)
    return pl.sector_rates(silver, sectors.drop("n_edges")) \
        .withColumn("AREA_KM2", F.round("AREA_KM2", 6))


def gold_municipality_rates(spark, sf):
    silver, _ = _silver_incidents(spark, sf)
    return pl.municipality_rates(silver, _municipality_table(spark, sf).drop("n_edges")) \
        .withColumn("AREA_KM2", F.round("AREA_KM2", 5))


def map_extract_municipality(spark, sf):
    g = gold_municipality_rates(spark, sf).where(F.col("YEAR_INFO") == MAP_YEAR)
    return g.select("ID_MUN", "MUN", "STATE", "TOTAL_CRIMES", "FURTO_ROUBO_DE_CELULAR",
                    "FURTO_ROUBO_DE_VEICULO", "POP_TOTAL", "TOTAL_CRIME_INDEX",
                    "CELLPHONE_CRIME_INDEX", "VEHICLE_CRIME_INDEX")


def map_extract_sectors(spark, sf):
    g = gold_sector_rates(spark, sf).where((F.col("YEAR_INFO") == MAP_YEAR)
                                           & F.col("ID_MUN").isin(MAP_MUNICIPALITIES))
    return g.select("ID_SC", "MUN", "STATE", "TOTAL_CRIMES", "FURTO_ROUBO_DE_CELULAR",
                    "FURTO_ROUBO_DE_VEICULO", "POP_TOTAL", "TOTAL_CRIME_INDEX",
                    "CELLPHONE_CRIME_INDEX", "VEHICLE_CRIME_INDEX")


def _map_layer(spark, extract: DataFrame, edges: DataFrame, zone_key: str, id_col: str, name: str,
               props: str) -> DataFrame:
    """Indices of a map extract on the dissolved polygons of its zones, written
    as GeoJSON features and read back (per feature its properties, vertex
    count and area from the coordinates)."""
    polys = assemble_polygons(edges, [zone_key]).select(F.col(zone_key).alias(id_col), "polygons")
    path = shared_path(spark, name)
    sinks.geojson_multipolygons(extract.join(polys, id_col)).write.mode("overwrite").text(path)
    schema = (f"geometry struct<type string, coordinates array<array<array<array<double>>>>>, "
              f"properties struct<{props}>")
    f = spark.read.text(path).select(F.from_json("value", schema).alias("f")).select("f.*")
    coords = F.col("geometry.coordinates")
    n = F.aggregate(coords, F.lit(0).cast("long"), lambda acc, poly: acc + F.aggregate(
        poly, F.lit(0).cast("long"), lambda a, r: a + F.size(r) - 1))
    area = F.aggregate(coords, F.lit(0.0), lambda acc, poly: acc + F.aggregate(
        poly, F.lit(0.0), lambda a, r: a + _shoelace(r)))
    return f.select("properties.*", n.alias("n_points"), F.round(area, AREA_DIGITS).alias("area"))


def map_layer_municipality(spark, sf):
    """The municipality map layer: 2024 indices on the dissolved municipality
    polygons."""
    g = map_extract_municipality(spark, sf).select("ID_MUN", "MUN", "TOTAL_CRIMES", "POP_TOTAL",
                                                   "TOTAL_CRIME_INDEX")
    edges = pl.zone_boundaries(fx.sector_parts(spark, sf), ["CD_MUN"])
    return _map_layer(spark, g, edges, "CD_MUN", "ID_MUN", "map_layer_mun",
                      "ID_MUN string, MUN string, TOTAL_CRIMES bigint, POP_TOTAL int, TOTAL_CRIME_INDEX double")


def map_layer_sectors(spark, sf):
    """The sector map layer: 2024 indices of the listed municipalities' sectors
    on the sector polygons (each dissolved from its parts)."""
    g = map_extract_sectors(spark, sf).select("ID_SC", "MUN", "TOTAL_CRIMES", "POP_TOTAL", "TOTAL_CRIME_INDEX")
    parts = fx.sector_parts(spark, sf).where(F.col("CD_MUN").isin(MAP_MUNICIPALITIES))
    edges = pl.zone_boundaries(parts, ["CD_SETOR"])
    return _map_layer(spark, g, edges, "CD_SETOR", "ID_SC", "map_layer_scs",
                      "ID_SC string, MUN string, TOTAL_CRIMES bigint, POP_TOTAL int, TOTAL_CRIME_INDEX double")


def map_extract_incidents(spark, sf):
    g = gold_incidents(spark, sf).where((F.col("ID_MUN") == MAP_CITY) & (F.col("YEAR_INFO") > MAP_AFTER_YEAR))
    return g.select("ID_CRIME", "CRIMINAL_CLASS", "CRIMINAL_TYPE", "ID_MUN", "MUN", "YEAR_INFO",
                    assemble_date("DAY_INFO", "MONTH_INFO", "YEAR_INFO").alias("DATE_CRIME"),
                    F.col("y").alias("lat"), F.col("x").alias("long"))


def map_layer_incidents(spark, sf):
    """The incident layer: points of the city's incidents, written as GeoJSON
    features and read back."""
    path = shared_path(spark, "map_layer_incidents")
    g = map_extract_incidents(spark, sf).select("ID_CRIME", "CRIMINAL_CLASS", "YEAR_INFO", "DATE_CRIME", "long", "lat")
    sinks.geojson_points(g, "long", "lat").write.mode("overwrite").text(path)
    schema = ("geometry struct<type string, coordinates array<double>>, "
              "properties struct<ID_CRIME string, CRIMINAL_CLASS string, YEAR_INFO int, DATE_CRIME string>")
    f = spark.read.text(path).select(F.from_json("value", schema).alias("f")).select("f.*")
    return f.select("properties.*", F.col("geometry.type").alias("geometry_type"),
                    F.col("geometry.coordinates")[0].alias("long"), F.col("geometry.coordinates")[1].alias("lat"))


def map_layer_city_border(spark, sf):
    """The border layer: the city's outline, dissolved from its sectors."""
    parts = fx.sector_parts(spark, sf).where(F.col("CD_MUN") == MAP_CITY)
    names = parts.where(pl.in_state()).select(F.col("CD_MUN").alias("ID_MUN"), F.col("NM_MUN").alias("MUN")).distinct()
    return _map_layer(spark, names, pl.zone_boundaries(parts, ["CD_MUN"]), "CD_MUN", "ID_MUN", "map_layer_border",
                      "ID_MUN string, MUN string")


def silver_rejects(spark, sf):
    """Landing records left out of the incident sources, by source and reason."""
    a, b, c = (pl.incident_rejects(fx.raw_incidents(spark, sf, s), s) for s in ("cellphones", "vehicles", "others"))
    return a.unionByName(b).unionByName(c)


def etl_table_rows(spark, sf):
    """The whole layered run (every table written, read back and checked);
    rows per table from the metrics of the run's own log."""
    from .etl import run_etl
    return run_etl(spark, sf)["metrics"].select("level", "table_name", "row_count")


LANDING_YEARS = list(range(2015, 2025))


def write_landing(spark, sf, base: str) -> dict:
    """Landing folders of the three incident sources, one folder a year, with
    headings that differ between the years and a part that holds no data;
    returns the spec that reads them."""
    tables = {}
    readers.allow_charset(spark, readers.DELIMITED_ENCODING)      # the caller's session may not have the flag
    for source, fmt in (("cellphones", "csv"), ("vehicles", "parquet"), ("others", "csv")):
        year = "ANO_ESTATISTICA" if source == "others" else "ANO"
        raw = fx.raw_incidents(spark, sf, source).withColumn("y", F.col(year))
        columns = [c for c in raw.columns if c != "y"]
        place = f"{base}/{source}"

        def put(part, order, mode):
            with writing(spark):        # a file per task and year, without an exchange or a sort
                out = part.select(*order, "y").write.partitionBy("y").mode(mode)
                if fmt == "csv":
                    (out.option("sep", ";").option("encoding", readers.DELIMITED_ENCODING).option("header", True)
                        .option("compression", "gzip")
                        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(place))
                else:
                    out.option("compression", sinks.LAYER_COMPRESSION).parquet(place)
        odd = F.col("y").cast("int") % 2 == 1
        put(raw.where(odd), columns, "overwrite")
        put(raw.where(~odd).withColumn("OBS", F.lit(None).cast("string")), ["OBS", *reversed(columns)], "append")
        if fmt == "csv":
            note = spark.range(1).select(F.lit("field").alias("CAMPO"), F.lit("meaning").alias("DESCRIÇÃO"))
            sinks.write_delimited(note, f"{place}/y={LANDING_YEARS[0]}/METODOLOGIA")
        tables[f"bronze_crimes_{source}"] = {"input": f"{source}/y={{year}}", "format": fmt, "years": LANDING_YEARS,
                                             "skip_parts": ["METODOLOGIA"]}
    return {"base": base, "tables": tables}


def landing_run(spark, sf):
    """The whole layered run with the incident tables read from landing files
    by spec; contents of its gold sector table, polygons included."""
    import copy
    from .etl import RUN_SPEC, run_etl
    landing = write_landing(spark, sf, shared_path(spark, "landing"))
    gold = run_etl(spark, sf, spec={**copy.deepcopy(RUN_SPEC), "landing": landing})["tables"]["gold_crimes_scs"]
    return (gold.withColumn("AREA_KM2", F.round("AREA_KM2", 6)).withColumn("n_polygons", F.size("polygons"))
            .withColumn("n_points", F.size(F.expr("polygons[0][0]"))).drop("polygons"))


def gold_refresh(spark, sf):
    """Gold incidents built once, then brought up to date after one year of
    silver lost its first six months: only that year is rebuilt."""
    from ..sources.versions import VersionedTable
    from .refresh import refresh
    root = shared_path(spark, "refresh")
    silver, gold = VersionedTable(spark, f"{root}/silver"), VersionedTable(spark, f"{root}/gold")
    rows = _silver_incidents(spark, sf)[0]
    packed, late = pl.packed_incidents(rows)
    silver.replace(packed, "YEAR_INFO", late=late)
    refresh(silver, gold, pl.gold_incidents, "YEAR_INFO")
    year = max(n for n in silver.manifest()["folders"] if n.startswith("YEAR_INFO=2"))
    silver.replace(silver.read(names=[year]).where("MONTH_INFO > 6"), "YEAR_INFO", keep="untouched")
    if refresh(silver, gold, pl.gold_incidents, "YEAR_INFO") != [year]:
        raise AssertionError("a year that did not change was rebuilt")
    return gold.read()


# the map window: shares of the incidents' extent on both axes
WINDOW_SHARE = (0.25, 0.6)


def map_window(spark, sf):
    """Incidents of a map window, read from a table laid out by place: the
    window's comparisons reach the parquet scan and skip what lies elsewhere."""
    from ..sources.versions import VersionedTable
    table = VersionedTable(spark, shared_path(spark, "by_place"))
    packed, late = pl.packed_incidents(_silver_incidents(spark, sf)[0])
    table.replace(packed, "YEAR_INFO", near=("x", "y"), late=late)
    rows = table.read()
    box = rows.agg(*[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))]).first()
    for c in ("x", "y"):
        low, size = box[f"lo_{c}"], box[f"hi_{c}"] - box[f"lo_{c}"]
        rows = rows.where(F.col(c).between(low + WINDOW_SHARE[0] * size, low + WINDOW_SHARE[1] * size))
    return rows.select(*pl.INCIDENT_COLUMNS)


QUERIES = {
    "scan_parquet": scan_parquet,
    "scan_partition_pruned": scan_partition_pruned,
    "scan_multipart_union": scan_multipart_union,
    "scan_delimited": scan_delimited,
    "sink_partitioned_roundtrip": sink_partitioned_roundtrip,
    "sink_two_level_partition": sink_two_level_partition,
    "project_rename": project_rename,
    "distinct_rows": distinct_rows,
    "drop_suffix_columns": drop_suffix_columns_q,
    "drop_void_columns": drop_void_columns_q,
    "filter_equals_coerced": filter_equals_coerced,
    "filter_not_like": filter_not_like,
    "filter_in_list": filter_in_list,
    "filter_valid_coords": filter_valid_coords,
    "repair_coordinate": repair_coordinate_q,
    "make_points": make_points,
    "normalize_text": normalize_text_q,
    "row_fingerprint": row_fingerprint_q,
    "entity_key": entity_key_q,
    "zone_year_keys": zone_year_keys,
    "classify_incident": classify_incident,
    "merge_labels": merge_labels_q,
    "day_with_default": day_with_default_q,
    "assemble_date": assemble_date_q,
    "union_sources_priority": union_sources_priority,
    "dedup_priority_rank": dedup_priority_rank,
    "agg_total_and_pivot": agg_total_and_pivot,
    "agg_pivot_counts": agg_pivot_counts,
    "agg_population_rollup": agg_population_rollup,
    "rate_index_sector": rate_index_sector,
    "rate_index_municipality": rate_index_municipality,
    "quality_not_null": quality_not_null,
    "quality_unique": quality_unique,
    "quality_report": quality_report,
    "log_stage_metrics": log_stage_metrics,
    "log_scan": log_scan,
    "log_latest_file": log_latest_file,
    "scan_zones": scan_zones,
    "zone_area_km2": zone_area_km2,
    "reproject_mercator": reproject_mercator,
    "spatial_join_points_zones": spatial_join_points_zones,
    "srid_checked_join": srid_checked_join,
    "dissolve_boundary_edges": dissolve_boundary_edges,
    "dissolve_area": dissolve_area,
    "dissolve_rings": dissolve_rings,
    "dissolve_polygons": dissolve_polygons,
    "dissolve_t_junctions": dissolve_t_junctions,
    "geojson_features": geojson_features_q,
    "geojson_municipalities": geojson_municipalities,
    "bronze_table": bronze_table,
    "bronze_incremental": bronze_incremental,
    "silver_sector_population": silver_sector_population,
    "silver_sector_geometry": silver_sector_geometry,
    "silver_municipality_geometry": silver_municipality_geometry,
    "join_zone_demographics": join_zone_demographics,
    "silver_incident_source": silver_incident_source,
    "silver_incident_other": silver_incident_other,
    "silver_incidents": silver_incidents,
    "gold_incidents": gold_incidents,
    "gold_sector_rates": gold_sector_rates,
    "gold_municipality_rates": gold_municipality_rates,
    "map_extract_municipality": map_extract_municipality,
    "map_extract_sectors": map_extract_sectors,
    "map_extract_incidents": map_extract_incidents,
    "map_layer_municipality": map_layer_municipality,
    "map_layer_sectors": map_layer_sectors,
    "map_layer_incidents": map_layer_incidents,
    "map_layer_city_border": map_layer_city_border,
    "silver_rejects": silver_rejects,
    "etl_table_rows": etl_table_rows,
    "landing_run": landing_run,
    "union_overlapping": union_overlapping,
    "gold_refresh": gold_refresh,
    "map_window": map_window,
}
