"""Inputs derived by Spark from the driver's tables, so every query's work
grows with the data.  Each one stands for an input of the incident pipeline:

* ``cells``          customers as small squares in blocks of 50 x 30, the blocks
                     side by side over real longitudes and latitudes (zones)
* ``point_sets``     events as points spread over all zones and as points on
                     the zones' left sides, from one scan
* ``incidents``      orders located at their customer's nation, typed by status
* ``population``     customers per nation
* ``sources``        lineitem rows as three prioritised sources (by return flag)
* ``dirty_coords``   events with coordinate text in several dirty forms
* ``dates``          events as day / month / year parts (some impossible)
* ``log_lines``      events as ordered log lines; signups open a section
* ``sector_demo``    customers as census-sector demographics rows (text)
* ``sector_parts``   customers as sector polygons, two half-cell parts each
* ``raw_incidents``  lineitem rows as landing incident records (text)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_parallelism, table_path

# --- fixed values -----------------------------------------------------------
# Coordinates are whole units of 1/10,000 degree: a quotient of whole numbers is
# the double that the decimal text of a coordinate gives, so equal vertices and
# points on borders have equal bits.
DEGREE = 10000                  # units per degree
CELL = 20                       # units per cell side (0.002 degrees)
GRID_WIDTH = 50                 # cells per row of a block
BLOCK_CELLS = 1500              # cells per block (30 rows)
BLOCKS_ACROSS = 1000            # blocks side by side, with gaps: 104 degrees of longitude
PITCH_X, PITCH_Y = 1040, 640    # units from block to block
WEST, SOUTH = -600000, -300000  # the first block's corner
STATE_CODE = 35
MUNICIPALITY_PREFIX = "35"
STREETS = ("Rua São João", "Avenida Paulista", "Praça da Sé", "Rua Açaí", "Alameda Santos")
DISTRICTS = ("Centro", "Jardim Ângela", "Vila Mariana", "Mooca")
REDACTED = "VEDAÇÃO DA DIVULGAÇÃO DOS DADOS RELATIVOS"
OTHER_TYPES = ("ROUBO DE VEÍCULO", "Furto de veículo", "HOMICÍDIO DOLOSO",
               "LESÃO CORPORAL DOLOSA", "TRÁFICO DE ENTORPECENTES", "ROUBO - OUTROS",
               "EXTRAVIO DE CARGA")   # the last one is in no list of types
CELLPHONE_TYPE = "FURTO ROUBO DE CELULAR"
VEHICLE_TYPE = "FURTO ROUBO DE VEICULO"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def cells(spark, sf_dir) -> DataFrame:
    return ensure_parallelism(table(spark, sf_dir, "customer")).selectExpr(
        "c_custkey AS zone_id", "c_nationkey AS grp",
        f"{lon_units('c_custkey')} AS ux", f"{lat_units('c_custkey')} AS uy")


# widened cells: whole multiples of OVERLAP_STEP beyond the cell on each side
OVERLAP_STEP = 5
OVERLAP_GROUP = 25


def overlap_box(div: str = "DIV") -> list[str]:
    """SQL for the box (x0, y0, x1, y1 in units) of a customer's widened cell:
    neighbours overlap, cross and share parts of their sides."""
    x, y, s = lon_units("c_custkey", div), lat_units("c_custkey", div), OVERLAP_STEP
    return [f"({x} - {s} * (c_custkey % 2))", f"({y} - {s} * (c_custkey % 3))",
            f"({x} + {CELL + s} + {s} * (c_custkey % 4))", f"({y} + {CELL} + {s} * (c_custkey % 2))"]


def overlapping_parts(spark, sf_dir) -> DataFrame:
    """Widened cells as parts, grouped by consecutive keys."""
    x0, y0, x1, y1 = overlap_box()
    return (ensure_parallelism(table(spark, sf_dir, "customer"))
            .selectExpr(f"c_custkey DIV {OVERLAP_GROUP} AS grp", *[f"{degrees(v)} AS {n}" for v, n in
                                                                   ((x0, "x0"), (y0, "y0"), (x1, "xx"), (y1, "yy"))])
            .selectExpr("grp", "array(array(struct(x0 AS x, y0 AS y), struct(xx AS x, y0 AS y), struct(xx AS x, yy AS y), "
                               "struct(x0 AS x, yy AS y), struct(x0 AS x, y0 AS y))) AS rings"))


def lon_units(key: str, div: str = "DIV") -> str:
    """SQL for the left side of cell ``key`` in units (``div``: the dialect's
    whole-number division)."""
    return (f"({WEST} + (({key}) {div} {BLOCK_CELLS}) % {BLOCKS_ACROSS} * {PITCH_X} "
            f"+ ({key}) % {GRID_WIDTH} * {CELL})")


def lat_units(key: str, div: str = "DIV") -> str:
    """SQL for the lower side of cell ``key`` in units."""
    return (f"({SOUTH} + (({key}) {div} {BLOCK_CELLS * BLOCKS_ACROSS}) * {PITCH_Y} "
            f"+ ((({key}) % {BLOCK_CELLS}) {div} {GRID_WIDTH}) * {CELL})")


def degrees(units: str) -> str:
    return f"(CAST({units} AS DOUBLE) / {DEGREE})"


def ring_sql(points) -> str:
    """SQL for a ring at (ux, uy) from points in units."""
    return "array(" + ", ".join(f"named_struct('x', {degrees(f'ux + {a}')}, 'y', {degrees(f'uy + {b}')})"
                                for a, b in points) + ")"


def shape_rings(shape: str) -> str:
    """SQL for the rings of a zone of the given shape anchored at (ux, uy).
    ``tri`` has a diagonal side; ``block`` is a diamond as large as a whole
    block of cells, one a block."""
    square = [(0, 0), (20, 0), (20, 20), (0, 20), (0, 0)]
    if shape == "cell":
        return f"array({ring_sql(square)})"
    if shape == "ell":
        return f"array({ring_sql([(0, 0), (20, 0), (20, 10), (10, 10), (10, 20), (0, 20), (0, 0)])})"
    if shape == "hole":
        return f"array({ring_sql(square)}, {ring_sql([(5, 5), (5, 15), (15, 15), (15, 5), (5, 5)])})"
    if shape == "tri":
        return f"array({ring_sql([(0, 0), (20, 0), (0, 20), (0, 0)])})"
    if shape == "block":
        return (f"CASE WHEN zone_id % {BLOCK_CELLS} = 0 THEN "
                f"array({ring_sql([(0, 300), (500, 0), (1000, 300), (500, 600), (0, 300)])}) END")
    raise ValueError(shape)


def shaped_zones(spark, sf_dir, shape: str) -> DataFrame:
    return cells(spark, sf_dir).select("zone_id", "grp", F.expr(shape_rings(shape)).alias("rings"))


def point_sets(spark, sf_dir) -> DataFrame:
    """Both point sets (``interior``, ``border``) from one scan of events."""
    sets = [("interior", points_sql()), ("border", border_points_sql())]
    return ensure_parallelism(table(spark, sf_dir, "events")).select(
        "event_id", F.explode(F.array(*[F.struct(F.lit(n).alias("pointset"), F.expr(px).alias("px"),
                                                 F.expr(py).alias("py")) for n, (px, py) in sets])).alias("p")
    ).select("p.pointset", "event_id", "p.px", "p.py")


def points_sql():
    """Points over all cells (customers are 3 to 20 events)."""
    key = "event_id * 3 DIV 20"
    return (degrees(f"{lon_units(key)} + 1 + event_id * 7919 % 19"),
            degrees(f"{lat_units(key)} + 1 + event_id * 104729 % 19"))


def border_points_sql():
    key = "event_id * 3 DIV 20"
    return degrees(lon_units(key)), degrees(f"{lat_units(key)} + event_id % 21")


def incidents(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("zone_id"),
        F.year("o_orderdate").cast("int").alias("yr"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("ty"))


def population(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("zone_id")) \
        .agg(F.count(F.lit(1)).cast("int").alias("pop"))


def sources(spark, sf_dir):
    """Three sources with their priorities: R -> 1, A -> 2, N -> 3."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("ty"),
        F.col("l_linenumber").alias("ln"), "l_returnflag")
    return [(li.where(F.col("l_returnflag") == flag).drop("l_returnflag"), prio)
            for flag, prio in (("R", 1), ("A", 2), ("N", 3))]


DIRTY_COORD_SQL = """CASE event_id % 7
  WHEN 0 THEN concat('-', CAST(20 + event_id % 10 AS STRING), CAST(10000 + event_id % 90000 AS STRING))
  WHEN 1 THEN concat('-46.', CAST(event_id % 1000 AS STRING))
  WHEN 2 THEN NULL WHEN 3 THEN '0' WHEN 4 THEN ' -23.5 ' WHEN 5 THEN '46' ELSE 'abc' END"""


def dirty_coords(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{DIRTY_COORD_SQL} AS raw",
        f"{DIRTY_COORD_SQL.replace('event_id', '(event_id + 3)')} AS raw_lat")


def dates(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "1 + event_id % 31 AS d", "1 + event_id % 12 AS m", "2020 + event_id % 5 AS y")


def date_texts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE event_id % 3 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
        "WHEN 1 THEN date_format(ts, 'dd/MM/yyyy') ELSE date_format(ts, 'yyyy-MM-dd') END AS raw")


def log_lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id",
        "CASE WHEN event_type = 'signup' THEN event_id END AS sec",
        "event_type", "CAST(round(value * 100) AS BIGINT) AS cents")


def sector_demo(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        f"concat('{MUNICIPALITY_PREFIX}', lpad(CAST(c_custkey AS STRING), 8, '0')) AS CD_SETOR",
        f"concat('{MUNICIPALITY_PREFIX}', lpad(CAST(c_nationkey AS STRING), 5, '0')) AS CD_MUN",
        "CASE c_custkey % 5 WHEN 0 THEN '35' WHEN 1 THEN '035' WHEN 2 THEN ' 35' "
        "WHEN 3 THEN '35.0' ELSE '33' END AS CD_UF",
        "CASE WHEN c_acctbal < 0 THEN 'X' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) END AS v0001")


def sector_parts(spark, sf_dir, whole_when: str | None = None) -> DataFrame:
    """Two parts per sector: left and right half of its grid cell, or (every
    third sector) the halves below and above its diagonal.  Sectors matching the SQL predicate ``whole_when`` (over ``c_custkey``) are one
    whole-cell part instead, so their sides meet split neighbours at
    T-junctions."""
    c = ensure_parallelism(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = c.join(n, c.c_nationkey == n.n_nationkey).selectExpr(
        f"concat('{MUNICIPALITY_PREFIX}', lpad(CAST(c_custkey AS STRING), 8, '0')) AS CD_SETOR",
        f"concat('{MUNICIPALITY_PREFIX}', lpad(CAST(c_nationkey AS STRING), 5, '0')) AS CD_MUN",
        "n_name AS NM_MUN",
        "CASE c_custkey % 5 WHEN 0 THEN '35' WHEN 1 THEN '035' WHEN 2 THEN ' 35' "
        "WHEN 3 THEN '35.0' ELSE '33' END AS CD_UF",
        f"{lon_units('c_custkey')} AS ux", f"{lat_units('c_custkey')} AS uy",
        "c_custkey % 3 = 0 AS _diagonal", f"{whole_when or 'FALSE'} AS _whole")

    def half(x0, x1):
        return f"array({ring_sql([(x0, 0), (x1, 0), (x1, 20), (x0, 20), (x0, 0)])})"

    def parts_of(*rings):
        return F.array(*[F.struct(F.lit(i + 1).alias("part"), F.expr(r).alias("rings")) for i, r in enumerate(rings)])
    below = f"array({ring_sql([(0, 0), (10, 0), (20, 0), (20, 20), (0, 0)])})"
    above = f"array({ring_sql([(0, 0), (20, 20), (10, 20), (0, 20), (0, 0)])})"
    parts = (F.when(F.col("_whole"), parts_of(half(0, 20))).when(F.col("_diagonal"), parts_of(below, above))
             .otherwise(parts_of(half(0, 10), half(10, 20))))
    return base.select("CD_SETOR", "CD_MUN", "NM_MUN", "CD_UF", F.explode(parts).alias("p")) \
        .select("CD_SETOR", "CD_MUN", "NM_MUN", "CD_UF", "p.part", "p.rings")


def coord_text(units: str, div: str = "DIV", text: str = "STRING") -> str:
    """SQL for the coordinate text of an order in one of three forms, all
    meaning the same number: dotted, without the point, space padded."""
    sign = f"CASE WHEN {units} < 0 THEN '-' ELSE '' END"
    whole = f"CAST(abs({units}) {div} {DEGREE} AS {text})"
    dotted = f"concat({sign}, {whole}, '.', lpad(CAST(abs({units}) % {DEGREE} AS {text}), 4, '0'))"
    # two digits before the point, also below ten degrees: the repair puts the point after two
    digits = f"concat({sign}, lpad(CAST(abs({units}) AS {text}), 6, '0'))"
    return (f"CASE l_orderkey % 3 WHEN 0 THEN {dotted} WHEN 1 THEN {digits} "
            f"ELSE concat(' ', {dotted}, ' ') END")


def incident_units(div: str = "DIV") -> tuple[str, str]:
    """Longitude and latitude of an order's incidents in units: ten orders a
    cell, some on its sides and corners."""
    key = f"(l_orderkey {div} 10)"
    return (f"({lon_units(key, div)} + l_orderkey * 7919 % {CELL + 1})",
            f"({lat_units(key, div)} + l_orderkey * 104729 % {CELL + 1})")


def raw_incidents(spark, sf_dir, source: str) -> DataFrame:
    """Landing records of one source ('cellphones' R, 'vehicles' A, 'others' N)."""
    flag = {"cellphones": "R", "vehicles": "A", "others": "N"}[source]
    li = ensure_parallelism(table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag))
    month, year = ("MES_ESTATISTICA", "ANO_ESTATISTICA") if source == "others" else ("MES", "ANO")
    cols = [
        f"CASE WHEN l_partkey % 20 = 0 THEN '{REDACTED}' WHEN l_partkey % 20 = 1 THEN NULL "
        f"ELSE concat(try_element_at(array({_sql_list(STREETS)}), CAST(l_orderkey % 5 + 1 AS INT)), "
        f"', nº ', CAST(l_orderkey % 97 AS STRING)) END AS LOGRADOURO",
        "CAST(l_orderkey % 1000 AS STRING) AS NUMERO_LOGRADOURO",
        f"try_element_at(array({_sql_list(DISTRICTS)}), CAST(l_orderkey % 4 + 1 AS INT)) AS BAIRRO",
        f"CASE WHEN l_suppkey % 50 = 0 THEN '0' WHEN l_suppkey % 50 = 1 THEN NULL "
        f"ELSE {coord_text("_lat")} END AS LATITUDE",
        f"{coord_text("_lon")} AS LONGITUDE",
        "CASE WHEN l_orderkey % 4 = 0 THEN "
        "concat(lpad(CAST(1 + l_orderkey % 28 AS STRING), 2, '0'), '/', "
        "lpad(CAST(1 + l_orderkey % 12 AS STRING), 2, '0'), '/', CAST(2015 + l_orderkey % 10 AS STRING)) "
        "ELSE concat(CAST(2015 + l_orderkey % 10 AS STRING), '-', lpad(CAST(1 + l_orderkey % 12 AS STRING), 2, '0'), "
        "'-', lpad(CAST(1 + l_orderkey % 28 AS STRING), 2, '0'), ' 10:30:00') END AS DATA_OCORRENCIA_BO",
        f"CAST(1 + l_orderkey % 12 AS STRING) AS {month}",
        f"CAST(2015 + l_orderkey % 10 AS STRING) AS {year}",
    ]
    if source == "others":
        cols.append(f"try_element_at(array({_sql_list(OTHER_TYPES)}), l_linenumber) AS NATUREZA_APURADA")
    lon, lat = incident_units()
    return li.selectExpr("*", f"{lon} AS _lon", f"{lat} AS _lat").selectExpr(*cols)
