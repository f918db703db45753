"""Reference SQL (DuckDB dialect) for the registered queries.

Each statement is written independently of the Spark plan: geometry by closed
forms and rectangle predicates, de-duplication with a rank window, pivots with
filtered counts.  Shared fixed values (fold table, type lists, grid) are
imported so both sides use the same inputs.
"""

from __future__ import annotations

from ..functions.text import FOLD_FROM, FOLD_MULTI, FOLD_TO
from ..operators.classify import INCIDENT_CLASSES, VEHICLE_LABELS, VEHICLE_MERGED
from . import catalog as C
from . import fixtures as fx
from . import pipeline as pl

R = 6378137.0


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def norm(col: str) -> str:
    folded = f"translate({col}, {q(FOLD_FROM)}, {q(FOLD_TO)})"
    for src, dst in FOLD_MULTI:
        folded = f"replace({folded}, {q(src)}, {q(dst)})"
    return (f"upper(trim(regexp_replace(regexp_replace({folded}, '[^a-zA-Z0-9\\s]', '', 'g'), "
            f"'\\s+', ' ', 'g')))")


def repair(col: str) -> str:
    t = f"trim({col})"
    body = f"ltrim({t}, '-')"
    return (f"(CASE WHEN {t} IS NULL THEN NULL WHEN contains({t}, '.') THEN {t} "
            f"ELSE (CASE WHEN starts_with({t}, '-') THEN '-' ELSE '' END) || "
            f"(CASE WHEN length({body}) <= 2 THEN {body} "
            f"ELSE substr({body}, 1, 2) || '.' || substr({body}, 3) END) END)")


def coord_value(text: str) -> str:
    return (f"(CASE WHEN abs(try_cast({text} AS DOUBLE)) < 10000 "
            f"THEN try_cast({text} AS DOUBLE) END)")


def merc_y(y: str) -> str:
    return f"({R} * ln(tan(pi() / 4 + radians({y}) / 2)))"


def cell_area_km2(uy: str, width: str) -> str:
    """Mercator area of a cell row from ``uy`` (units), ``width`` in units."""
    return (f"(({R} * radians({fx.degrees(width)})) * ({merc_y(fx.degrees(f'({uy}) + 20'))} - {merc_y(fx.degrees(uy))}) "
            f"/ 1000000.0)")


def area_deg2(cells: str, per_cell: int = 4) -> str:
    """Square degrees of cells (4 / 1,000,000 each)."""
    return f"CAST({per_cell} * {cells} AS DOUBLE) / 1000000"


INC = ("SELECT c_nationkey AS zone_id, CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderkey AS id, "
       "o_orderstatus AS ty FROM orders JOIN customer ON o_custkey = c_custkey")
POP = "SELECT c_nationkey AS zone_id, CAST(count(*) AS INTEGER) AS pop FROM customer GROUP BY 1"
UF = ("CASE c_custkey % 5 WHEN 0 THEN '35' WHEN 1 THEN '035' WHEN 2 THEN ' 35' "
      "WHEN 3 THEN '35.0' ELSE '33' END")
DEMO = (f"SELECT '35' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CD_SETOR, "
        f"'35' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS CD_MUN, {UF} AS CD_UF, "
        f"CASE WHEN c_acctbal < 0 THEN 'X' ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS v0001 "
        f"FROM customer")
IN_STATE = "CAST(try_cast(CD_UF AS DOUBLE) AS INTEGER) = 35"
SOURCES = ("SELECT l_orderkey AS id, l_linestatus AS ty, l_linenumber AS ln, "
           "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS priority "
           "FROM lineitem WHERE l_returnflag IN ('R', 'A', 'N')")
GW = fx.GRID_WIDTH
BC = fx.BLOCK_CELLS
LON, LAT = fx.lon_units("c_custkey", "//"), fx.lat_units("c_custkey", "//")
CELLS = f"SELECT c_custkey AS zone_id, c_nationkey AS grp, {LON} AS ux, {LAT} AS uy FROM customer"
DIRTY = fx.DIRTY_COORD_SQL.replace("STRING", "VARCHAR")
DIRTY_LAT = DIRTY.replace("event_id", "(event_id + 3)")


def counts(type_col: str, values, names) -> str:
    return ", ".join(f"nullif(count(*) FILTER (WHERE {type_col} = {q(v)}), 0) AS \"{n}\""
                     for v, n in zip(values, names))


def rates_sql(zone_expr_from: str, zone: str, pop_cte: str, base: int, key: str) -> str:
    names = [f"{v.lower()}_cnt" for v in C.TYPE_VALUES]
    g = C.FLAGSHIP_GUARD_YEAR

    def idx(c, guard):
        pre = f"WHEN a.yr < {g} THEN NULL " if guard else ""
        return (f"CASE {pre}WHEN p.pop IS NULL OR a.{c} IS NULL OR p.pop = 0 THEN CAST(0 AS DOUBLE) "
                f"ELSE CAST(a.{c} AS DOUBLE) / p.pop * {base} END")
    return (f"WITH inc AS ({zone_expr_from}), pop AS ({pop_cte}), "
            f"agg AS (SELECT {zone}, yr, count(id) AS total, {counts('ty', C.TYPE_VALUES, names)} "
            f"FROM inc GROUP BY 1, 2) "
            f"SELECT a.{zone}, a.yr, a.total, a.f_cnt, a.o_cnt, a.p_cnt, "
            f"{idx('total', True)} AS total_index, {idx('f_cnt', False)} AS f_index, "
            f"{idx('o_cnt', False)} AS o_index, {key} AS zone_year_key "
            f"FROM agg a JOIN pop p ON a.{zone} = p.{zone}")


REGION_INC = (f"SELECT n_regionkey AS region_id, i.yr, i.id, i.ty FROM ({INC}) i "
              f"JOIN nation ON i.zone_id = n_nationkey")
REGION_POP = (f"SELECT n_regionkey AS region_id, CAST(sum(pop) AS INTEGER) AS pop FROM ({POP}) p "
              f"JOIN nation ON p.zone_id = n_nationkey GROUP BY 1")


# ---------------------------------------------------------- incident world --
def raw_sql(source: str) -> str:
    flag = {"cellphones": "R", "vehicles": "A", "others": "N"}[source]
    month, year = ("MES_ESTATISTICA", "ANO_ESTATISTICA") if source == "others" else ("MES", "ANO")
    cols = [
        f"CASE WHEN l_partkey % 20 = 0 THEN {q(fx.REDACTED)} WHEN l_partkey % 20 = 1 THEN NULL "
        f"ELSE concat({lst(fx.STREETS)}[l_orderkey % 5 + 1], ', nº ', CAST(l_orderkey % 97 AS VARCHAR)) END "
        f"AS LOGRADOURO",
        "CAST(l_orderkey % 1000 AS VARCHAR) AS NUMERO_LOGRADOURO",
        f"{lst(fx.DISTRICTS)}[l_orderkey % 4 + 1] AS BAIRRO",
        f"CASE WHEN l_suppkey % 50 = 0 THEN '0' WHEN l_suppkey % 50 = 1 THEN NULL "
        f"ELSE {fx.coord_text(fx.incident_units('//')[1], '//', 'VARCHAR')} END AS LATITUDE",
        f"{fx.coord_text(fx.incident_units('//')[0], '//', 'VARCHAR')} AS LONGITUDE",
        "CASE WHEN l_orderkey % 4 = 0 THEN "
        "lpad(CAST(1 + l_orderkey % 28 AS VARCHAR), 2, '0') || '/' || "
        "lpad(CAST(1 + l_orderkey % 12 AS VARCHAR), 2, '0') || '/' || CAST(2015 + l_orderkey % 10 AS VARCHAR) "
        "ELSE CAST(2015 + l_orderkey % 10 AS VARCHAR) || '-' || lpad(CAST(1 + l_orderkey % 12 AS VARCHAR), 2, '0') "
        "|| '-' || lpad(CAST(1 + l_orderkey % 28 AS VARCHAR), 2, '0') || ' 10:30:00' END AS DATA_OCORRENCIA_BO",
        f"CAST(1 + l_orderkey % 12 AS VARCHAR) AS {month}",
        f"CAST(2015 + l_orderkey % 10 AS VARCHAR) AS {year}",
    ]
    if source == "others":
        cols.append(f"{lst(fx.OTHER_TYPES)}[l_linenumber] AS NATUREZA_APURADA")
    return f"SELECT {', '.join(cols)} FROM lineitem WHERE l_returnflag = '{flag}'"


def silver_source_sql(source: str) -> str:
    if source == "others":
        month, year = "MES_ESTATISTICA", "ANO_ESTATISTICA"
        typ = (f"CASE WHEN upper(NATUREZA_APURADA) IN ({', '.join(q(v) for v in VEHICLE_LABELS)}) "
               f"THEN {q(VEHICLE_MERGED)} ELSE NATUREZA_APURADA END")
    else:
        month, year = "MES", "ANO"
        typ = q(pl.CELLPHONE_TYPE if source == "cellphones" else pl.VEHICLE_TYPE)
    step1 = (f"SELECT LOGRADOURO, NUMERO_LOGRADOURO, BAIRRO, {repair('LATITUDE')} AS lat, "
             f"{repair('LONGITUDE')} AS lon, DATA_OCORRENCIA_BO, {month} AS mo, {year} AS yr, {typ} AS ty "
             f"FROM ({raw_sql(source)})")
    step2 = f"SELECT *, {coord_value('lon')} AS x, {coord_value('lat')} AS y FROM ({step1})"
    step3 = (f"SELECT {norm('LOGRADOURO')} AS ADDRESS, NUMERO_LOGRADOURO AS ADDRESS_NUMBER, "
             f"{norm('BAIRRO')} AS NEIGHBORHOOD, lat AS LATITUDE, lon AS LONGITUDE, "
             f"CAST(coalesce(day(try_cast(DATA_OCORRENCIA_BO AS TIMESTAMP)), 1) AS INTEGER) AS DAY_INFO, "
             f"try_cast(mo AS INTEGER) AS MONTH_INFO, try_cast(yr AS INTEGER) AS YEAR_INFO, "
             f"{norm('ty')} AS CRIMINAL_TYPE, x, y FROM ({step2}) "
             f"WHERE x IS NOT NULL AND x <> 0 AND y IS NOT NULL AND y <> 0 AND abs(x) < 180 AND abs(y) < 89 "
             f"AND LOGRADOURO NOT LIKE '{pl.REDACTION_PATTERN}'")
    key = ("sha256(concat_ws('_', ADDRESS, ADDRESS_NUMBER, NEIGHBORHOOD, LATITUDE, LONGITUDE, "
           "CAST(DAY_INFO AS VARCHAR), CAST(MONTH_INFO AS VARCHAR), CAST(YEAR_INFO AS VARCHAR)))")
    return (f"SELECT DISTINCT {key} AS ID, CRIMINAL_TYPE, ADDRESS, ADDRESS_NUMBER, NEIGHBORHOOD, "
            f"DAY_INFO, MONTH_INFO, YEAR_INFO, x, y FROM ({step3})")


SECTORS = (f"SELECT '35' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS ID_SC, "
           f"'35' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS ID_MUN, n_name AS MUN, 'SP' AS STATE, "
           f"{cell_area_km2(LAT, '20')} AS AREA_KM2, {fx.degrees(LON)} AS cx0, {fx.degrees(LON + ' + 20')} AS cx1, "
           f"{fx.degrees(LAT)} AS cy0, {fx.degrees(LAT + ' + 20')} AS cy1, "
           f"CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal) AS INTEGER) END AS POP_TOTAL, "
           f"c_custkey, c_nationkey "
           f"FROM customer JOIN nation ON c_nationkey = n_nationkey "
           f"WHERE CAST(try_cast({UF} AS DOUBLE) AS INTEGER) = 35")


def class_case(col: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in INCIDENT_CLASSES.items())
    return f"CASE {col} {whens} ELSE 'OUTROS' END"


def silver_incidents_sql() -> str:
    u = " UNION ALL ".join(f"SELECT *, {p} AS priority FROM ({silver_source_sql(s)})"
                           for s, p in (("cellphones", 1), ("vehicles", 2), ("others", 3)))
    best = f"SELECT * FROM ({u}) QUALIFY rank() OVER (PARTITION BY ID ORDER BY priority) = 1"
    keyed = ("SELECT sha256(concat_ws('_', ID, CRIMINAL_TYPE, ADDRESS, ADDRESS_NUMBER, NEIGHBORHOOD, "
             "CAST(DAY_INFO AS VARCHAR), CAST(MONTH_INFO AS VARCHAR), CAST(YEAR_INFO AS VARCHAR))) AS ID_CRIME, "
             "CRIMINAL_TYPE, ADDRESS, ADDRESS_NUMBER, NEIGHBORHOOD, DAY_INFO, MONTH_INFO, YEAR_INFO, x, y, "
             f"upper(replace(CRIMINAL_TYPE, ' ', '_')) AS CRIMINAL_TYPE_TREATED FROM ({best})")
    cls = f"SELECT *, {class_case('CRIMINAL_TYPE_TREATED')} AS CRIMINAL_CLASS FROM ({keyed})"
    return (f"SELECT i.ID_CRIME, i.CRIMINAL_CLASS, i.CRIMINAL_TYPE, i.ADDRESS, i.ADDRESS_NUMBER, "
            f"i.NEIGHBORHOOD, i.DAY_INFO, i.MONTH_INFO, i.YEAR_INFO, s.ID_SC, s.ID_MUN, s.MUN, s.STATE, "
            f"i.x, i.y, upper(replace(i.CRIMINAL_CLASS, ' ', '_')) AS CRIMINAL_CLASS_TREATED, "
            f"i.CRIMINAL_TYPE_TREATED FROM ({cls}) i JOIN ({SECTORS}) s "
            f"ON i.x BETWEEN s.cx0 AND s.cx1 AND i.y BETWEEN s.cy0 AND s.cy1")


def gold_incidents_sql() -> str:
    return ("SELECT DISTINCT ID_CRIME, CRIMINAL_CLASS, CRIMINAL_TYPE, ADDRESS, ADDRESS_NUMBER, "
            "NEIGHBORHOOD, DAY_INFO, MONTH_INFO, YEAR_INFO, ID_MUN, MUN, STATE, x, y "
            f"FROM ({silver_incidents_sql()})")


def zone_rates_sql(zone: str, zones: str, base: int, key: str) -> str:
    types = list(INCIDENT_CLASSES)
    listed = ", ".join(f"'{t}'" for t in types)
    cnt = (f"SELECT {zone}, YEAR_INFO, count(ID_CRIME) AS TOTAL_CRIMES, "
           f"{counts('CRIMINAL_TYPE_TREATED', types, types)}, "
           f"count(*) FILTER (CRIMINAL_TYPE_TREATED IS NULL OR CRIMINAL_TYPE_TREATED NOT IN ({listed})) AS OTHER_TYPES "
           f"FROM ({silver_incidents_sql()}) GROUP BY 1, 2")

    def idx(c, guard):
        pre = f"WHEN c.YEAR_INFO < {pl.GUARD_YEAR} THEN NULL " if guard else ""
        return (f"CASE {pre}WHEN z.POP_TOTAL IS NULL OR c.{c} IS NULL OR z.POP_TOTAL = 0 "
                f"THEN CAST(0 AS DOUBLE) ELSE CAST(c.{c} AS DOUBLE) / z.POP_TOTAL * {base} END")
    type_cols = ", ".join(f'c."{t}"' for t in types)
    return (f"SELECT z.*, c.YEAR_INFO, c.TOTAL_CRIMES, {type_cols}, c.OTHER_TYPES, "
            f"{idx('TOTAL_CRIMES', True)} AS TOTAL_CRIME_INDEX, "
            f"{idx('FURTO_ROUBO_DE_CELULAR', False)} AS CELLPHONE_CRIME_INDEX, "
            f"{idx('FURTO_ROUBO_DE_VEICULO', False)} AS VEHICLE_CRIME_INDEX, {key} "
            f"FROM ({zones}) z JOIN ({cnt}) c ON z.{zone} = c.{zone}")


SECTOR_ZONES = "SELECT ID_SC, ID_MUN, MUN, STATE, round(AREA_KM2, 6) AS AREA_KM2, POP_TOTAL FROM (" + SECTORS + ")"
MUN_ZONES = (f"SELECT ID_MUN, any_value(MUN) AS MUN, 'SP' AS STATE, round(sum(AREA_KM2), 5) AS AREA_KM2, "
             f"CAST(sum(POP_TOTAL) AS INTEGER) AS POP_TOTAL FROM ({SECTORS}) GROUP BY ID_MUN")


def gold_sector_sql() -> str:
    return zone_rates_sql("ID_SC", SECTOR_ZONES, 1000,
                          "sha256(concat_ws('|', c.ID_SC, CAST(c.YEAR_INFO AS VARCHAR))) AS ID_SC_CRIME")


def gold_mun_sql() -> str:
    return zone_rates_sql("ID_MUN", MUN_ZONES, 100000,
                          "sha1(concat(c.ID_MUN, CAST(c.YEAR_INFO AS VARCHAR))) AS ID_MUN_CRIME")


MAP_COLS = ("TOTAL_CRIMES, FURTO_ROUBO_DE_CELULAR, FURTO_ROUBO_DE_VEICULO, POP_TOTAL, "
            "TOTAL_CRIME_INDEX, CELLPHONE_CRIME_INDEX, VEHICLE_CRIME_INDEX")


def mun_edges_sql() -> str:
    """Closed form of a municipality's boundary: a cell side (two half sides at
    bottom and top) survives unless the neighbouring sector lies in the same
    municipality."""
    s = f"SELECT c_custkey k, c_nationkey grp, c_custkey % {GW} AS x FROM customer " \
        f"WHERE CAST(try_cast({UF} AS DOUBLE) AS INTEGER) = 35"
    sides = (f"SELECT grp, k - 1 AS nb, x > 0 AS has, 1 AS n FROM s UNION ALL "
             f"SELECT grp, k + 1, x < {GW - 1}, 1 FROM s UNION ALL "
             f"SELECT grp, k - {GW}, k % {BC} >= {GW}, 2 FROM s UNION ALL "
             f"SELECT grp, k + {GW}, k % {BC} < {BC - GW}, 2 FROM s")
    return (f"WITH s AS ({s}), e AS ({sides}) SELECT e.grp, CAST(sum(e.n) AS BIGINT) AS n_edges FROM e "
            f"LEFT JOIN s n ON e.has AND n.k = e.nb AND n.grp = e.grp WHERE n.k IS NULL GROUP BY e.grp")


def t_junction_edges_sql() -> str:
    """Boundary edges per municipality when sectors in even grid rows are
    whole cells and odd rows two halves, after splitting at T-junctions: a side shared with a
    same-municipality neighbour cancels; a surviving top or bottom side is two
    edges when its own sector is split, one when whole; left and right sides
    are one edge."""
    s = f"SELECT c_custkey k, c_nationkey grp, c_custkey % {GW} AS x FROM customer " \
        f"WHERE CAST(try_cast({UF} AS DOUBLE) AS INTEGER) = 35"
    half = f"CASE WHEN (k // {GW}) % 2 = 0 THEN 1 ELSE 2 END"
    sides = (f"SELECT grp, k - 1 AS nb, x > 0 AS has, 1 AS n FROM s UNION ALL "
             f"SELECT grp, k + 1, x < {GW - 1}, 1 FROM s UNION ALL "
             f"SELECT grp, k - {GW}, k % {BC} >= {GW}, {half} FROM s UNION ALL "
             f"SELECT grp, k + {GW}, k % {BC} < {BC - GW}, {half} FROM s")
    return (f"WITH s AS ({s}), e AS ({sides}) SELECT e.grp, CAST(sum(e.n) AS BIGINT) AS n_edges FROM e "
            f"LEFT JOIN s n ON e.has AND n.k = e.nb AND n.grp = e.grp WHERE n.k IS NULL GROUP BY e.grp")


def cell_edges_sql() -> str:
    def side(x1, y1, x2, y2, nb, has):
        ends = ", ".join(f"{fx.degrees(f'u{v[0]} + {v[1:]}')} AS {n}" for v, n in
                         ((x1, "x1"), (y1, "y1"), (x2, "x2"), (y2, "y2")))
        return f"SELECT grp, {ends}, {nb} AS nb, {has} AS has FROM c"
    sides = " UNION ALL ".join([
        side("x0", "y0", "x20", "y0", f"k - {GW}", f"k % {BC} >= {GW}"),
        side("x20", "y0", "x20", "y20", "k + 1", f"k % {GW} < {GW - 1}"),
        side("x20", "y20", "x0", "y20", f"k + {GW}", f"k % {BC} < {BC - GW}"),
        side("x0", "y20", "x0", "y0", "k - 1", f"k % {GW} > 0")])
    return (f"WITH c AS (SELECT zone_id AS k, grp, ux, uy FROM ({CELLS})), e AS ({sides}) "
            f"SELECT e.grp, e.x1, e.y1, e.x2, e.y2 FROM e "
            f"LEFT JOIN c n ON e.has AND n.k = e.nb AND n.grp = e.grp WHERE n.k IS NULL")


def spatial_sql() -> str:
    """Points and zones in whole units, so that borders are exact."""
    key = "event_id * 3 // 20"
    lon, lat = fx.lon_units(key, "//"), fx.lat_units(key, "//")
    pts = (f"SELECT 'interior' AS pointset, event_id, {lon} + 1 + event_id * 7919 % 19 AS px, "
           f"{lat} + 1 + event_id * 104729 % 19 AS py FROM events "
           f"UNION ALL SELECT 'border', event_id, {lon}, {lat} + event_id % 21 FROM events")
    cell = "px BETWEEN ux AND ux + 20 AND py BETWEEN uy AND uy + 20"
    ell = ("((px BETWEEN ux AND ux + 20 AND py BETWEEN uy AND uy + 10) OR "
           "(px BETWEEN ux AND ux + 10 AND py BETWEEN uy AND uy + 20))")
    hole = f"{cell} AND NOT (px > ux + 5 AND px < ux + 15 AND py > uy + 5 AND py < uy + 15)"
    tri = f"{cell} AND px - ux + py - uy <= 20"
    block = (f"zone_id % {BC} = 0 AND px BETWEEN ux AND ux + 1000 AND py BETWEEN uy AND uy + 600 "
             f"AND 3 * abs(px - ux - 500) + 5 * abs(py - uy - 300) <= 1500")
    return " UNION ALL ".join(
        f"SELECT '{name}' AS shape, pointset, event_id, zone_id FROM ({pts}) p JOIN ({CELLS}) c ON {cond}"
        for name, cond in (("cell", cell), ("ell", ell), ("hole", hole), ("tri", tri), ("block", block)))


def build() -> dict[str, str]:
    names3 = [f"{v.lower()}_cnt" for v in C.TYPE_VALUES]
    in_list = ", ".join(str(v) for v in C.IN_LIST_ZONES)
    s = {}
    s["scan_parquet"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
    yr = "CAST(year(o_orderdate) AS INTEGER)"
    base = f"SELECT o_orderkey, o_custkey, o_orderstatus, {yr} AS YEAR_INFO"
    s["scan_partition_pruned"] = f"{base} FROM orders WHERE year(o_orderdate) = 1998"
    s["sink_partitioned_roundtrip"] = f"{base} FROM orders"
    s["sink_two_level_partition"] = f"{base}, CAST(month(o_orderdate) AS INTEGER) AS MONTH_INFO FROM orders"
    s["scan_multipart_union"] = (
        f"SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN {yr} % 2 = 0 THEN o_totalprice END "
        f"AS o_totalprice, CASE WHEN {yr} % 2 = 1 THEN o_orderpriority END AS o_orderpriority, {yr} AS yr "
        f"FROM orders")
    s["scan_delimited"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
        "c_mktsegment, ['São Paulo', 'Campinas – SP', 'Ribeirão Preto'][c_custkey % 3 + 1] AS city FROM customer")
    s["project_rename"] = (f"SELECT o_orderkey AS ID, o_custkey AS ID_CUSTOMER, o_orderstatus AS STATUS, "
                           f"o_totalprice AS PRICE, {yr} AS YEAR_INFO FROM orders")
    s["distinct_rows"] = "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem"
    s["drop_suffix_columns"] = "SELECT p_partkey, p_name, p_type FROM part"
    s["drop_void_columns"] = "SELECT p_partkey, p_brand, p_size FROM part"
    s["filter_equals_coerced"] = f"SELECT CD_SETOR, CD_UF FROM ({DEMO}) WHERE {IN_STATE}"
    s["filter_not_like"] = (f"SELECT LOGRADOURO, NUMERO_LOGRADOURO, NATUREZA_APURADA FROM ({raw_sql('others')}) "
                            f"WHERE LOGRADOURO NOT LIKE '{pl.REDACTION_PATTERN}'")
    s["filter_in_list"] = f"SELECT * FROM ({INC}) WHERE zone_id IN ({in_list}) AND yr > 1997"
    s["filter_valid_coords"] = (f"SELECT event_id, v FROM (SELECT event_id, {coord_value(repair('raw'))} AS v "
                                f"FROM (SELECT event_id, {DIRTY} AS raw FROM events)) WHERE v IS NOT NULL AND v <> 0")
    s["repair_coordinate"] = (f"SELECT event_id, raw, {repair('raw')} AS repaired "
                              f"FROM (SELECT event_id, {DIRTY} AS raw FROM events)")
    s["make_points"] = (f"SELECT event_id, {coord_value(repair('raw'))} AS x, {coord_value(repair('raw_lat'))} AS y "
                        f"FROM (SELECT event_id, {DIRTY} AS raw, {DIRTY_LAT} AS raw_lat FROM events)")
    s["normalize_text"] = f"SELECT doc_id, {norm('text')} AS t FROM documents"
    s["row_fingerprint"] = (
        "SELECT c_custkey, sha256(concat_ws('|', coalesce(CAST(c_custkey AS VARCHAR), 'x'), coalesce(c_name, 'x'), "
        "coalesce(CAST(c_nationkey AS VARCHAR), 'x'), coalesce(nullif(c_mktsegment, 'BUILDING'), 'x'))) AS fp "
        "FROM customer")
    s["entity_key"] = (
        "SELECT l_orderkey, l_linenumber, sha256(concat_ws('_', CAST(l_orderkey AS VARCHAR), "
        "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
        "nullif(l_returnflag, 'N'), l_linestatus)) AS key FROM lineitem")
    s["zone_year_keys"] = (
        f"SELECT zone_id, yr, sha256(concat_ws('|', CAST(zone_id AS VARCHAR), CAST(yr AS VARCHAR))) AS key_sha256, "
        f"sha1(concat(CAST(zone_id AS VARCHAR), CAST(yr AS VARCHAR))) AS key_sha1 "
        f"FROM (SELECT DISTINCT zone_id, yr FROM ({INC}))")
    cls = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.FX_CLASSES.items())
    s["classify_incident"] = (
        f"SELECT p_partkey, p_type, type_treated, class, upper(replace(class, ' ', '_')) AS class_treated FROM "
        f"(SELECT p_partkey, p_type, type_treated, CASE type_treated {cls} ELSE 'OTHER' END AS class FROM "
        f"(SELECT p_partkey, p_type, upper(replace(p_type, ' ', '_')) AS type_treated FROM part))")
    members = ", ".join(q(m) for m in C.FX_MERGE[0])
    s["merge_labels"] = (f"SELECT p_partkey, CASE WHEN upper(p_type) IN ({members}) THEN {q(C.FX_MERGE[1])} "
                         f"ELSE p_type END AS label FROM part")
    raw_date = ("CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') "
                "WHEN 1 THEN strftime(ts, '%d/%m/%Y') ELSE strftime(ts, '%Y-%m-%d') END")
    s["day_with_default"] = (f"SELECT event_id, raw, CAST(coalesce(day(try_cast(raw AS TIMESTAMP)), 1) AS INTEGER) "
                             f"AS day_info FROM (SELECT event_id, {raw_date} AS raw FROM events)")
    s["assemble_date"] = (
        "SELECT event_id, strftime(try_strptime(concat_ws('/', 1 + event_id % 31, 1 + event_id % 12, "
        "2020 + event_id % 5), '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S') AS date_text FROM events")
    s["union_sources_priority"] = SOURCES
    s["dedup_priority_rank"] = f"SELECT * FROM ({SOURCES}) QUALIFY rank() OVER (PARTITION BY id ORDER BY priority) = 1"
    s["agg_total_and_pivot"] = (f"SELECT zone_id, yr, count(id) AS total, {counts('ty', C.TYPE_VALUES, names3)} "
                                f"FROM ({INC}) GROUP BY 1, 2")
    s["agg_pivot_counts"] = (f"SELECT zone_id, yr, {counts('ty', C.TYPE_VALUES, C.TYPE_VALUES)} "
                             f"FROM ({INC}) GROUP BY 1, 2")
    s["agg_population_rollup"] = (f"SELECT CD_MUN AS ID_MUN, CAST(sum(try_cast(v0001 AS DOUBLE)) AS INTEGER) AS "
                                  f"POP_TOTAL, 2022 AS YEAR_INFO FROM ({DEMO}) WHERE {IN_STATE} GROUP BY CD_MUN")
    s["silver_sector_population"] = (
        f"SELECT DISTINCT CD_SETOR AS ID_SC, CAST(try_cast(v0001 AS DOUBLE) AS INTEGER) AS POP_TOTAL, "
        f"2022 AS YEAR_INFO FROM ({DEMO}) WHERE {IN_STATE}")
    s["rate_index_sector"] = rates_sql(
        INC, "zone_id", POP, 1000,
        "sha256(concat_ws('|', CAST(a.zone_id AS VARCHAR), CAST(a.yr AS VARCHAR)))")
    s["rate_index_municipality"] = rates_sql(
        REGION_INC, "region_id", REGION_POP, 100000,
        "sha1(concat(CAST(a.region_id AS VARCHAR), CAST(a.yr AS VARCHAR)))")
    li = "SELECT l_orderkey, l_partkey, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem"
    s["quality_not_null"] = (
        f"WITH a AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_orderkey IS NULL) AS n0, "
        f"count(*) FILTER (WHERE l_partkey IS NULL) AS n1, count(*) FILTER (WHERE l_returnflag IS NULL) AS n2 "
        f"FROM ({li})) "
        f"SELECT 'lineitem' AS table_name, 'row_count' AS rule, '' AS columns, n AS violations FROM a "
        f"UNION ALL SELECT 'lineitem', 'not_null', 'l_orderkey', n0 FROM a "
        f"UNION ALL SELECT 'lineitem', 'not_null', 'l_partkey', n1 FROM a "
        f"UNION ALL SELECT 'lineitem', 'not_null', 'l_returnflag', n2 FROM a")
    s["quality_unique"] = (
        "SELECT 'lineitem' AS table_name, 'unique' AS rule, 'l_orderkey' AS columns, "
        "(SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)) AS violations "
        "UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber', (SELECT count(*) FROM "
        "(SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))")
    s["quality_report"] = (
        f"WITH src AS ({SOURCES}), a AS (SELECT count(*) AS n, count(*) FILTER (WHERE id IS NULL) AS n0, "
        f"count(*) FILTER (WHERE ty IS NULL) AS n1, count(*) FILTER (WHERE priority IS NULL) AS n2 FROM src) "
        f"SELECT 'sources' AS table_name, 'row_count' AS rule, '' AS columns, n AS violations FROM a "
        f"UNION ALL SELECT 'sources', 'not_null', 'id', n0 FROM a "
        f"UNION ALL SELECT 'sources', 'not_null', 'ty', n1 FROM a "
        f"UNION ALL SELECT 'sources', 'not_null', 'priority', n2 FROM a "
        f"UNION ALL SELECT 'sources', 'unique', 'id', (SELECT count(*) FROM (SELECT id FROM src GROUP BY 1 "
        f"HAVING count(*) > 1)) "
        f"UNION ALL SELECT 'sources', 'unique', 'id,ln,priority', (SELECT count(*) FROM (SELECT id, ln, priority "
        f"FROM src GROUP BY 1, 2, 3 HAVING count(*) > 1))")
    s["log_stage_metrics"] = (
        "WITH l AS (SELECT event_id, CASE WHEN event_type = 'signup' THEN event_id END AS sec, event_type, "
        "CAST(round(value * 100) AS BIGINT) AS cents FROM events), "
        "f AS (SELECT *, max(sec) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
        "AS section FROM l), "
        "m AS (SELECT section, count(*) AS n_lines, "
        "CAST(coalesce(sum(cents) FILTER (WHERE event_type = 'view'), 0) AS BIGINT) AS read_cents, "
        "coalesce(max_by(cents, event_id) FILTER (WHERE event_type = 'click'), 0) AS treat_cents, "
        "coalesce(max_by(cents, event_id) FILTER (WHERE event_type = 'purchase'), 0) AS write_cents, "
        "coalesce(max_by(cents, event_id) FILTER (WHERE event_type = 'error'), 0) AS test_cents "
        "FROM f WHERE section IS NOT NULL GROUP BY section) "
        "SELECT *, read_cents + treat_cents + write_cents AS total_cents FROM m")
    s["log_latest_file"] = "SELECT 'run' || CAST(1 + max(event_id % 2) AS VARCHAR) AS run FROM events"
    s["log_scan"] = (
        "WITH l AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS o, epoch_us(date_trunc('hour', ts)) AS t, "
        "event_type, user_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE event_id % 2 = 1), "
        "f AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN o END) OVER "
        "(ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sec FROM l), "
        "t AS (SELECT o AS sec, t AS start, 'table_' || CAST(user_id AS VARCHAR) AS table_name FROM l "
        "WHERE event_type = 'signup'), "
        "m AS (SELECT f.sec, t.start, t.table_name, "
        "coalesce(sum(cents) FILTER (WHERE event_type = 'view'), 0) AS rc, "
        "coalesce(max_by(cents, o) FILTER (WHERE event_type = 'click'), 0) AS tc, "
        "coalesce(max_by(cents, o) FILTER (WHERE event_type = 'purchase'), 0) AS wc, "
        "coalesce(max_by(user_id, o) FILTER (WHERE event_type NOT IN ('signup', 'view', 'click', 'purchase')), 0) "
        "AS row_count FROM f JOIN t ON f.sec = t.sec GROUP BY f.sec, t.start, t.table_name) "
        "SELECT table_name, 'SILVER' AS level, round(rc / 100.0, 2) AS read_time, round(tc / 100.0, 2) AS treat_time, "
        "round(wc / 100.0, 2) AS write_time, CAST(0 AS DOUBLE) AS test_time, CAST(row_count AS BIGINT) AS row_count, "
        "round((rc + tc + wc) / 100.0, 2) AS total_time, start AS section_start FROM m")
    diagonal = "c_custkey % 3 = 0"
    parts = (f"SELECT '35' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CD_SETOR, p.part, {LAT} AS uy, "
             f"{LON} + CASE WHEN {diagonal} THEN 0 ELSE p.dx END AS ua, "
             f"{LON} + CASE WHEN {diagonal} THEN 20 ELSE p.dx + 10 END AS ub "
             f"FROM customer, (SELECT 1 AS part, 0 AS dx UNION ALL SELECT 2, 10) p")
    x0, x1, y0, y1 = (fx.degrees(u) for u in ("ua", "ub", "uy", "uy + 20"))
    s["scan_zones"] = (f"SELECT CD_SETOR, part, 1 AS n_rings, 5 AS n_points, {x0} AS x0, {y0} AS y0, "
                       f"{x1} AS x1, {y1} AS y1 FROM ({parts})")
    s["zone_area_km2"] = (f"SELECT CD_SETOR, part, round({cell_area_km2('uy', '10')}, 6) AS area_km2 "
                          f"FROM ({parts})")
    s["reproject_mercator"] = (
        f"SELECT CD_SETOR, part, round({R} * radians({x0}), 3) + 0.0 AS x0m, round({merc_y(y0)}, 3) + 0.0 AS y0m, "
        f"round({R} * radians({x1}), 3) + 0.0 AS x1m, round({merc_y(y1)}, 3) + 0.0 AS y1m "
        f"FROM ({parts})")
    s["spatial_join_points_zones"] = spatial_sql()
    s["srid_checked_join"] = (f"SELECT zone_id, count(*) AS n_points, 4326 AS srid FROM ({spatial_sql()}) "
                              f"WHERE shape = 'cell' GROUP BY zone_id")
    s["dissolve_boundary_edges"] = cell_edges_sql()
    s["dissolve_area"] = (f"SELECT c.grp, {area_deg2("count(*)")} AS area, "
                          f"(SELECT count(*) FROM ({cell_edges_sql()}) e WHERE e.grp = c.grp) AS n_edges "
                          f"FROM ({CELLS}) c GROUP BY c.grp")
    s["dissolve_rings"] = (f"SELECT c.grp, (SELECT count(*) FROM ({cell_edges_sql()}) e WHERE e.grp = c.grp) "
                           f"AS n_vertices, {area_deg2("count(*)")} AS area FROM ({CELLS}) c GROUP BY c.grp")
    s["dissolve_polygons"] = s["dissolve_rings"]
    s["dissolve_t_junctions"] = (
        f"SELECT '35' || lpad(CAST(e.grp AS VARCHAR), 5, '0') AS CD_MUN, e.n_edges, "
        f"{area_deg2("c.cnt")} AS area FROM ({t_junction_edges_sql()}) e "
        f"JOIN (SELECT c_nationkey, count(*) AS cnt FROM customer WHERE {IN_STATE.replace('CD_UF', UF)} "
        f"GROUP BY c_nationkey) c ON c.c_nationkey = e.grp")
    part_cols = ("'35' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CD_SETOR, "
                 "'35' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS CD_MUN")
    s["geojson_features"] = " UNION ALL ".join(
        f"SELECT {part_cols}, {k} AS part, 'Polygon' AS geometry_type, 1 AS n_rings, 5 AS n_points, "
        f"{area_deg2("1", 2)} AS area FROM customer JOIN nation ON c_nationkey = n_nationkey" for k in (1, 2))
    s["geojson_municipalities"] = (
        f"SELECT '35' || lpad(CAST(e.grp AS VARCHAR), 5, '0') AS CD_MUN, n.n_name AS NM_MUN, "
        f"'MultiPolygon' AS geometry_type, e.n_edges AS n_points, {area_deg2("c.cnt")} AS area "
        f"FROM ({mun_edges_sql()}) e JOIN nation n ON n.n_nationkey = e.grp "
        f"JOIN (SELECT c_nationkey, count(*) AS cnt FROM customer WHERE {IN_STATE.replace('CD_UF', UF)} "
        f"GROUP BY c_nationkey) c ON c.c_nationkey = e.grp")
    raw_c = raw_sql("cellphones")
    s["bronze_table"] = (
        "SELECT DISTINCT *, sha256(concat_ws('|', coalesce(LOGRADOURO, 'x'), coalesce(NUMERO_LOGRADOURO, 'x'), "
        "coalesce(BAIRRO, 'x'), coalesce(LATITUDE, 'x'), coalesce(LONGITUDE, 'x'), "
        "coalesce(DATA_OCORRENCIA_BO, 'x'), coalesce(MES, 'x'), coalesce(ANO, 'x'))) AS ID, "
        f"try_cast(ANO AS INTEGER) AS YEAR_INFO FROM ({raw_c})")
    s["bronze_incremental"] = s["bronze_table"]
    s["silver_sector_geometry"] = ("SELECT ID_SC, ID_MUN, MUN, STATE, round(AREA_KM2, 6) AS AREA_KM2, "
                                   f"CAST(6 AS BIGINT) AS n_edges FROM ({SECTORS})")
    s["silver_municipality_geometry"] = (
        f"SELECT z.ID_MUN, z.MUN, z.STATE, z.AREA_KM2, e.n_edges FROM ({MUN_ZONES}) z "
        f"JOIN ({mun_edges_sql()}) e ON z.ID_MUN = '35' || lpad(CAST(e.grp AS VARCHAR), 5, '0')")
    s["join_zone_demographics"] = ("SELECT ID_SC, ID_MUN, MUN, STATE, round(AREA_KM2, 6) AS AREA_KM2, POP_TOTAL, "
                                   f"2022 AS YEAR_INFO FROM ({SECTORS})")
    s["silver_incident_source"] = silver_source_sql("cellphones")
    s["silver_incident_other"] = silver_source_sql("others")
    s["silver_incidents"] = silver_incidents_sql()
    s["gold_incidents"] = gold_incidents_sql()
    s["gold_sector_rates"] = gold_sector_sql()
    s["gold_municipality_rates"] = gold_mun_sql()
    # the union painted on a raster of the step; its sides without a painted neighbour are the boundary
    x0, y0, x1, y1 = fx.overlap_box("//")
    step = fx.OVERLAP_STEP
    s["union_overlapping"] = (
        f"WITH box AS (SELECT c_custkey // {fx.OVERLAP_GROUP} AS grp, {x0} AS x0, {y0} AS y0, {x1} AS x1, {y1} AS y1 FROM customer), "
        f"col AS (SELECT grp, y0, y1, unnest(generate_series(x0, x1 - {step}, {step})) AS x FROM box), "
        f"paint AS (SELECT DISTINCT grp, x, y FROM (SELECT grp, x, unnest(generate_series(y0, y1 - {step}, {step})) AS y FROM col)), "
        "side AS (SELECT p.grp, (CASE WHEN l.x IS NULL THEN 1 ELSE 0 END) + (CASE WHEN r.x IS NULL THEN 1 ELSE 0 END) "
        "+ (CASE WHEN d.x IS NULL THEN 1 ELSE 0 END) + (CASE WHEN u.x IS NULL THEN 1 ELSE 0 END) AS n FROM paint p "
        f"LEFT JOIN paint l ON l.grp = p.grp AND l.x = p.x - {step} AND l.y = p.y "
        f"LEFT JOIN paint r ON r.grp = p.grp AND r.x = p.x + {step} AND r.y = p.y "
        f"LEFT JOIN paint d ON d.grp = p.grp AND d.x = p.x AND d.y = p.y - {step} "
        f"LEFT JOIN paint u ON u.grp = p.grp AND u.x = p.x AND u.y = p.y + {step}) "
        f"SELECT grp, round(CAST(count(*) AS DOUBLE) * {step * step} / {fx.DEGREE * fx.DEGREE}, {C.AREA_DIGITS}) AS area, "
        f"round(CAST(sum(n) AS DOUBLE) * {step} / {fx.DEGREE}, 6) AS length FROM side GROUP BY grp")
    lo, hi = C.WINDOW_SHARE
    window = " AND ".join(f"{c} BETWEEN lo_{c} + {lo}::DOUBLE * (hi_{c} - lo_{c}) AND lo_{c} + {hi}::DOUBLE * (hi_{c} - lo_{c})"
                          for c in ("x", "y"))
    s["map_window"] = (f"WITH s AS ({silver_incidents_sql()}), b AS (SELECT min(x) AS lo_x, max(x) AS hi_x, min(y) AS lo_y, "
                       f"max(y) AS hi_y FROM s) SELECT s.* FROM s, b WHERE {window}")
    s["gold_refresh"] = (f"WITH g AS ({gold_incidents_sql()}) SELECT * FROM g WHERE YEAR_INFO IS NULL "
                         "OR YEAR_INFO < (SELECT max(YEAR_INFO) FROM g) OR MONTH_INFO > 6")
    s["landing_run"] = ("SELECT *, CAST(1 AS INTEGER) AS n_polygons, CAST(7 AS INTEGER) AS n_points "
                        f"FROM ({gold_sector_sql()})")
    s["map_extract_municipality"] = (f"SELECT ID_MUN, MUN, STATE, {MAP_COLS} FROM ({gold_mun_sql()}) "
                                     f"WHERE YEAR_INFO = {C.MAP_YEAR}")
    s["map_layer_municipality"] = (
        f"SELECT g.ID_MUN, g.MUN, g.TOTAL_CRIMES, g.POP_TOTAL, g.TOTAL_CRIME_INDEX, e.n_edges AS n_points, "
        f"{area_deg2("c.cnt")} AS area FROM ({gold_mun_sql()}) g "
        f"JOIN ({mun_edges_sql()}) e ON g.ID_MUN = '35' || lpad(CAST(e.grp AS VARCHAR), 5, '0') "
        f"JOIN (SELECT c_nationkey, count(*) AS cnt FROM customer WHERE {IN_STATE.replace('CD_UF', UF)} "
        f"GROUP BY c_nationkey) c ON c.c_nationkey = e.grp WHERE g.YEAR_INFO = {C.MAP_YEAR}")
    ids = ", ".join(q(v) for v in C.MAP_MUNICIPALITIES)
    s["map_layer_sectors"] = (f"SELECT ID_SC, MUN, TOTAL_CRIMES, POP_TOTAL, TOTAL_CRIME_INDEX, "
                              f"CAST(6 AS BIGINT) AS n_points, {area_deg2("1")} AS area FROM ({gold_sector_sql()}) "
                              f"WHERE YEAR_INFO = {C.MAP_YEAR} AND ID_MUN IN ({ids})")
    s["map_extract_sectors"] = (f"SELECT ID_SC, MUN, STATE, {MAP_COLS} FROM ({gold_sector_sql()}) "
                                f"WHERE YEAR_INFO = {C.MAP_YEAR} AND ID_MUN IN ({ids})")
    s["map_extract_incidents"] = (
        f"SELECT ID_CRIME, CRIMINAL_CLASS, CRIMINAL_TYPE, ID_MUN, MUN, YEAR_INFO, "
        f"strftime(try_strptime(concat_ws('/', DAY_INFO, MONTH_INFO, YEAR_INFO), '%d/%m/%Y'), '%Y-%m-%d %H:%M:%S') "
        f"AS DATE_CRIME, y AS lat, x AS long FROM ({gold_incidents_sql()}) "
        f"WHERE ID_MUN = {q(C.MAP_CITY)} AND YEAR_INFO > {C.MAP_AFTER_YEAR}")
    s["map_layer_incidents"] = ("SELECT ID_CRIME, CRIMINAL_CLASS, YEAR_INFO, DATE_CRIME, 'Point' AS geometry_type, long, lat "
                                f"FROM ({s['map_extract_incidents']})")
    s["map_layer_city_border"] = (
        f"SELECT CD_MUN AS ID_MUN, NM_MUN AS MUN, n_points, area FROM ({s['geojson_municipalities']}) "
        f"WHERE CD_MUN = {q(C.MAP_CITY)}")
    rejects = []
    for source in ("cellphones", "vehicles", "others"):
        located = (f"SELECT LOGRADOURO, {coord_value(repair('LONGITUDE'))} AS x, {coord_value(repair('LATITUDE'))} AS y "
                   f"FROM ({raw_sql(source)})")
        reason = ("CASE WHEN x IS NULL OR x = 0 OR abs(x) >= 180 OR y IS NULL OR y = 0 OR abs(y) >= 89 THEN 'coordinate' "
                  f"WHEN LOGRADOURO IS NULL THEN 'no_address' WHEN LOGRADOURO LIKE '{pl.REDACTION_PATTERN}' THEN 'redacted' END")
        rejects.append(f"SELECT '{source}' AS source, reason, count(*) AS n FROM (SELECT {reason} AS reason FROM ({located})) "
                       f"WHERE reason IS NOT NULL GROUP BY reason")
    s["silver_rejects"] = " UNION ALL ".join(rejects)
    s["etl_table_rows"] = etl_rows_sql(s)
    return s


def etl_rows_sql(s: dict) -> str:
    """Rows per table of the layered run, from the SQL of each table."""
    parts_sql = "SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey"
    counts = [
        ("BRONZE", "bronze_crimes_cellphones", f"SELECT count(*) FROM (SELECT DISTINCT * FROM ({raw_sql('cellphones')}))"),
        ("BRONZE", "bronze_crimes_vehicles", f"SELECT count(*) FROM (SELECT DISTINCT * FROM ({raw_sql('vehicles')}))"),
        ("BRONZE", "bronze_crimes_others", f"SELECT count(*) FROM (SELECT DISTINCT * FROM ({raw_sql('others')}))"),
        ("BRONZE", "bronze_scs_demographics", f"SELECT count(*) FROM (SELECT DISTINCT * FROM ({DEMO}))"),
        ("BRONZE", "bronze_scs_geom", f"SELECT 2 * ({parts_sql})"),
        ("SILVER", "silver_scs_demographics", f"SELECT count(*) FROM ({s['silver_sector_population']})"),
        ("SILVER", "silver_mun_demographics", f"SELECT count(*) FROM ({s['agg_population_rollup']})"),
        ("SILVER", "silver_scs_edges", f"SELECT 6 * count(*) FROM ({SECTORS})"),
        ("SILVER", "silver_scs_geom", f"SELECT count(*) FROM ({s['silver_sector_geometry']})"),
        ("SILVER", "silver_mun_edges", f"SELECT sum(n_edges) FROM ({s['silver_municipality_geometry']})"),
        ("SILVER", "silver_mun_geom", f"SELECT count(*) FROM ({s['silver_municipality_geometry']})"),
        ("SILVER", "silver_scs_shapes", f"SELECT count(*) FROM ({SECTORS})"),
        ("SILVER", "silver_mun_shapes", f"SELECT count(*) FROM ({s['silver_municipality_geometry']})"),
        ("SILVER", "silver_scs", f"SELECT count(*) FROM ({s['join_zone_demographics']})"),
        ("SILVER", "silver_mun", f"SELECT count(*) FROM ({s['silver_municipality_geometry']})"),
        ("SILVER", "silver_crimes_cellphones", f"SELECT count(*) FROM ({silver_source_sql('cellphones')})"),
        ("SILVER", "silver_crimes_vehicles", f"SELECT count(*) FROM ({silver_source_sql('vehicles')})"),
        ("SILVER", "silver_crimes_others", f"SELECT count(*) FROM ({silver_source_sql('others')})"),
        ("SILVER", "silver_crimes", f"SELECT count(*) FROM ({silver_incidents_sql()})"),
        ("GOLD", "gold_crimes", f"SELECT count(*) FROM ({gold_incidents_sql()})"),
        ("GOLD", "gold_crimes_scs", f"SELECT count(*) FROM ({gold_sector_sql()})"),
        ("GOLD", "gold_crimes_mun", f"SELECT count(*) FROM ({gold_mun_sql()})"),
    ]
    return " UNION ALL ".join(f"SELECT '{lv}' AS level, '{t}' AS table_name, CAST(({c}) AS BIGINT) AS row_count"
                              for lv, t, c in counts)


ORACLE_SQL = build()
