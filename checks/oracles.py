"""SQL that gives the same rows as the registered queries, by brute force."""

from __future__ import annotations

import math

from checks import inputs as inp

# Fixed values, as the queries have them.
GLOBS = (("title", "small*"), ("title", "*ring"), ("variable_name", "LARGE*#1*"), ("title", "*%*"), ("path", "*_*.N*"))
TILE_KEY = "Copernicus_DSM_10_N%02d_00_E%03d_00"
YEAR_FILES = (
    ("Precipitation", "pr", 1, "v5-0"),
    ("RadiationGlobal", "rsds", 5, "v3-0"),
    ("Humidity", "hurs", 5, "v5-0"),
    ("TemperatureMean", "tas", 5, "v5-0"),
    ("TemperatureMin", "tasmin", 5, "v5-0"),
    ("TemperatureMax", "tasmax", 5, "v5-0"),
)

START, END = f"TIMESTAMP '{inp.START}'", f"TIMESTAMP '{inp.END}'"
# half a cell, grown so that contact at a corner does not depend on rounding
HALF = inp.RES / 2 * (1 + 1e-9)
HALF_PIXEL = 0.0625 / 2 * (1 + 1e-9)


def _sides(rect: list[tuple[str, str]]) -> str:
    """Whether an edge e separates the four corners: all of them on one side."""
    cross = [f"((e.x2 - e.x1) * (({y}) - e.y1) - (e.y2 - e.y1) * (({x}) - e.x1))" for x, y in rect]
    return f"(least({', '.join(cross)}) > 0 OR greatest({', '.join(cross)}) < 0)"


def mask_sql(edges: str, cells: str, hx: float = HALF, hy: float = HALF, tied: bool = False) -> str:
    """Per cell and area: inside (even-odd), and touched by an edge; every pair is tested."""
    corners = [(f"c.x {a} {hx!r}::double", f"c.y {b} {hy!r}::double") for a in "+-" for b in "+-"]
    return f"""
SELECT {'c.*' if tied else 'e.area_id, c.*'},
       sum(CASE WHEN ((e.y1 > c.y) <> (e.y2 > c.y))
                 AND c.x < (e.x2 - e.x1) * (c.y - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1
                THEN 1 ELSE 0 END) % 2 = 1 AS inside,
       max(CASE WHEN greatest(e.x1, e.x2) >= c.x - {hx!r}::double AND least(e.x1, e.x2) <= c.x + {hx!r}::double
                 AND greatest(e.y1, e.y2) >= c.y - {hy!r}::double AND least(e.y1, e.y2) <= c.y + {hy!r}::double
                 AND NOT {_sides(corners)}
                THEN 1 ELSE 0 END) = 1 AS touched
FROM ({cells}) c JOIN ({edges}) e ON {'c.area_id = e.area_id' if tied else 'true'} GROUP BY ALL
"""


def _clip_sql(columns: str, areas: tuple[str, ...], rule: str, extra: str = "") -> str:
    mask = mask_sql(inp.edges_sql(*areas), f"SELECT DISTINCT x, y FROM ({inp.GRID_SQL})")
    return f"""
WITH mask AS (SELECT DISTINCT x, y FROM ({mask}) WHERE {rule})
SELECT {columns} FROM ({inp.GRID_SQL}) g JOIN mask USING (x, y) {extra}
"""


def _box(area: str) -> tuple[float, float, float, float]:
    points = [p for ring in inp.AREAS[area] for p in ring]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return min(xs), min(ys), max(xs), max(ys)


def _in_box(*areas: str) -> str:
    boxes = [_box(a) for a in areas]
    xmin, ymin = min(b[0] for b in boxes), min(b[1] for b in boxes)
    xmax, ymax = max(b[2] for b in boxes), max(b[3] for b in boxes)
    return (
        f"x BETWEEN {xmin}::double - {HALF!r}::double AND {xmax}::double + {HALF!r}::double "
        f"AND y BETWEEN {ymin}::double - {HALF!r}::double AND {ymax}::double + {HALF!r}::double"
    )


TOUCH = "inside OR touched"

_DOC_OK = "o_custkey % 5 <> 0"

REQUEST_PARSE = f"""
SELECT o_orderkey AS request_id, {_DOC_OK} AS valid,
       CASE WHEN {_DOC_OK} THEN concat(o_orderkey, ',', o_custkey, ',', o_custkey) END AS dataset_ids,
       CASE WHEN {_DOC_OK} AND o_orderstatus = 'P' THEN o_orderdate + INTERVAL 11 HOUR
            WHEN {_DOC_OK} AND o_orderstatus = 'F' THEN o_orderdate + INTERVAL 12 HOUR END AS start_date,
       CASE WHEN {_DOC_OK} AND o_orderpriority <> '1-URGENT' THEN o_orderdate + INTERVAL 11 HOUR END AS end_date,
       NOT ({_DOC_OK} AND o_custkey % 2 = 0) AS cell_touches,
       CASE WHEN {_DOC_OK} THEN 4 END::int AS n_vertices,
       CASE WHEN {_DOC_OK} THEN cast(o_custkey % 10 AS double) END AS first_x
FROM orders
"""

CATALOG_FIRST = f"""
SELECT entry_id, concat(CASE WHEN title > concat('old ', title) THEN 'old ' ELSE '' END, title) AS title,
       path, 2::bigint AS n_matches
FROM ({inp.CATALOG_SQL})
"""


def _glob_sql() -> str:
    parts = []
    for column, pattern in GLOBS:
        like = pattern.replace("!", "!!").replace("%", "!%").replace("_", "!_").replace("*", "%")
        parts.append(
            f"SELECT '{pattern}' AS pattern, entry_id, title FROM ({inp.CATALOG_SQL}) "
            f"WHERE {column} LIKE '{like}' ESCAPE '!'"
        )
    return " UNION ALL ".join(parts)


FIND_OR_CREATE = """
WITH existing AS (SELECT p_type AS name, min(p_brand) AS symbol FROM part GROUP BY 1),
candidates AS (
  SELECT c_mktsegment AS name, 'segment' AS symbol FROM customer
  UNION ALL SELECT p_type, 'type' FROM part
  UNION ALL SELECT p_brand, p_name FROM part)
SELECT name, symbol, false AS created FROM existing
UNION ALL
SELECT name, min(symbol), true FROM candidates WHERE name NOT IN (SELECT name FROM existing) GROUP BY name
"""


def _square_text(side: str) -> str:
    corners = [("0", "0"), (side, "0"), (side, side), ("0", side), ("0", "0")]
    points = [f"'[', x + {dx}, ',', y + {dy}, ']'" for dx, dy in corners]
    return "concat('[[', " + ", ',', ".join(points) + ", ']]')"


FANOUT = f"""
SELECT catchment, concat('{{"extractor":{{"parameters":{{"dataset_ids":[',
         (SELECT string_agg(n_nationkey::varchar, ',' ORDER BY n_nationkey) FROM nation WHERE n_name LIKE 'NATION!_1%' ESCAPE '!'),
         '],"start_date":"1995-01-01T12:00:00+01","end_date":"2001-12-31T12:00:00+01","reference_area":',
         '{{"type":"Feature","properties":{{"name":"', c_name, '"}},"geometry":{{"type":"Polygon","coordinates":',
         {_square_text('0.5')}, '}}}}}}}}}}') AS request
FROM ({inp.CATCHMENTS_SQL})
"""

_YEAR_VALUES = ", ".join(f"({i}, '{f}', '{p}', {r}, '{v}')" for i, (f, p, r, v) in enumerate(YEAR_FILES))

YEAR_FILES_SQL = f"""
WITH variables AS (SELECT * FROM (VALUES {_YEAR_VALUES}) AS t(i, folder, prefix, resolution, version)),
years AS (SELECT o_custkey % 6 AS i, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders GROUP BY 1),
expected AS (
  SELECT i, folder, cast(unnest(generate_series(a, b)) AS int) AS year, prefix, resolution, version
  FROM variables JOIN years USING (i))
SELECT folder, year, concat(prefix, '_hyras_', resolution, '_', year, '_', version, '_de.nc') AS key
FROM expected
WHERE (i, year) NOT IN (SELECT s_suppkey % 6, 1995 + s_nationkey % 7 FROM supplier)
"""

_TILE_FORMAT = TILE_KEY.replace("%02d", "{:02d}").replace("%03d", "{:03d}")

TILE_KEYS = f"""
WITH ranges AS (
  SELECT min(47 + c_custkey % 9) AS a, max(47 + c_custkey % 9) AS b,
         min(5 + c_nationkey % 12) AS c, max(5 + c_nationkey % 12) AS d
  FROM customer GROUP BY c_mktsegment),
lats AS (SELECT unnest(generate_series(a, b)) AS lat, c, d FROM ranges),
expected AS (SELECT DISTINCT lat, unnest(generate_series(c, d)) AS lon FROM lats)
SELECT format('{_TILE_FORMAT}', lat, lon) AS key FROM expected
WHERE (lat, lon) NOT IN (SELECT 47 + s_suppkey % 9, 5 + s_nationkey % 12 FROM supplier)
"""

FILE_KEY = """
WITH files AS (
  SELECT p_partkey AS entry_id, CASE p_partkey % 5
    WHEN 0 THEN concat('/data/discharge_sim_DE', p_partkey, '.csv')
    WHEN 1 THEN concat('/data/', replace(p_name, ' ', '_'), '.csv')
    WHEN 2 THEN 'data.csv' WHEN 3 THEN concat('x_', p_partkey, '.tsv')
    ELSE concat('/a_b/', p_name, '_ ', p_partkey, ' .csv') END AS path FROM part),
named AS (SELECT entry_id, regexp_extract(path, '[^/]*$') AS base FROM files),
keyed AS (SELECT *, trim(replace(regexp_extract(base, '[^_]*$'), '.csv', '')) AS station FROM named)
SELECT entry_id, station, concat(regexp_replace(base, '_[^_]*$', ''), '_', station, '.csv') AS target FROM keyed
"""

TIME_OPEN = " UNION ALL ".join(
    f"SELECT '{name}' AS range, time, v, x, y FROM ({inp.GRID_SQL}) WHERE {test}"
    for name, test in (
        ("from", f"time >= {START}"), ("until", f"time <= {END}"), ("all", "true"),
        ("reversed", f"time >= {END} AND time <= {START}"),
    )
)

TIME_NORMALISE = """
SELECT o_orderkey,
       concat(strftime(o_orderdate, '%Y-%m-%d'), CASE o_custkey % 6 WHEN 0 THEN 'T12:00:00'
         WHEN 1 THEN 'T12:00:00+01:00' WHEN 2 THEN 'T12:00:00+01' WHEN 3 THEN 'T12:00:00Z'
         WHEN 4 THEN ' 12:00:00.250-05:30' ELSE '' END) AS bound,
       o_orderdate + CASE o_custkey % 6 WHEN 0 THEN INTERVAL 12 HOUR WHEN 1 THEN INTERVAL 11 HOUR
         WHEN 2 THEN INTERVAL 11 HOUR WHEN 3 THEN INTERVAL 12 HOUR
         WHEN 4 THEN INTERVAL 63000250 MILLISECONDS ELSE INTERVAL 0 HOUR END AS utc
FROM orders
"""

TIME_PARSE = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN ts WHEN 1 THEN date_trunc('second', ts)
       WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('day', ts)::timestamp END AS time
FROM events
"""

FILE_SKIP = f"""
WITH g AS ({inp.GRID_SQL}),
kept AS (SELECT file_id FROM g GROUP BY file_id HAVING NOT ({START} > max(time) OR {END} < min(time)))
SELECT file_id, time, x, y, v FROM g WHERE file_id IN (SELECT file_id FROM kept)
"""

# requests of all kinds against the grid: squares by both rules, no area, time ranges
EXTRACTED = f"""
SELECT request_id, x, y, time, v
FROM ({inp.MANY_REQUESTS_SQL}) r JOIN ({inp.GRID_SQL}) g ON time BETWEEN since AND since + length AND (
  free OR CASE WHEN touches THEN x + {HALF!r}::double >= ax AND x - {HALF!r}::double <= ax + 0.5
                             AND y + {HALF!r}::double >= ay AND y - {HALF!r}::double <= ay + 0.5
               ELSE x >= ax AND x < ax + 0.5 AND y >= ay AND y < ay + 0.5 END)
WHERE valid
"""

CLIP_DENSE = f"""
WITH mask AS (SELECT DISTINCT x, y, true AS kept FROM (
  {mask_sql(inp.edges_sql('A1', 'A4'), f'SELECT DISTINCT x, y FROM ({inp.GRID_SQL})')}) WHERE {TOUCH})
SELECT x, y, time, CASE WHEN kept THEN v END AS v, CASE WHEN kept THEN w END AS w
FROM ({inp.GRID_SQL}) g LEFT JOIN mask USING (x, y) WHERE {_in_box('A1', 'A4')}
"""

CLIP_MANY = f"""
WITH mask AS (SELECT area_id, x, y FROM (
  {mask_sql(inp.NATION_EDGES_SQL, f'SELECT DISTINCT x, y FROM ({inp.GRID_SQL})')}) WHERE {TOUCH})
SELECT area_id, x, y, time, v FROM ({inp.GRID_SQL}) g JOIN mask USING (x, y)
"""

COORD_RESOLVE = f"""
{_clip_sql("x, y, time, v, NULL::double AS easting, NULL::double AS northing, 'assumed_4326' AS status", ("A4",), "inside")}
UNION ALL
SELECT NULL, NULL, time, v, x, y, 'no_crs' FROM ({inp.GRID_SQL})
"""


def _reproject_sql() -> str:
    # fixed values: EPSG:3034 on GRS 80 (parallels 35 and 65, origin 52 N 10 E), and the radius of WGS 84
    n, f, rho_0 = 0.7753815998754331, 1.7493334756981185, 4901418.870196237
    e, a = 0.08181919104281579, 6378137.0
    lon_0, false_easting, false_northing, radius = 10.0, 4_000_000.0, 2_800_000.0, 6378137.0

    def mercator(lon: str, lat: str) -> tuple[str, str]:
        return (
            f"{radius}::double * radians({lon})",
            f"{radius}::double * ln(tan({math.pi / 4!r}::double + radians({lat}) / 2))",
        )

    def conic(lon: str, lat: str) -> tuple[str, str]:
        s = f"({e!r}::double * sin(radians({lat})))"
        t = f"(tan({math.pi / 4!r}::double - radians({lat}) / 2) / pow((1 - {s}) / (1 + {s}), {e / 2!r}::double))"
        rho = f"({a * f!r}::double * pow({t}, {n!r}::double))"
        theta = f"({n!r}::double * radians({lon} - {lon_0}::double))"
        return (
            f"{false_easting}::double + {rho} * sin({theta})",
            f"{false_northing + rho_0!r}::double - {rho} * cos({theta})",
        )

    parts = []
    for epsg, formula in ((3857, mercator), (3034, conic)):
        (x1, y1), (x2, y2) = formula("lon1", "lat1"), formula("lon2", "lat2")
        parts.append(
            f"SELECT catchment AS area_id, {epsg}::int AS epsg, round({x1}, 3) AS x1, round({y1}, 3) AS y1, "
            f"round({x2}, 3) AS x2, round({y2}, 3) AS y2 FROM edges"
        )
    return f"""
WITH edges AS (
  SELECT catchment, x + a.x1 AS lon1, y + a.y1 AS lat1, x + a.x2 AS lon2, y + a.y2 AS lat2
  FROM ({inp.CATCHMENTS_SQL}),
       (VALUES (0::double, 0::double, 0.5::double, 0::double), (0.5, 0, 0.5, 0.5), (0.5, 0.5, 0, 0.5),
               (0, 0.5, 0, 0)) AS a(x1, y1, x2, y2))
{' UNION ALL '.join(parts)}
"""


AREA_VERTICES = f"""
SELECT catchment AS area_id, 0::int AS ring, pos::int AS pos, x + dx AS x, y + dy AS y
FROM ({inp.CATCHMENTS_SQL}),
     (VALUES (0, 0::double, 0::double), (1, 0.5, 0), (2, 0.5, 0.5), (3, 0, 0.5), (4, 0, 0)) AS a(pos, dx, dy)
"""

PLACED_SQL = f"""
SELECT p.*, t.x0 + (p.col + 0.5::double) * t.res AS x, t.y0 - (p."row" + 0.5::double) * t.res AS y,
       coalesce(t.nodata, -9999.0::double) AS fill
FROM ({inp.PIXELS_SQL}) p JOIN ({inp.TILES_SQL}) t USING (tile_id)
"""

WINDOWS_SQL = f"""
SELECT b.area_id, t.*,
       greatest(floor((b.xmin - t.x0) / t.res), 0)::bigint AS c0,
       least(ceil((b.xmax - t.x0) / t.res), t.width)::bigint AS c1,
       greatest(floor((t.y0 - b.ymax) / t.res), 0)::bigint AS r0,
       least(ceil((t.y0 - b.ymin) / t.res), t.height)::bigint AS r1
FROM ({inp.TILES_SQL}) t,
     (SELECT area_id, min(least(x1, x2)) AS xmin, max(greatest(x1, x2)) AS xmax,
             min(least(y1, y2)) AS ymin, max(greatest(y1, y2)) AS ymax
      FROM ({inp.NATION_EDGES_SQL}) GROUP BY area_id) b
WHERE b.xmax > t.x0 AND b.xmin < t.x0 + t.width * t.res
  AND b.ymax > t.y0 - t.height * t.res AND b.ymin < t.y0
"""

IN_WINDOWS_SQL = f"""
SELECT w.area_id, p.*, w.r0, w.c0
FROM ({PLACED_SQL}) p JOIN ({WINDOWS_SQL}) w
  ON p.tile_id = w.tile_id AND p."row" >= w.r0 AND p."row" < w.r1 AND p.col >= w.c0 AND p.col < w.c1
"""


def _raster_mask_sql(rule: str) -> str:
    mask = mask_sql("SELECT * FROM e", "SELECT area_id, tile_id, \"row\", col, x, y FROM w", HALF_PIXEL, HALF_PIXEL, True)
    return f"""
WITH e AS ({inp.NATION_EDGES_SQL}), w AS ({IN_WINDOWS_SQL}), mask AS ({mask})
SELECT w.area_id, w.tile_id, w."row" - w.r0 AS "row", w.col - w.c0 AS col,
       CASE WHEN {rule} THEN w.value ELSE w.fill END AS value
FROM w JOIN mask USING (area_id, tile_id, "row", col)
"""


MOSAIC = f"""
WITH p AS (SELECT *, floor((51 - y) / 0.0625::double)::bigint AS grow, floor((x - 8) / 0.0625::double)::bigint AS gcol
           FROM ({PLACED_SQL}) WHERE value <> fill),
d AS (SELECT *, pow(x - (8 + (gcol + 0.5) * 0.0625::double), 2) + pow(y - (51 - (grow + 0.5) * 0.0625::double), 2) AS dist
      FROM p)
SELECT grow, gcol, arg_min(value, {{'d': dist, 't': tile_id, 'r': "row", 'c': col}}) AS value FROM d GROUP BY ALL
"""

EXTENT = f"""
SELECT min(x0) AS xmin, min(y0 - height * res) AS ymin, max(x0 + width * res) AS xmax, max(y0) AS ymax
FROM ({inp.TILES_SQL})
"""

EXTENT_WKT = f"""
SELECT concat('POLYGON((', xmin, ' ', ymin, ', ', xmax, ' ', ymin, ', ', xmax, ' ', ymax, ', ', xmin, ' ', ymax,
              ', ', xmin, ' ', ymin, '))') AS extent,
       concat('POINT (', (xmin + xmax) / 2, ' ', (ymin + ymax) / 2, ')') AS location
FROM ({EXTENT})
"""

PART_NAMES = """
WITH files AS (
  SELECT o_custkey AS entry_id, concat('air_temp_', o_custkey % 3, '_', o_custkey) AS stem,
         CASE WHEN o_custkey % 2 = 0 THEN 'grid' ELSE 'raster' END AS route,
         concat('/data/', lpad(o_orderkey::varchar, 9, '0'), '.nc') AS path, o_orderstatus <> 'F' AS kept,
         count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders),
parts AS (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY path) AS part FROM files WHERE kept)
SELECT entry_id, route, path, part::bigint AS part,
       CASE WHEN route = 'raster' AND n = 1 THEN stem ELSE concat(stem, '_part_', part) END AS target
FROM parts
"""

SINK_DISPATCH = f"""
WITH o AS (SELECT entry_id, CASE WHEN route IN ('sql', 'csv') THEN 'frame' WHEN route = 'grid' THEN 'grid' ELSE 'other' END AS kind,
                  CASE WHEN route = 'csv' THEN {inp.STATION_SQL} ELSE {inp.NAME_SQL} END AS target
           FROM ({inp.ROUTED_SQL}))
SELECT entry_id, kind,
       CASE WHEN kind = 'grid' THEN 'cells' WHEN kind = 'other' THEN 'raw' WHEN target LIKE '%csv' THEN 'csv'
            ELSE 'parquet' END AS format,
       CASE WHEN kind = 'other' THEN concat('raw/', target) WHEN kind = 'frame' AND target LIKE '%csv' THEN target
            WHEN target LIKE '%.parquet' THEN target ELSE concat(target, '.parquet') END AS final_target
FROM o
"""

METADATA = f"""
SELECT entry_id, concat('{{"entry_id":', entry_id, ',"title":"', title, '","variable_name":"', variable_name,
         '","ds_type":"', ds_type, '","path":"', path, '","support":', p_retailprice, ',"created":"',
         strftime(TIMESTAMP '2020-01-31 06:30:00' + to_days(p_size), '%Y-%m-%dT%H:%M:%S'), '","license":',
         CASE WHEN p_size > 25 THEN concat('"', p_brand, '"') ELSE 'null' END, '}}') AS metadata
FROM ({inp.CATALOG_SQL}) JOIN part ON p_partkey = entry_id
"""

REPORT = f"""
WITH wanted AS ({inp.REQUESTED_SQL}), routed AS ({inp.ROUTED_SQL}),
stats AS (SELECT l_partkey AS entry_id, count(*) AS n, min(l_shipdate) AS a, max(l_shipdate) AS b
          FROM lineitem WHERE l_shipdate >= {START} AND l_shipdate <= {END} GROUP BY 1),
joined AS (
  SELECT w.*, r.entry_id AS found, r.route, coalesce(s.n, 0) AS n, s.a, s.b, r.variable_name, r.base,
         coalesce(r.route IN ('sql', 'csv', 'grid', 'raster'), false) AS readable
  FROM wanted w LEFT JOIN routed r ON r.entry_id = w.dataset_id LEFT JOIN stats s ON s.entry_id = w.dataset_id)
SELECT request_id, position, dataset_id AS entry_id, route,
       CASE WHEN found IS NULL THEN 'missing' WHEN route IS NULL THEN 'unrouted'
            WHEN route = 'unsupported' THEN 'unsupported' WHEN n = 0 THEN 'empty' ELSE 'ok' END AS status,
       CASE WHEN readable THEN n END::bigint AS n_rows,
       CASE WHEN readable AND n > 0 THEN a END AS t_min, CASE WHEN readable AND n > 0 THEN b END AS t_max,
       CASE WHEN readable AND n > 0 THEN
         CASE WHEN route = 'csv' THEN {inp.STATION_SQL}
              ELSE concat(replace(variable_name, ' ', '_'), '_', dataset_id) END END AS target
FROM joined
"""

def _bands_sql(one: str, columns: str) -> str:
    """The rows of one band, and again as band 2 with doubled values but for the nodata mark."""
    return f"""
SELECT 1::int AS band, {columns}, value FROM ({one})
UNION ALL
SELECT 2::int, {columns}, CASE WHEN value = -9999.0 THEN value ELSE value * 2 END FROM ({one})
"""


CREATE_RECORDS = """
WITH existing AS (
  SELECT p_type AS name, min(p_name) AS title, min(p_size) AS size, min(p_retailprice) AS price
  FROM part WHERE p_size % 5 = 0 GROUP BY 1),
candidates AS (
  SELECT p_type AS name, p_name AS title, p_size AS size, p_retailprice AS price FROM part
  UNION ALL SELECT p_brand, p_name, p_size, p_retailprice FROM part)
SELECT *, false AS created FROM existing
UNION ALL
SELECT name, title, size, price, true FROM candidates WHERE name NOT IN (SELECT name FROM existing)
QUALIFY row_number() OVER (PARTITION BY name ORDER BY title, size, price) = 1
"""

ORACLES: dict[str, str] = {
    "request_valid": """
SELECT o_orderkey AS request_id, o_custkey % 3 <> 0 AND o_custkey % 7 <> 0 AND o_custkey % 5 < 2 AS valid FROM orders""",
    "area_status": """
SELECT c_custkey AS area_id,
       ['ok', 'ok', 'refused: Point', 'unreadable', 'unreadable'][c_custkey % 5 + 1] AS status,
       [1, 2, 0, 0, 0][c_custkey % 5 + 1]::int AS rings
FROM customer""",
    "area_parts": """
SELECT c_custkey AS area_id, 4 * (1 + c_custkey % 5) AS n_edges, 0::double AS xmin, 1::double AS ymin,
       CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 6 END::double AS xmax, 2::double AS ymax
FROM customer WHERE c_custkey % 5 < 2""",
    "request_fanout_ids": """
SELECT c_custkey AS catchment, (SELECT count(*) FROM nation) AS n_ids,
       (SELECT sum(n_nationkey * 7919) FROM nation)::bigint AS sum_ids
FROM customer""",
    "catalog_create_records": CREATE_RECORDS,
    "request_parse": REQUEST_PARSE,
    "catalog_lookup": f"SELECT request_id, position, dataset_id, title, variable_name, path "
    f"FROM ({inp.REQUESTED_SQL}) JOIN ({inp.CATALOG_SQL}) ON entry_id = dataset_id",
    "catalog_missing": f"SELECT * FROM ({inp.REQUESTED_SQL}) "
    "WHERE dataset_id NOT IN (SELECT p_partkey FROM part)",
    "catalog_first_match": CATALOG_FIRST,
    "catalog_glob": _glob_sql(),
    "catalog_find_or_create": FIND_OR_CREATE,
    "request_fanout": FANOUT,
    "source_route": f"SELECT entry_id, route FROM ({inp.ROUTED_SQL})",
    "sql_source": f"SELECT time, v, w, x, y FROM ({inp.GRID_SQL}) WHERE time >= {START} AND time <= {END}",
    "path_expand": "SELECT DISTINCT event_type, suffix FROM events, (VALUES ('.csv'), ('.dat')) AS s(suffix)",
    "csv_scan": "SELECT ts, value, user_id AS station FROM events, (VALUES (1), (2)) AS twice(i)",
    "csv_status": "SELECT DISTINCT event_type, kind, status, detail FROM events, (VALUES ('csv', 'read', NULL), "
    "('txt', 'read', NULL), ('csv', 'failed', 'missing columns: value')) AS s(kind, status, detail)",
    "csv_breaks": "SELECT ts, event_type || chr(10) || 'said \"x\"' AS note, (user_id % 7)::varchar || 'F' AS code, value "
    "FROM events",
    "csv_roundtrip": "SELECT * FROM events",
    "grid_unpack": "SELECT l_shipdate AS time, l_orderkey AS cell, "
    "nullif(l_quantity, 13) * 0.5::double + 10.0::double AS pr, "
    "l_linenumber::double * 0.01::double + 273.15::double AS tas FROM lineitem",
    "raster_pixels": f"SELECT tile_id, \"row\", col, value, x, y FROM ({PLACED_SQL})",
    "tile_keys": TILE_KEYS,
    "year_files": YEAR_FILES_SQL,
    "file_key": FILE_KEY,
    "project_catalog": f"SELECT time, v, x, y FROM ({inp.GRID_SQL})",
    "time_clip": f"SELECT * FROM ({inp.GRID_SQL}) WHERE time >= {START} AND time <= {END}",
    "time_clip_open": TIME_OPEN,
    "time_normalise": TIME_NORMALISE,
    "time_parse": TIME_PARSE,
    "file_skip": FILE_SKIP,
    "bbox_clip": f"SELECT x, y, time, v FROM ({inp.GRID_SQL}) WHERE {_in_box('A1')}",
    "clip_touch": _clip_sql("x, y, time, v", ("A1",), TOUCH),
    "clip_centre": _clip_sql("x, y, time, v", ("A1",), "inside"),
    "extract_many": f"SELECT request_id, x, y, time, v FROM ({EXTRACTED})",
    "extract_many_status": f"""
        WITH grid AS (SELECT request_id, count(*) AS n, min(time) AS t_min, max(time) AS t_max FROM ({EXTRACTED}) GROUP BY 1),
        sensed AS (
            SELECT request_id, count(*) AS n, min(ts) AS t_min, max(ts) AS t_max
            FROM ({inp.MANY_REQUESTS_SQL}) r JOIN events ON ts BETWEEN since AND since + length
            WHERE valid AND late GROUP BY 1
        ), asked AS (
            SELECT request_id, 0 AS position, 1::bigint AS entry_id, 'grid' AS route FROM ({inp.MANY_REQUESTS_SQL}) WHERE valid
            UNION ALL SELECT request_id, 1, 2, 'sql' FROM ({inp.MANY_REQUESTS_SQL}) WHERE valid AND late
            UNION ALL SELECT request_id, 2, 99, NULL FROM ({inp.MANY_REQUESTS_SQL}) WHERE valid AND late
        ), found AS (SELECT 1 AS entry_id, * FROM grid UNION ALL SELECT 2, * FROM sensed)
        SELECT request_id, position, entry_id, route,
               CASE WHEN entry_id = 99 THEN 'missing' WHEN n > 0 THEN 'ok' ELSE 'empty' END AS status,
               CASE WHEN entry_id < 99 THEN coalesce(n, 0) END AS n_rows, t_min, t_max
        FROM asked LEFT JOIN found USING (request_id, entry_id)
        UNION ALL SELECT request_id, NULL, NULL, NULL, 'invalid', NULL, NULL, NULL FROM ({inp.MANY_REQUESTS_SQL}) WHERE NOT valid
    """,
    "extract_parts": f"""
        WITH g AS ({inp.GRID_SQL}),
        kept AS (
            SELECT file_id, row_number() OVER (ORDER BY file_id) AS part FROM g GROUP BY file_id
            HAVING NOT ({START} > max(time) OR {END} < min(time))
        ), cells AS (
            SELECT * FROM ({_clip_sql('g.*', ('A1',), TOUCH)}) JOIN kept USING (file_id) WHERE time BETWEEN {START} AND {END}
        )
        SELECT concat('air_temp_1_part_', part) AS target, 'ok' AS status, (SELECT count(*) FROM cells) AS all_rows,
               count(*) AS n_rows, min(time) AS t_min, max(time) AS t_max, sum(v) AS sum_v
        FROM cells GROUP BY part
    """,
    "clip_parts": f"""
        WITH mask AS ({mask_sql(inp.edges_sql('A1', 'A2', 'A4'), f'SELECT DISTINCT x, y FROM ({inp.GRID_SQL})')}),
        united AS (SELECT x, y, bool_or(inside) AS inside, bool_or(inside OR touched) AS touched FROM mask GROUP BY x, y)
        SELECT 'parts' AS area_id, x, y, time, v, touches
        FROM ({inp.GRID_SQL}) g JOIN united USING (x, y), (VALUES (true), (false)) AS t(touches)
        WHERE CASE WHEN touches THEN touched ELSE inside END
    """,
    "request_flags": """
        SELECT o_orderkey AS request_id, o_orderkey % 7 NOT IN (4, 5) AS valid, o_orderkey % 7 NOT IN (1, 2) AS cell_touches
        FROM orders
    """,
    "clip_hole": _clip_sql("x, y, time, v", ("A2",), "inside"),
    "clip_dense": CLIP_DENSE,
    "clip_long_dropna": _clip_sql("time, x, y, v, w", ("A1",), TOUCH, "WHERE w IS NOT NULL AND v IS NOT NULL"),
    "clip_many_areas": CLIP_MANY,
    "coord_resolve": COORD_RESOLVE,
    "area_reproject": _reproject_sql(),
    "raster_tile_skip": f"SELECT area_id, tile_id FROM ({WINDOWS_SQL})",
    "raster_crop_window": f"SELECT area_id, tile_id, r0 AS row_off, c0 AS col_off, r1 - r0 AS new_height, "
    f"c1 - c0 AS new_width, x0 + c0 * res AS new_x0, y0 - r0 * res AS new_y0 FROM ({WINDOWS_SQL})",
    "raster_crop": f"SELECT area_id, tile_id, \"row\" - r0 AS \"row\", col - c0 AS col, value FROM ({IN_WINDOWS_SQL})",
    "raster_mask": _raster_mask_sql(TOUCH),
    "raster_mask_centre": _raster_mask_sql("inside"),
    "raster_mosaic": MOSAIC,
    "tile_extent": EXTENT,
    "extent_wkt": EXTENT_WKT,
    "concat_files": f"SELECT x, y, time, v, NULL::double AS price FROM ({inp.GRID_SQL}) UNION ALL "
    "SELECT NULL, NULL, o_orderdate, NULL, o_totalprice FROM orders, (VALUES (1), (2)) AS twice(i)",
    "sort_time": f"SELECT x, y, time, v FROM ({inp.GRID_SQL}) ORDER BY time",
    "part_names": PART_NAMES,
    "sink_dispatch": SINK_DISPATCH,
    "output_name": f"SELECT entry_id, {inp.NAME_SQL} AS name FROM ({inp.CATALOG_SQL})",
    "parquet_roundtrip": "SELECT l_linenumber AS entry_id, year(l_shipdate)::int AS year, l_shipdate AS time, "
    "l_quantity AS v FROM lineitem",
    "grid_write_ignore": f"SELECT x, y, time, v FROM ({inp.GRID_SQL})",
    "metadata_json": METADATA,
    "raw_copy_manifest": "SELECT DISTINCT event_type, true AS identical FROM events",
    "area_vertices": AREA_VERTICES,
    "run_report": REPORT,
    "run_report_totals": f"SELECT status, count(*) AS datasets, coalesce(sum(n_rows), 0)::bigint AS n_rows "
    f"FROM ({REPORT}) GROUP BY status",
}
ORACLES |= {
    "raster_mosaic_bands": _bands_sql(ORACLES["raster_mosaic"], "grow, gcol"),
    "raster_crop_bands": _bands_sql(ORACLES["raster_crop"], 'area_id, tile_id, "row", col'),
    "raster_mask_bands": _bands_sql(ORACLES["raster_mask"], 'area_id, tile_id, "row", col'),
}
