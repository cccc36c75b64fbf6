"""Grids, rasters, catalogs, requests and areas derived from the test tables.

``grid`` etc. build them with Spark; the ``*_SQL`` texts build the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsieve.operators.areas import area_edges, areas_from_features, read_features
from gridsieve.scale import materialise

START, END = "1997-01-01T00:00:00", "1998-06-30T00:00:00"
RES = 0.25

# Rings of the test areas as x y pairs.
AREAS = {
    "A1": [[(8.6, 47.3), (11.9, 47.6), (11.2, 48.9), (12.3, 50.1), (10.1, 49.2), (8.9, 50.4), (9.4, 48.7), (8.6, 47.3)]],
    "A2": [
        [(8.1, 47.1), (12.1, 47.1), (12.1, 50.1), (8.1, 50.1), (8.1, 47.1)],
        [(9.1, 48.1), (10.6, 48.1), (10.6, 49.6), (9.1, 49.6), (9.1, 48.1)],
    ],
    "A3": [[(100.0, 0.0), (101.0, 0.0), (101.0, 1.0), (100.0, 1.0), (100.0, 0.0)]],
    "A4": [[(8.5, 47.5), (9.5, 47.5), (9.5, 48.5), (8.5, 48.5), (8.5, 47.5)]],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feature(name: str) -> dict:
    rings = [[list(p) for p in ring] for ring in AREAS[name]]
    return {
        "type": "Feature",
        "properties": {"name": name},
        "geometry": {"type": "Polygon", "coordinates": rings},
    }


def parts_feature(*names: str) -> dict:
    """One area whose parts are several of the test areas."""
    parts = [feature(n)["geometry"]["coordinates"] for n in names]
    return {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": parts}}


def edges(spark: SparkSession, *names: str) -> DataFrame:
    return area_edges(areas_from_features(spark, [(n, feature(n)) for n in names]))


def edges_sql(*names: str) -> str:
    rows = []
    for n in names:
        for ring in AREAS[n]:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
                rows.append(f"('{n}', {x1}::double, {y1}::double, {x2}::double, {y2}::double)")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS e(area_id, x1, y1, x2, y2)"


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        (F.lit(8) + (F.col("l_suppkey") % 20) * F.lit(0.25)).alias("x"),
        (F.lit(47) + (F.col("l_partkey") % 16) * F.lit(0.25)).alias("y"),
        F.col("l_shipdate").alias("time"),
        F.col("l_quantity").alias("v"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("w"),
        F.year("l_shipdate").cast("int").alias("file_id"),
    )


GRID_SQL = """
SELECT cast(8 + (l_suppkey % 20) * 0.25 AS double) AS x,
       cast(47 + (l_partkey % 16) * 0.25 AS double) AS y,
       l_shipdate AS time, l_quantity AS v,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS w,
       cast(year(l_shipdate) AS int) AS file_id
FROM lineitem
"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        (key % 6).alias("tile_id"),
        (F.floor(key / 6) % 50).alias("row"),
        F.floor(key / 300).alias("col"),
        F.when(key % 11 == 0, F.lit(-9999.0)).otherwise(F.col("o_totalprice")).alias("value"),
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tile table: one row per tile, kept once as a stored one would be."""
    sizes = pixels(spark, sf_dir).groupBy("tile_id").agg(
        (F.max("col") + 1).alias("width"), (F.max("row") + 1).alias("height")
    )
    tile = F.col("tile_id")
    described = sizes.select(
        "tile_id",
        (F.lit(8) + (tile % 3) * F.lit(2.0)).alias("x0"),
        (F.lit(51) - F.floor(tile / 3) * F.lit(2.0)).alias("y0"),
        F.lit(0.0625).alias("res_x"),
        F.lit(0.0625).alias("res_y"),
        "width",
        "height",
        F.when(tile % 2 == 0, F.lit(-9999.0)).alias("nodata"),
    )
    return materialise(described)


PIXELS_SQL = """
SELECT o_orderkey % 6 AS tile_id, cast(floor(o_orderkey / 6) AS bigint) % 50 AS "row",
       cast(floor(o_orderkey / 300) AS bigint) AS col,
       CASE WHEN o_orderkey % 11 = 0 THEN -9999.0 ELSE o_totalprice END AS value
FROM orders
"""

TILES_SQL = f"""
SELECT tile_id, 8 + (tile_id % 3) * 2.0::double AS x0, 51 - floor(tile_id / 3) * 2.0::double AS y0,
       0.0625::double AS res, max(col) + 1 AS width, max("row") + 1 AS height,
       CASE WHEN tile_id % 2 = 0 THEN -9999.0::double END AS nodata
FROM ({PIXELS_SQL}) GROUP BY tile_id
"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    kind = F.when(size % 4 == 0, "internal").when(size % 4 == 1, "external").otherwise("local")
    ending = (
        F.when(size % 7 == 0, ".csv")
        .when(size % 7 == 1, ".NC")
        .when(size % 7 == 2, "/*.tif")
        .when(size % 7 == 3, ".dat")
        .when(size % 7 == 4, ".zip")
        .when(size % 7 == 5, ".nc4")
        .otherwise("")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("entry_id"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_type", "p_brand").alias("variable_name"),
        kind.alias("ds_type"),
        F.concat(F.lit("/data/"), F.replace("p_name", F.lit(" "), F.lit("_")), ending).alias("path"),
    )


CATALOG_SQL = """
SELECT p_partkey AS entry_id, p_name AS title, concat(p_type, ' ', p_brand) AS variable_name,
       CASE p_size % 4 WHEN 0 THEN 'internal' WHEN 1 THEN 'external' ELSE 'local' END AS ds_type,
       concat('/data/', replace(p_name, ' ', '_'),
              CASE p_size % 7 WHEN 0 THEN '.csv' WHEN 1 THEN '.NC' WHEN 2 THEN '/*.tif' WHEN 3 THEN '.dat'
                              WHEN 4 THEN '.zip' WHEN 5 THEN '.nc4' ELSE '' END) AS path
FROM part
"""

ROUTED_SQL = f"""
SELECT *, CASE WHEN ds_type = 'internal' THEN 'sql' WHEN ds_type = 'external' THEN 'unsupported'
       WHEN lower(path) SIMILAR TO '.*\\.(nc|netcdf|cdf|nc4)' THEN 'grid'
       WHEN lower(path) SIMILAR TO '.*\\.(tif|tiff|dem)' THEN 'raster'
       WHEN lower(path) SIMILAR TO '.*\\.(csv|tsv|txt|dat)' THEN 'csv' END AS route,
       regexp_extract(path, '[^/]*$') AS base
FROM ({CATALOG_SQL})
"""

# output names of a routed entry: of a station file, and of any other
STATION_SQL = (
    "concat(regexp_replace(base, '_[^_]*$', ''), '_', "
    "trim(replace(regexp_extract(base, '[^_]*$'), '.csv', '')), '.csv')"
)
NAME_SQL = "concat(replace(variable_name, ' ', '_'), '_', entry_id)"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer, with repeated and missing ids."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("long")
    return table(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        F.array(key, key + 1, nation, nation, key + 1_000_000_000).alias("dataset_ids"),
    )


REQUESTED_SQL = """
SELECT c_custkey AS request_id, cast(position AS int) AS position,
       CASE position WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey + 1 WHEN 4 THEN c_custkey + 1000000000
                     ELSE c_nationkey END AS dataset_id
FROM customer, (SELECT unnest(range(5)) AS position)
"""


def _corner() -> tuple[Column, Column]:
    x = F.lit(5) + (F.col("c_custkey") % 40) * F.lit(0.25)
    return x, F.lit(47) + (F.col("c_nationkey") % 12) * F.lit(0.25)


def _square(x: Column, y: Column, side: float) -> Column:
    def point(dx: float, dy: float) -> Column:
        px, py = (x + F.lit(dx)).cast("string"), (y + F.lit(dy)).cast("string")
        return F.concat(F.lit("["), px, F.lit(", "), py, F.lit("]"))

    ring = [point(0, 0), point(side, 0), point(side, side), point(0, side), point(0, 0)]
    return F.concat(F.lit("[["), F.concat_ws(", ", *ring), F.lit("]]"))


def _feature_text(name: Column, x: Column, y: Column, side: float) -> Column:
    return F.concat(
        F.lit('{"type": "Feature", "properties": {"name": "'),
        name,
        F.lit('"}, "geometry": {"type": "Polygon", "coordinates": '),
        _square(x, y, side),
        F.lit("}}"),
    )


def catchments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One FeatureCollection text and one Feature text per customer."""
    x, y = _corner()
    first = _feature_text(F.col("c_name"), x, y, 0.5)
    second = _feature_text(F.lit("other"), x, y, 2.0)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("catchment"),
        first.alias("feature_text"),
        F.concat(
            F.lit('{"type": "FeatureCollection", "features": ['), first, F.lit(", "), second, F.lit("]}")
        ).alias("collection_text"),
    )


def odd_feature(kind: Column) -> Column:
    """Feature text by kind: one part, two parts, a point, no geometry, no JSON."""
    square = "[[[{0}, 1], [{1}, 1], [{1}, 2], [{0}, 2], [{0}, 1]]]"

    def text(geometry: str) -> str:
        return '{"type": "Feature", "properties": {}, "geometry": ' + geometry + "}"

    parts = f"[{square.format(0, 1)}, {square.format(5, 6)}]"
    return (
        F.when(kind == 0, text('{"type": "Polygon", "coordinates": ' + square.format(0, 1) + "}"))
        .when(kind == 1, text('{"type": "MultiPolygon", "coordinates": ' + parts + "}"))
        .when(kind == 2, text('{"type": "Point", "coordinates": [1, 2]}'))
        .when(kind == 3, text("null"))
        .otherwise('"none"')
    )


def many_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(request_id, doc)``: one request per customer, with areas, rules, bounds and ids of all kinds."""
    key = F.col("c_custkey")
    late = key % 50 == 0
    start = F.when(late, F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int"))).otherwise(
        F.add_months(F.lit("1995-01-01").cast("date"), (key % 72).cast("int"))
    )
    end = F.when(key % 97 == 0, "soon").otherwise(F.date_add(start, F.when(late, 3).otherwise(45)).cast("string"))
    x, y = _corner()
    area = F.when(key % 41 == 0, "null").otherwise(_feature_text(F.col("c_name"), x, y, 0.5))
    document = F.concat(
        F.lit('{"extractor": {"parameters": {"dataset_ids": '),
        F.when(late, "[1, 2, 99]").otherwise("[1]"),
        F.lit(', "start_date": "'), start.cast("string"), F.lit('", "end_date": "'), end,
        F.lit('", "cell_touches": '), F.when(key % 2 == 0, "false").otherwise("true"),
        F.lit(', "reference_area": '), area, F.lit("}}}"),
    )
    return table(spark, sf_dir, "customer").select(key.alias("request_id"), document.alias("doc"))


MANY_REQUESTS_SQL = """
SELECT c_custkey AS request_id, c_custkey % 97 <> 0 AS valid, c_custkey % 50 = 0 AS late, c_custkey % 41 = 0 AS free,
       c_custkey % 2 = 1 AS touches, 5 + (c_custkey % 40) * 0.25::double AS ax, 47 + (c_nationkey % 12) * 0.25::double AS ay,
       CASE WHEN c_custkey % 50 = 0 THEN TIMESTAMP '2024-01-01' + to_days(cast(c_custkey % 20 AS int))
            ELSE TIMESTAMP '1995-01-01' + to_months(cast(c_custkey % 72 AS int)) END AS since,
       CASE WHEN c_custkey % 50 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 45 DAY END AS length
FROM customer
"""


CATCHMENTS_SQL = """
SELECT c_custkey AS catchment, c_name,
       cast(5 + (c_custkey % 40) * 0.25 AS double) AS x, cast(47 + (c_nationkey % 12) * 0.25 AS double) AS y
FROM customer
"""


def nation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of A1 to A4 and of one overlapping square per nation."""
    key = F.col("n_nationkey")
    x, y = F.lit(8.05) + (key % 8) * F.lit(0.5), F.lit(47.05) + (key % 6) * F.lit(0.5)
    squares = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"), _feature_text(F.col("n_name"), x, y, 0.75).alias("text")
    )
    return edges(spark, *AREAS).unionByName(area_edges(read_features(squares, "text", "name")))


NATION_EDGES_SQL = f"""
{edges_sql(*AREAS)}
UNION ALL
SELECT n_name, x + a.x1, y + a.y1, x + a.x2, y + a.y2
FROM (SELECT n_name, 8.05::double + (n_nationkey % 8) * 0.5::double AS x,
             47.05::double + (n_nationkey % 6) * 0.5::double AS y FROM nation),
     (VALUES (0::double, 0::double, 0.75::double, 0::double), (0.75, 0, 0.75, 0.75),
             (0.75, 0.75, 0, 0.75), (0, 0.75, 0, 0)) AS a(x1, y1, x2, y2)
"""
