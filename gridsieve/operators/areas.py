"""Reference areas: GeoJSON polygons as edges, vertices and bounding boxes."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsieve.functions.projections import LambertConformal, project

FEATURE = (
    "STRUCT<type: STRING, properties: MAP<STRING, STRING>, "
    "geometry: STRUCT<type: STRING, coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>>"
)
# the same with the coordinates of a geometry of several parts
FEATURE_OF_PARTS = FEATURE.replace("ARRAY<ARRAY<ARRAY<DOUBLE>>>", "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>")
GEOMETRIES = ("Polygon", "MultiPolygon")


def feature_of(text: Column) -> Column:
    """A GeoJSON Feature; a MultiPolygon holds the rings of all its parts in one list.

    ``parts`` tells the part of each ring: crossings are counted part by part, so that what
    several parts cover stays covered.
    """
    whole, several = F.from_json(text, FEATURE), F.from_json(text, FEATURE_OF_PARTS)

    def feature(parsed: Column, rings: Column, parts: Column) -> Column:
        geometry = F.struct(parsed["geometry"]["type"].alias("type"), rings.alias("coordinates"), parts.alias("parts"))
        known = F.when(parsed["geometry"].isNotNull(), geometry)
        built = F.struct(parsed["type"].alias("type"), parsed["properties"].alias("properties"), known.alias("geometry"))
        return F.when(parsed.isNotNull(), built)

    rings = several["geometry"]["coordinates"]
    numbers = F.flatten(F.transform(rings, lambda part, i: F.transform(part, lambda ring: i)))
    one = whole["geometry"]["coordinates"]
    return F.when(
        several["geometry"]["type"] == "MultiPolygon", feature(several, F.flatten(rings), numbers)
    ).otherwise(feature(whole, one, F.transform(one, lambda ring: F.lit(0))))


def is_area(feature: Column) -> Column:
    """Whether a feature has a geometry that can clip."""
    geometry = feature["geometry"]
    usable = (feature["type"] == "Feature") & geometry["type"].isin(*GEOMETRIES) & geometry["coordinates"].isNotNull()
    return F.coalesce(usable, F.lit(False))


def areas_from_features(spark: SparkSession, features: Iterable[tuple[object, dict]]) -> DataFrame:
    """``(area_id, feature)`` rows of GeoJSON features given with a request."""
    documents = []
    for area_id, feature in features:
        geometry = (feature or {}).get("geometry") or {}
        if feature.get("type") != "Feature" or geometry.get("type") not in GEOMETRIES:
            raise ValueError("a reference area must be one GeoJSON Feature with a Polygon or MultiPolygon geometry")
        documents.append({"area_id": area_id, "feature": feature})
    id_type = "BIGINT" if all(isinstance(d["area_id"], int) for d in documents) else "STRING"
    rows = [(d["area_id"], json.dumps(d["feature"])) for d in documents]
    spread = spark.createDataFrame(rows, f"area_id {id_type}, feature_text STRING")
    return read_features(spread, "feature_text", "area_id")


def read_features(df: DataFrame, text: str, area_id: str) -> DataFrame:
    """``(area_id, feature)`` rows from a column of GeoJSON Feature text."""
    # unfolding an array of one parses the text once, not once per use
    parsed = F.struct(feature_of(F.col(text)).alias("feature"))
    return df.select(F.col(area_id).alias("area_id"), F.inline(F.array(parsed)))


def area_status(areas: DataFrame) -> DataFrame:
    """``(area_id, status, rings)``: ``ok``, ``empty``, ``unreadable``, or the geometry refused."""
    kind = F.col("feature.geometry.type")
    rings = F.coalesce(F.size("feature.geometry.coordinates"), F.lit(0))
    status = (
        F.when(is_area(F.col("feature")), F.when(rings > 0, "ok").otherwise("empty"))
        .when(kind.isNull() | kind.isin(*GEOMETRIES), "unreadable")
        .otherwise(F.concat(F.lit("refused: "), kind))
    )
    return areas.select("area_id", status.alias("status"), rings.alias("rings"))


# every ring of a polygon, closed if the input leaves it open
_CLOSED = (
    "CASE WHEN points[0] = element_at(points, -1) THEN points "
    "ELSE concat(points, array(points[0])) END AS points"
)
# one struct per pair of neighbours; a ring of one point gives one edge of no length
_NEIGHBOURS = (
    "inline(transform(sequence(1, greatest(size(points) - 1, 1)), i -> named_struct("
    "'x1', points[i - 1][0], 'y1', points[i - 1][1], "
    "'x2', coalesce(get(points, i)[0], points[i - 1][0]), "
    "'y2', coalesce(get(points, i)[1], points[i - 1][1]))))"
)


def _rings(areas: DataFrame) -> DataFrame:
    return (
        areas.where(is_area(F.col("feature")))
        .selectExpr("area_id", "feature.geometry.parts", "posexplode(feature.geometry.coordinates) AS (ring, points)")
        .where("size(points) > 0")
        .selectExpr("area_id", "get(parts, ring) AS part", "ring", _CLOSED)
    )


def area_vertices(areas: DataFrame) -> DataFrame:
    """Every vertex of every ring: ``(area_id, ring, pos, x, y)``, rings closed."""
    return (
        _rings(areas)
        .selectExpr("area_id", "ring", "posexplode(points) AS (pos, point)")
        .selectExpr("area_id", "ring", "pos", "point[0] AS x", "point[1] AS y")
    )


def area_edges(areas: DataFrame, target: int | LambertConformal = 4326) -> DataFrame:
    """Edges ``(area_id, part, ring, x1, y1, x2, y2)`` in the coordinate system ``target``.

    Rings are closed when the input leaves them open; heights are ignored.  The
    rings stay in their row while edges are cut out of them, so nothing shuffles.
    """
    edges = _rings(areas).selectExpr("area_id", "part", "ring", _NEIGHBOURS)
    if target == 4326:
        return edges
    x1, y1 = project(F.col("x1"), F.col("y1"), target)
    x2, y2 = project(F.col("x2"), F.col("y2"), target)
    return edges.select(
        "area_id", "part", "ring", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")
    )


def vertex_lines(areas: DataFrame) -> DataFrame:
    """Text lines ``x y`` in ring and vertex order, for the vertex list export."""
    return (
        area_vertices(areas)
        .orderBy("area_id", "ring", "pos")
        .select(F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string")).alias("value"))
    )


def feature_lines(areas: DataFrame) -> DataFrame:
    """One line with a GeoJSON FeatureCollection of each area, in order of the areas.

    A part is a ring and its holes again, as the area was given.
    """
    geometry = F.col("feature.geometry")
    parts = F.transform(
        F.array_distinct(geometry["parts"]),
        lambda part: F.filter(geometry["coordinates"], lambda ring, i: F.get(geometry["parts"], i) == part),
    )

    def collection(coordinates: Column) -> Column:
        shape = F.struct(geometry["type"].alias("type"), coordinates.alias("coordinates"))
        one = F.struct(
            F.lit("Feature").alias("type"),
            F.coalesce("feature.properties", F.create_map().cast("map<string,string>")).alias("properties"),
            shape.alias("geometry"),
        )
        return F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(one).alias("features")))

    several = geometry["type"] == "MultiPolygon"
    return (
        areas.where(is_area(F.col("feature")))
        .orderBy("area_id")
        .select(F.when(several, collection(parts)).otherwise(collection(geometry["coordinates"])).alias("value"))
    )


def area_boxes(edges: DataFrame) -> DataFrame:
    """One bounding box per area."""
    return edges.groupBy("area_id").agg(
        F.min(F.least("x1", "x2")).alias("xmin"),
        F.min(F.least("y1", "y2")).alias("ymin"),
        F.max(F.greatest("x1", "x2")).alias("xmax"),
        F.max(F.greatest("y1", "y2")).alias("ymax"),
    )


@dataclass(frozen=True)
class Extent:
    """Box around all areas of a request, and bounds for tables made from them."""

    xmin: float | None
    ymin: float | None
    xmax: float | None
    ymax: float | None
    areas: int
    edges: int
    spans: int
    parts: int = 1
    width: float | None = None
    reach: int = 0
    covered: float = 0.0

    @property
    def empty(self) -> bool:
        return self.areas == 0

    def rows(self, hy: float) -> int:
        """Bound for the rows of a regular grid that the box can reach."""
        return 0 if self.empty else int((self.ymax - self.ymin) / (2 * hy)) + 3

    def spans_in(self, bucket: float) -> int:
        """Bound for the spans when they are cut at buckets of another width."""
        return math.ceil(self.covered / bucket) + 3 * self.reach


def measure(edges: DataFrame, hx: float, hy: float, bucket: float) -> Extent:
    """Box and size bounds of the areas: one small aggregate, one row back.

    ``spans`` bounds the rows of :func:`gridsieve.operators.clip.cell_spans`.
    An edge reaches at most ``height / row distance + 3`` rows, makes at most
    two intervals in each (its own and one between crossings), and an interval
    is cut into at most ``area width / bucket + 2`` pieces.  ``width`` is that of a mean area;
    ``reach`` and ``covered`` are the intervals and their summed widths.
    """
    per_area = (
        edges.groupBy("area_id")
        .agg(
            F.expr("min(least(x1, x2)) AS xmin"),
            F.expr("min(least(y1, y2)) AS ymin"),
            F.expr("max(greatest(x1, x2)) AS xmax"),
            F.expr("max(greatest(y1, y2)) AS ymax"),
            F.expr("count(*) AS edges"),
            F.expr("max(part) + 1 AS parts" if "part" in edges.columns else "1 AS parts"),
            F.expr(f"sum(ceil((abs(y2 - y1) + {2 * hy!r}D) / {2 * hy!r}D) + 3) AS reach"),
        )
    )
    row = per_area.selectExpr(
        "min(xmin) AS xmin", "min(ymin) AS ymin", "max(xmax) AS xmax", "max(ymax) AS ymax",
        "count(*) AS areas", "coalesce(sum(edges), 0) AS edges", "coalesce(max(parts), 1) AS parts",
        f"coalesce(sum(2 * reach * (ceil((xmax - xmin + {2 * hx!r}D) / {bucket!r}D) + 2)), 0) AS spans",
        "avg(xmax - xmin) AS width", "coalesce(sum(2 * reach), 0) AS reach",
        f"coalesce(sum(2 * reach * (xmax - xmin + {2 * hx!r}D)), 0D) AS covered",
    ).first()
    return Extent(**row.asDict())
