"""Areas of several parts, rows of very different heights, axes with gaps of rounding, packed precedence."""

import json
import random

import pytest
from pyspark.sql import functions as F

import gridsieve as gs
from gridsieve.operators import areas, raster
from test_clip import lattice, polygon, square
from test_raster import pixels_of, tiles_of


def several(*parts):
    coordinates = [polygon(p)["geometry"]["coordinates"] for p in parts]
    return {"type": "Feature", "properties": {"n": "1"}, "geometry": {"type": "MultiPolygon", "coordinates": coordinates}}


@pytest.mark.parametrize("touches", [True, False])
def test_what_two_parts_cover_stays(spark, touches):
    parts = [square(0.2, 0.2, 6.0, 6.0), square(4.2, 4.2, 5.0, 5.0)]
    grid = lattice(spark, 12, 12)

    def cells(*features):
        edges = gs.area_edges(gs.areas_from_features(spark, [(i, f) for i, f in enumerate(features)]))
        return sorted((r["x"], r["y"]) for r in gs.polygon_clip(grid, edges, 1.0, touches).select("x", "y").distinct().collect())

    union = cells(*[polygon(p) for p in parts])
    assert cells(several(*parts)) == union
    assert any(5 < x < 6 and 5 < y < 6 for x, y in union)
    one = gs.area_edges(gs.areas_from_features(spark, [(7, several(*parts))]))
    many = gs.clip_many(grid, one, 1.0, touches)
    assert many.count() == many.distinct().count() == len(union) * (grid.count() // grid.select("x", "y").distinct().count())


def test_geojson_of_areas_comes_back(spark):
    features = [polygon(square(0, 0, 1, 1)), several(square(0, 0, 2, 2), square(1, 1, 2, 2))]
    features[1]["geometry"]["coordinates"][0].append([[0.5, 0.5], [0.7, 0.5], [0.7, 0.7], [0.5, 0.5]])
    rows = gs.areas_from_features(spark, list(enumerate(features)))
    lines = [json.loads(r["value"]) for r in areas.feature_lines(rows).collect()]
    assert [c["type"] for c in lines] == ["FeatureCollection"] * 2
    for line, feature in zip(lines, features):
        (found,) = line["features"]
        assert found["geometry"] == json.loads(json.dumps(feature["geometry"]))
        assert gs.area_edges(gs.areas_from_features(spark, [(0, found)])).count() > 0


def test_masks_of_tiles_of_very_different_resolution(spark):
    tiles = tiles_of(spark, (1, 0.0, 8.0, 1.0, 1.0, 8, 8, None), (2, 0.0, 8.0, 0.0625, 0.0625, 128, 128, None))
    pixels = pixels_of(spark, tiles)
    edges = gs.area_edges(gs.areas_from_features(spark, [(1, polygon(square(1.3, 1.3, 3.0, 3.0)))]))
    for touches in (True, False):
        windows = gs.crop_windows(tiles, gs.area_boxes(edges))
        both = gs.raster_mask(pixels, windows, edges, touches)
        alone = [
            gs.raster_mask(pixels.where(F.col("tile_id") == t), windows.where(F.col("tile_id") == t), edges, touches) for t in (1, 2)
        ]
        assert sorted(map(str, both.collect())) == sorted(str(r) for part in alone for r in part.collect())


def test_gaps_of_rounding_are_no_cell_size(spark):
    axis = spark.range(100).select((F.col("id") * 0.5 + F.when(F.col("id") % 2 == 0, 1e-12).otherwise(0.0)).alias("x"))
    again = spark.range(100).select((F.col("id") * 0.5).alias("x"))
    assert abs(gs.cell_size(axis.unionByName(again), "x") - 0.5) < 1e-9
    with pytest.raises(ValueError, match="no common cell size"):
        gs.cell_size(again.unionByName(spark.sql("SELECT 0.50001 AS x")), "x")


def test_packed_precedence_equals_the_plain_one(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(t, rng.randrange(8) * 0.5, 8 - rng.randrange(8) * 0.5, r, r, 6, 6, None) for t, r in enumerate([1.0, 0.5, 0.25, 0.3, 1.7, 0.5])]
    tiles = tiles_of(spark, *rows)
    pixels = pixels_of(spark, tiles)
    packed = gs.raster_mosaic(pixels, tiles, 0.0, 8.0, 0.75)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    found = sorted(map(str, packed.collect()))
    monkeypatch.setattr(raster, "_DISTANCE_BITS", 64)
    assert sorted(map(str, gs.raster_mosaic(pixels, tiles, 0.0, 8.0, 0.75).collect())) == found
    monkeypatch.undo()
    # ids that are text are ranked
    named = F.format_string("t%02d", "tile_id")
    text = gs.raster_mosaic(pixels.withColumn("tile_id", named), tiles.withColumn("tile_id", named), 0.0, 8.0, 0.75)
    assert sorted(map(str, text.collect())) == found


def test_flags_that_cannot_be_read_make_a_request_invalid(spark):
    flags = ["true", "false", '"yes"', "0", '"maybe"', "2", "null", "[]"]
    docs = [(i, f'{{"t": {{"parameters": {{"dataset_ids": [1], "cell_touches": {f}}}}}}}') for i, f in enumerate(flags)]
    found = gs.parse_requests(spark.createDataFrame(docs, "i INT, doc STRING"), "doc").orderBy("i").collect()
    assert [(r["valid"], r["cell_touches"]) for r in found] == [
        (True, True), (True, False), (True, True), (True, False), (False, True), (False, True), (True, True), (False, True),
    ]
