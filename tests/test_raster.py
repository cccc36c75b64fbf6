import random

import pytest
from pyspark.sql import functions as F

import gridsieve as gs
from test_clip import edges_of, exact_masks, polygon, square

TILES = "tile_id BIGINT, x0 DOUBLE, y0 DOUBLE, res_x DOUBLE, res_y DOUBLE, width BIGINT, height BIGINT, nodata DOUBLE"


def tiles_of(spark, *rows):
    return spark.createDataFrame(rows, TILES)


def pixels_of(spark, tiles):
    """Every pixel of every tile, its value telling where it is."""
    return (
        tiles.select("tile_id", "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("row"))
        .select("tile_id", "row", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("col"))
        .select("tile_id", "row", "col", (F.col("tile_id") * 10_000 + F.col("row") * 100 + F.col("col")).cast("double").alias("value"))
    )


@pytest.fixture
def four(spark):
    return tiles_of(
        spark,
        (1, 0.0, 8.0, 1.0, 1.0, 8, 8, None), (2, 8.0, 8.0, 1.0, 1.0, 8, 8, -1.0),
        (3, 0.0, 16.0, 1.0, 1.0, 8, 8, None), (4, 8.0, 16.0, 0.5, 0.5, 16, 16, None),
    )


def windows_of(tiles, edges):
    return gs.crop_windows(tiles, gs.area_boxes(edges))


def test_windows_cover_the_box(spark, four):
    edges = edges_of(spark, polygon(square(6.5, 2.25, 4.0, 3.0)))
    found = {
        r["tile_id"]: (r["row_off"], r["col_off"], r["new_height"], r["new_width"], r["new_x0"], r["new_y0"])
        for r in windows_of(four, edges).collect()
    }
    # box x 6.5..10.5, y 2.25..5.25; rows are counted from the top
    assert found == {1: (2, 6, 4, 2, 6.0, 6.0), 2: (2, 0, 4, 3, 8.0, 6.0)}


def test_tiles_that_only_touch_the_box_are_skipped(spark, four):
    exact = edges_of(spark, polygon(square(0.0, 0.0, 8.0, 8.0)))
    assert [r["tile_id"] for r in gs.skip_tiles(four, gs.area_boxes(exact)).collect()] == [1]
    away = edges_of(spark, polygon(square(100.0, 0.0, 1.0, 1.0)))
    assert gs.skip_tiles(four, gs.area_boxes(away)).count() == 0
    assert gs.raster_mask(pixels_of(spark, four), windows_of(four, away), away).count() == 0


@pytest.mark.parametrize("touches", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_masks_of_many_areas_against_exact_arithmetic(spark, four, seed, touches):
    rng = random.Random(seed)
    shapes = []
    for _ in range(3):
        ring = [[rng.randrange(0, 128) / 8, rng.randrange(0, 128) / 8] for _ in range(rng.randrange(3, 7))]
        shapes.append([*ring, ring[0]])
    edges = edges_of(spark, *[polygon(s) for s in shapes])
    pixels = pixels_of(spark, four)
    windows = windows_of(four, edges)
    masks = [
        gs.raster_mask(pixels, windows, edges, touches, limit=limit) for limit in (1_000_000, 0)
    ]
    assert masks[0].exceptAll(masks[1]).isEmpty() and masks[0].count() == masks[1].count()
    corner = {(r["area_id"], r["tile_id"]): (r["row_off"], r["col_off"]) for r in windows.collect()}
    tile = {r["tile_id"]: r for r in four.collect()}
    found = {}
    for r in masks[0].collect():
        row_off, col_off = corner[r["area_id"], r["tile_id"]]
        t = tile[r["tile_id"]]
        centre = (
            t["x0"] + (r["col"] + col_off + 0.5) * t["res_x"], t["y0"] - (r["row"] + row_off + 0.5) * t["res_y"],
        )
        fill = -9999.0 if t["nodata"] is None else t["nodata"]
        found.setdefault((r["area_id"], t["res_x"]), {})[centre] = r["value"] != fill
    assert found
    for (area, res), kept in found.items():
        inside, touched = exact_masks([shapes[area]], kept, res / 2)
        assert {c for c, keep in kept.items() if keep} == (touched if touches else inside)


def test_crop_counts_from_the_corner(spark, four):
    edges = edges_of(spark, polygon(square(6.5, 2.25, 4.0, 3.0)))
    for limit in (1_000_000, 0):
        cropped = gs.raster_crop(pixels_of(spark, four), windows_of(four, edges), limit=limit)
        assert cropped.groupBy("tile_id").count().orderBy("tile_id").collect() == [(1, 8), (2, 12)]
        first = cropped.where("tile_id = 1 AND row = 0 AND col = 0").first()
        assert first["value"] == 10_206.0


def test_tile_without_data_stays_without_data(spark):
    tiles = tiles_of(spark, (1, 0.0, 4.0, 1.0, 1.0, 4, 4, None))
    pixels = pixels_of(spark, tiles).withColumn("value", F.lit(-9999.0))
    edges = edges_of(spark, polygon(square(1.0, 1.0, 2.0, 2.0)))
    mask = gs.raster_mask(pixels, windows_of(tiles, edges), edges)
    assert [r["value"] for r in mask.select("value").distinct().collect()] == [-9999.0]
    assert gs.raster_mosaic(pixels, tiles, 0.0, 4.0, 1.0).count() == 0


def test_mosaic_prefers_the_nearest_then_the_lowest_tile(spark):
    tiles = tiles_of(
        spark, (2, 0.0, 2.0, 1.0, 1.0, 2, 2, None), (1, 1.0, 2.0, 1.0, 1.0, 2, 2, None), (0, 0.25, 2.0, 1.0, 1.0, 1, 1, None)
    )
    pixels = pixels_of(spark, tiles)
    mosaics = [
        gs.raster_mosaic(p, tiles, 0.0, 2.0, 1.0).orderBy("grow", "gcol").collect()
        for p in (pixels, pixels.orderBy(F.col("value").desc()), pixels.repartition(5))
    ]
    assert mosaics[0] == mosaics[1] == mosaics[2]
    values = {(r["grow"], r["gcol"]): r["value"] for r in mosaics[0]}
    assert values == {
        (0, 0): 20_000.0, (1, 0): 20_100.0, (0, 1): 10_000.0, (1, 1): 10_100.0, (0, 2): 10_001.0, (1, 2): 10_101.0,
    }


def test_extent_and_its_text(spark, four):
    extent = gs.tile_extent(four)
    assert tuple(extent.first()) == (0.0, 0.0, 16.0, 16.0)
    text = gs.extent_wkt(extent).first()
    assert text["extent"] == "POLYGON((0.0 0.0, 16.0 0.0, 16.0 16.0, 0.0 16.0, 0.0 0.0))"
    assert text["location"] == "POINT (8.0 8.0)"


def test_bands_stay_apart(spark, four):
    plain = pixels_of(spark, four)
    bands = plain.withColumn("band", F.lit(1)).unionByName(
        plain.withColumn("band", F.lit(2)).withColumn("value", F.col("value") + 0.5)
    )
    edges = edges_of(spark, polygon(square(6.5, 2.25, 4.0, 3.0)))
    windows = windows_of(four, edges)
    for frame in (gs.raster_crop, lambda p, w: gs.raster_mask(p, w, edges)):
        one = {tuple(r) for r in frame(plain, windows).select("area_id", "tile_id", "row", "col", "value").collect()}
        two = frame(bands, windows)
        assert two.where("band = 1").count() == two.where("band = 2").count() == len(one)
        assert {tuple(r) for r in two.where("band = 1").select("area_id", "tile_id", "row", "col", "value").collect()} == one
    once = gs.raster_mosaic(plain, four, 0.0, 16.0, 1.0)
    both = gs.raster_mosaic(bands, four, 0.0, 16.0, 1.0)
    assert both.where("band = 1").drop("band").exceptAll(once).count() == 0
    assert both.where("band = 2").select("grow", "gcol", (F.col("value") - 0.5).alias("value")).exceptAll(once).count() == 0
    assert both.count() == 2 * once.count()


@pytest.mark.parametrize("x0, res", [(0.0, 1.0), (0.5, 1.0), (0.25, 0.7), (0.1, 0.1), (-3.3, 2.5)])
def test_mosaic_groups_whatever_may_share_a_cell(spark, x0, res):
    import math

    tiles = tiles_of(
        spark,
        (1, 0.0, 4.0, 1.0, 1.0, 4, 4, None), (2, 4.0, 4.0, 1.0, 1.0, 4, 4, None), (3, 20.0, 4.0, 1.0, 1.0, 4, 4, None),
        (4, 3.5, 3.5, 0.5, 0.5, 8, 6, None), (5, 40.0, 4.0, 0.1, 0.1, 20, 20, None),
    )
    pixels = pixels_of(spark, tiles)
    shape = {t["tile_id"]: t for t in tiles.collect()}
    best = {}
    for p in pixels.collect():
        t = shape[p["tile_id"]]
        x, y = t["x0"] + (p["col"] + 0.5) * t["res_x"], t["y0"] - (p["row"] + 0.5) * t["res_y"]
        cell = math.floor((16.0 - y) / res), math.floor((x - x0) / res)
        far = (x - (x0 + (cell[1] + 0.5) * res)) ** 2 + (y - (16.0 - (cell[0] + 0.5) * res)) ** 2
        best.setdefault(cell, []).append((far, p["tile_id"], p["row"], p["col"], p["value"]))
    found = gs.raster_mosaic(pixels, tiles, x0, 16.0, res).collect()
    assert len(found) == len(best)
    assert {(r["grow"], r["gcol"]): r["value"] for r in found} == {c: min(v)[4] for c, v in best.items()}
