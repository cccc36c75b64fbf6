import random
from fractions import Fraction

import pytest
from conftest import SF_GOLDEN
from pyspark.sql import functions as F

import gridsieve as gs
from checks import inputs as inp
from gridsieve.functions.projections import LambertConformal, project

GOLDEN = {  # area: rows, sum of v for bbox, centre, touch
    "A1": ((41794, 1060230), (16398, 417258), (22938, 581947)),
    "A2": ((41237, 1048315), (29187, 740500), (36701, 932176)),
    "A4": ((4618, 115905), (3012, 75759), (4618, 115905)),
    "A3": ((0, None), (0, None), (0, None)),
}


def polygon(*rings):
    return {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [*rings]}}


def square(x, y, w, h):
    return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]


def edges_of(spark, *features):
    return gs.area_edges(gs.areas_from_features(spark, list(enumerate(features))))


def lattice(spark, nx, ny, res=1.0, x0=0.5, y0=0.5):
    return spark.range(nx * ny).select(
        (F.lit(x0) + (F.col("id") % nx) * F.lit(res)).alias("x"),
        (F.lit(y0) + F.floor(F.col("id") / nx) * F.lit(res)).alias("y"),
        F.col("id").alias("v"),
    )


def cells(df):
    return sorted((r["x"], r["y"]) for r in df.select("x", "y").collect())


@pytest.fixture(scope="module")
def golden_cells(spark):
    return inp.grid(spark, SF_GOLDEN).select("x", "y", "time", "v", "w")


@pytest.mark.parametrize("area", GOLDEN)
def test_golden_sums(spark, golden_cells, area):
    edges = inp.edges(spark, area)
    clips = (
        gs.bbox_clip(golden_cells, edges, inp.RES),
        gs.polygon_clip(golden_cells, edges, inp.RES, touches=False),
        gs.polygon_clip(golden_cells, edges, inp.RES, touches=True),
    )
    found = tuple(tuple(c.agg(F.count("*"), F.sum("v")).first()) for c in clips)
    assert found == GOLDEN[area]


@pytest.mark.parametrize("touches", [True, False])
def test_shuffled_lookup_gives_the_same_rows(spark, golden_cells, touches):
    edges = inp.edges(spark, "A1", "A2", "A4")
    small = gs.clip_many(golden_cells, edges, inp.RES, touches)
    large = gs.clip_many(golden_cells, edges, inp.RES, touches, limit=0)
    assert small.count() == large.count()
    assert small.exceptAll(large).isEmpty()
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_rules_are_nested(spark, golden_cells):
    edges = inp.edges(spark, "A2")
    centre = gs.polygon_clip(golden_cells, edges, inp.RES, touches=False)
    touch = gs.polygon_clip(golden_cells, edges, inp.RES)
    box = gs.bbox_clip(golden_cells, edges, inp.RES)
    assert centre.exceptAll(touch).isEmpty()
    assert touch.exceptAll(box).isEmpty()
    assert gs.polygon_clip(touch, edges, inp.RES).count() == touch.count()


def test_one_of_many_areas_equals_its_own_clip(spark, golden_cells):
    many = gs.clip_many(golden_cells, inp.edges(spark, "A1", "A2", "A3", "A4"), inp.RES)
    own = gs.polygon_clip(golden_cells, inp.edges(spark, "A2"), inp.RES)
    part = many.where("area_id = 'A2'").drop("area_id")
    assert part.exceptAll(own).isEmpty() and own.exceptAll(part).isEmpty()


def test_dense_keeps_the_box_and_blanks_the_outside(spark, golden_cells):
    cells_without_gaps = golden_cells.drop("w")
    edges = inp.edges(spark, "A1", "A2")  # they overlap, so a cell may be in both
    dense = gs.polygon_clip(cells_without_gaps, edges, inp.RES, dense=True)
    sparse = gs.polygon_clip(cells_without_gaps, edges, inp.RES)
    assert dense.count() == gs.bbox_clip(cells_without_gaps, edges, inp.RES).count()
    kept = dense.where("v IS NOT NULL")
    assert kept.exceptAll(sparse).isEmpty() and sparse.exceptAll(kept).isEmpty()


def test_area_inside_one_cell(spark):
    grid = lattice(spark, 6, 6)
    off_centre = edges_of(spark, polygon(square(2.1, 3.1, 0.2, 0.2)))
    assert cells(gs.polygon_clip(grid, off_centre, 1.0)) == [(2.5, 3.5)]
    assert cells(gs.polygon_clip(grid, off_centre, 1.0, touches=False)) == []
    on_centre = edges_of(spark, polygon(square(2.4, 3.4, 0.2, 0.2)))
    assert cells(gs.polygon_clip(grid, on_centre, 1.0, touches=False)) == [(2.5, 3.5)]


def test_contact_at_corners_and_sides_counts_as_touch(spark):
    grid = lattice(spark, 6, 6)
    edges = edges_of(spark, polygon(square(2.0, 2.0, 1.0, 1.0)))
    touched = cells(gs.polygon_clip(grid, edges, 1.0))
    assert touched == [(x + 0.5, y + 0.5) for x in (1, 2, 3) for y in (1, 2, 3)]
    assert cells(gs.polygon_clip(grid, edges, 1.0, touches=False)) == [(2.5, 2.5)]


def test_open_ring_is_closed_and_heights_are_ignored(spark):
    grid = lattice(spark, 6, 6)
    closed = edges_of(spark, polygon(square(1.2, 1.2, 3.1, 2.3)))
    ring = [[x, y, 100.0] for x, y in square(1.2, 1.2, 3.1, 2.3)[:-1]]
    opened = edges_of(spark, polygon(ring))
    assert opened.count() == 4
    assert cells(gs.polygon_clip(grid, opened, 1.0)) == cells(gs.polygon_clip(grid, closed, 1.0))


def test_vertex_on_a_row_of_centres(spark):
    grid = lattice(spark, 6, 6)
    diamond = polygon([[3.0, 0.5], [5.5, 2.5], [3.0, 4.5], [0.5, 2.5], [3.0, 0.5]])
    inside = cells(gs.polygon_clip(grid, edges_of(spark, diamond), 1.0, touches=False))
    assert (0.5, 2.5) in inside and (5.5, 2.5) not in inside  # half-open on the right
    assert (2.5, 1.5) in inside


def test_unsupported_geometries_are_refused(spark):
    with pytest.raises(ValueError, match="Polygon"):
        gs.areas_from_features(spark, [(1, {"type": "FeatureCollection", "features": []})])
    point = {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    with pytest.raises(ValueError, match="Polygon"):
        gs.areas_from_features(spark, [(1, point)])


def test_cells_of_different_width_and_height(spark):
    grid = spark.range(200).select(
        ((F.col("id") % 20) * 0.5).alias("x"), (F.floor(F.col("id") / 20) * 2.0).alias("y")
    )
    assert gs.cell_size(grid, "x") == 0.5 and gs.cell_size(grid, "y") == 2.0
    edges = edges_of(spark, polygon(square(2.1, 3.1, 0.6, 0.5)))
    assert cells(gs.polygon_clip(grid, edges, (0.5, 2.0))) == [(2.0, 4.0), (2.5, 4.0)]
    with pytest.raises(ValueError):
        gs.cell_size(grid.where("x = 0"), "x")


def test_given_row_coordinates_save_the_pass_over_the_data(spark, golden_cells):
    rows = spark.range(16).select((F.lit(47) + F.col("id") * 0.25).alias("y"))
    edges = inp.edges(spark, "A1")
    clipped = gs.polygon_clip(golden_cells, edges, inp.RES, rows=rows)
    assert clipped.count() == GOLDEN["A1"][2][0]
    assert clipped._jdf.queryExecution().optimizedPlan().toString().count("l_partkey") > 0


def exact_masks(rings, centres, half):
    """Even-odd and closed contact in exact arithmetic, cell by cell and edge by edge."""
    h = Fraction(half)
    edges = [
        tuple(Fraction(v) for v in (*a, *b)) for ring in rings for a, b in zip(ring, ring[1:], strict=False)
    ]
    inside, touched = set(), set()
    for cx, cy in centres:
        x, y = Fraction(cx), Fraction(cy)
        odd = False
        contact = False
        for x1, y1, x2, y2 in edges:
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
            if max(x1, x2) < x - h or min(x1, x2) > x + h or max(y1, y2) < y - h or min(y1, y2) > y + h:
                continue
            sides = [
                (x2 - x1) * (y + b * h - y1) - (y2 - y1) * (x + a * h - x1) for a in (-1, 1) for b in (-1, 1)
            ]
            if not (all(s > 0 for s in sides) or all(s < 0 for s in sides)):
                contact = True
        if odd:
            inside.add((cx, cy))
        if odd or contact:
            touched.add((cx, cy))
    return inside, touched


@pytest.mark.parametrize("seed", range(6))
def test_random_polygons_against_exact_arithmetic(spark, seed):
    """Self-crossing rings and holes too; coordinates are eighths, so contacts are exact."""
    rng = random.Random(seed)
    rings = []
    for _ in range(rng.choice((1, 1, 2))):
        ring = [[rng.randrange(0, 96) / 8, rng.randrange(0, 96) / 8] for _ in range(rng.randrange(3, 9))]
        rings.append([*ring, ring[0]])
    grid = lattice(spark, 12, 12)
    centres = cells(grid)
    inside, touched = exact_masks(rings, centres, 0.5)
    edges = edges_of(spark, polygon(*rings))
    assert set(cells(gs.polygon_clip(grid, edges, 1.0))) == touched
    assert set(cells(gs.polygon_clip(grid, edges, 1.0, touches=False))) == inside


def test_coordinate_names(spark):
    grid = lattice(spark, 4, 4)
    resolved, status = gs.resolve_coordinates(grid.withColumnsRenamed({"x": "longitude", "y": "latitude"}))
    assert status == "assumed_4326" and set(resolved.columns) == {"x", "y", "v"}
    same, status = gs.resolve_coordinates(grid)
    assert status == "no_crs" and same.columns == grid.columns
    assert gs.resolve_coordinates(grid, crs=3034)[1] == "ok"


def test_unknown_coordinate_system_is_an_error(spark):
    areas = gs.areas_from_features(spark, [(1, inp.feature("A4"))])
    with pytest.raises(ValueError, match="25832"):
        gs.area_edges(areas, 25832)


def test_projection_of_the_origin(spark):
    areas = gs.areas_from_features(spark, [(1, polygon(square(10.0, 52.0, 1.0, 1.0)))])
    first = gs.area_edges(areas, 3034).first()
    # the scale on the origin parallel lies between the two standard parallels, so only
    # the easting is exact there; the northing equals the false northing
    assert first["x1"] == pytest.approx(4_000_000.0, abs=1e-6)
    assert first["y1"] == pytest.approx(2_800_000.0, abs=1e-6)
    mercator = gs.area_edges(areas, 3857).first()
    assert mercator["x1"] == pytest.approx(1113194.9079, abs=1e-3)
    assert mercator["y1"] == pytest.approx(6800125.4544, abs=1e-3)


def test_lambert_conformal_against_a_published_example(spark):
    """Worked example of IOGP Guidance Note 7-2: Texas South Central, in US feet."""
    texas = LambertConformal(
        28 + 23 / 60, 30 + 17 / 60, 27 + 50 / 60, -99.0, 2_000_000.0, 0.0, (20925832.16, 294.97870)
    )
    x, y = project(F.lit(-96.0), F.lit(28.5), texas)
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert row["x"] == pytest.approx(2963503.91, abs=0.02)
    assert row["y"] == pytest.approx(254759.80, abs=0.02)


def test_scattered_rows_are_counted_before_a_broadcast(spark):
    cells = spark.range(20_000).select(
        (F.rand(1) * 10).alias("x"), (F.rand(2) * 10).alias("y"), F.col("id").alias("v")
    ).checkpoint()
    edges = edges_of(spark, polygon(square(2.0, 2.0, 3.0, 3.0)))
    broadcast = gs.polygon_clip(cells, edges, 1.0, False)
    shuffled = gs.polygon_clip(cells, edges, 1.0, False, limit=100)
    # the axis alone has more rows than the limit
    assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
    expected = {r["v"] for r in cells.where("x >= 2 and x < 5 and y > 2 and y <= 5").collect()}
    assert {r["v"] for r in shuffled.collect()} == {r["v"] for r in broadcast.collect()}
    assert len({r["v"] for r in broadcast.collect()} ^ expected) <= 4
