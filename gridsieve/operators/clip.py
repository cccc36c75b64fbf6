"""Box and polygon clips of long-form grid cells ``(time, y, x, values...)``.

A polygon meets one row of cells in a few x-intervals.  These *spans* depend on
the polygon and the row coordinate only, so they are worked out once per row
(thousands) instead of once per cell and time step (billions), and the clip of
the data becomes an equi-join on the row and an x-bucket with a range test.

Centre rule: a cell is kept when its centre is inside by the even-odd rule over
all rings, half-open at the right of each interval, so holes drop out.
Touch rule: a cell is kept when its centre is inside or an edge meets the
closed cell rectangle.  An edge cut to the height of a cell row is a segment;
it meets the rectangle exactly when its x-range meets the rectangle's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridsieve.operators.areas import Extent, measure
from gridsieve.operators.timeclip import time_slots, within
from gridsieve.scale import BROADCAST_ROW_LIMIT, dealt_join, lookup_join, materialise

# Cell rectangles are grown by a billionth, so that an edge that meets a cell only
# at a corner or along its side counts as contact whatever the rounding.
CONTACT = 1.0 + 1e-9

# Parts of the mean gap between coordinates: below the first a gap is one of rounding, below the
# second the axis has no common cell size.
ROUNDING_GAP = 1e-6
IRREGULAR_GAP = 1e-4

# Largest width of an x-bucket in cells.  A span is repeated once per bucket it covers,
# and a data row only meets the areas that reach its bucket.
BUCKET_CELLS = 64


def cell_size(df: DataFrame, column: str) -> float:
    """Smallest gap between the distinct coordinates of a column, but for gaps of rounding.

    Only for a regular axis whose size is unknown.  Gaps below a millionth of the mean gap are
    one coordinate that was worked out in two ways.  An axis on which the smallest gap is less than
    a ten-thousandth of the mean one is refused, as its cells have no common size.  The distinct values
    are range-partitioned, so only the values at partition borders meet in one task.
    """
    axis = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v")).distinct()
    placed = axis.repartitionByRange("v").withColumn("slot", F.spark_partition_id())
    inside = placed.select(
        "slot", "v", (F.lead("v").over(Window.partitionBy("slot").orderBy("v")) - F.col("v")).alias("gap")
    )
    # written once, as the mean gap has to be known first
    inside = materialise(inside)
    known = inside.agg(F.count("*").alias("n"), (F.max("v") - F.min("v")).alias("width")).first()
    if known["n"] < 2:
        raise ValueError(f"{column} has fewer than two distinct values; give the cell size")
    mean = float(known["width"]) / (known["n"] - 1)
    gap = F.when(F.col("gap") > mean * ROUNDING_GAP, F.col("gap"))
    per_slot = inside.groupBy("slot").agg(
        F.min(gap).alias("gap"), F.count(gap).alias("gaps"), F.min("v").alias("first"), F.max("v").alias("last")
    )
    # one row per partition
    across = F.lead("first").over(Window.orderBy("slot")) - F.col("last")
    apart = F.when(across > mean * ROUNDING_GAP, across)
    row = per_slot.select(F.least("gap", apart).alias("gap"), (F.col("gaps") + apart.isNotNull().cast("long")).alias("gaps")).agg(
        F.min("gap").alias("gap"), F.sum("gaps").alias("gaps")
    ).first()
    # the mean over the gaps that are none of rounding
    if row["gap"] < float(known["width"]) / row["gaps"] * IRREGULAR_GAP:
        raise ValueError(f"{column} has no common cell size (a gap of {row['gap']}); give the cell size")
    return float(row["gap"])


def _sizes(res: float | tuple[float, float]) -> tuple[float, float]:
    """Half cell sizes."""
    res_x, res_y = res if isinstance(res, tuple) else (res, res)
    if not (res_x > 0 and res_y > 0):
        raise ValueError("cell sizes must be positive")
    return res_x / 2.0 * CONTACT, res_y / 2.0 * CONTACT


def row_spans(
    rows: DataFrame,
    edges: DataFrame,
    keys: Sequence[str],
    band: float | Sequence[float],
    touches: bool,
    n_rows: int,
    limit: int = BROADCAST_ROW_LIMIT,
    several_parts: bool = True,
) -> DataFrame:
    """Disjoint intervals ``(area_id, *keys, lo, hi)`` of kept cell centres per row.

    ``rows`` holds one line per row of cells: ``keys`` identify it, ``row_y`` is
    its centre, ``hx`` and ``hy`` are half cell sizes.  A column ``area_id`` in it
    ties a row to one area; without it a row is tested against all areas.  Rows and edges are matched
    through horizontal bands of height ``band``; an edge is listed only in the
    bands it reaches, so the matches are about as many as the answer needs.  Several heights
    may be given for rows of very different cells, which then have their own in ``band_height``.
    ``n_rows`` bounds the number of rows.  Inside is counted part by part, and the
    intervals of all parts are merged (``several_parts`` tells whether an area has more than one).
    """
    heights = [band] if isinstance(band, float) else list(band)
    part = "part" if "part" in edges.columns else "0 AS part"
    # an edge reaches the rows whose cells it meets; the small pad covers rounding at
    # a band border, and the exact test follows
    grow = "band_height / 2" if touches else "0D"
    listed = ", ".join(f"{h!r}D" for h in heights)
    banded_edges = edges.selectExpr(
        "area_id", part, "x1", "y1", "x2", "y2", f"explode(array({listed})) AS band_height"
    ).selectExpr(
        "*",
        f"explode(sequence(floor((least(y1, y2) - {grow}) / band_height - 1e-6D), "
        f"floor((greatest(y1, y2) + {grow}) / band_height + 1e-6D))) AS band",
    )
    if isinstance(band, float):
        rows = rows.withColumn("band_height", F.lit(band))
    banded_rows = rows.selectExpr("*", "floor(row_y / band_height) AS band")
    on = ["band_height", "band", *(["area_id"] if "area_id" in rows.columns else [])]
    keys = [k for k in keys if k != "area_id"]
    group = ["area_id", *keys]
    window = "PARTITION BY " + ", ".join(f"`{g}`" for g in [*group, "part"])
    crosses = "(y1 > row_y) <> (y2 > row_y)"
    near = "row_y - hy <= greatest(y1, y2) AND row_y + hy >= least(y1, y2)"
    pairs = lookup_join(
        banded_edges, banded_rows, on, "inner", n_rows, F.expr(near if touches else crosses), limit
    )
    # where the edge crosses the row centre, and the order of the crossings
    cross = f"CASE WHEN {crosses} THEN {_x_at('row_y')} END AS cross"
    order = (
        f"row_number() OVER ({window} ORDER BY cross ASC NULLS LAST) AS nth",
        f"lead(cross) OVER ({window} ORDER BY cross ASC NULLS LAST) AS next_cross",
    )
    opens = "cross IS NOT NULL AND nth % 2 = 1 AND next_cross > cross"
    if not touches:
        inside = (
            pairs.selectExpr(*group, "part", cross)
            .selectExpr(*group, "part", "cross", *order)
            .where(opens)
            .selectExpr(*group, "cross AS lo", "next_cross AS hi")
        )
        return merge_spans(inside, group) if several_parts else inside
    # the x-range of the edge where it passes the height of the row
    reach = pairs.selectExpr(
        *group, "part", "hx", cross,
        "least(x1, x2) AS x_min", "greatest(x1, x2) AS x_max", "y1 = y2 AS flat",
        "greatest(row_y - hy, least(y1, y2)) AS bottom", "least(row_y + hy, greatest(y1, y2)) AS top",
        f"{_x_at('bottom')} AS x_bottom", f"{_x_at('top')} AS x_top",
    ).selectExpr(
        *group, "part", "cross",
        "if(flat, x_min, greatest(least(x_bottom, x_top), x_min)) - hx AS left_x",
        "if(flat, x_max, least(greatest(x_bottom, x_top), x_max)) + hx AS right_x",
    )
    # the edge's own interval, and the inside interval that starts at its crossing
    parts = reach.selectExpr(*group, "part", "cross", "left_x", "right_x", *order).selectExpr(
        *group,
        f"inline(CASE WHEN {opens} "
        "THEN array(struct(left_x AS lo, right_x AS hi), struct(cross AS lo, next_cross AS hi)) "
        "ELSE array(struct(left_x AS lo, right_x AS hi)) END)",
    )
    return merge_spans(parts, group)


def _x_at(height: str) -> str:
    """x of an edge ``x1, y1, x2, y2`` at a height, exact at both ends."""
    return (
        f"CASE WHEN {height} = y1 THEN x1 WHEN {height} = y2 THEN x2 "
        f"ELSE (x2 - x1) * ({height} - y1) / nullif(y2 - y1, 0D) + x1 END"
    )


def merge_spans(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Merge overlapping intervals per group, so that a cell meets at most one."""
    window = "PARTITION BY " + ", ".join(f"`{g}`" for g in group) + " ORDER BY lo, hi"
    return (
        parts.selectExpr(
            "*",
            f"max(hi) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached",
        )
        .selectExpr(
            *group, "lo", "hi",
            f"sum(if(lo <= reached, 0, 1)) OVER ({window} ROWS UNBOUNDED PRECEDING) AS island",
        )
        .groupBy(*group, "island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("island")
    )


def bucket_width(hx: float) -> float:
    return 2.0 * hx * BUCKET_CELLS


def fitting_bucket(extent: Extent, hx: float) -> float:
    """A bucket as wide as a mean area: spans lie in few buckets, and a data row meets few that miss it."""
    if extent.empty:
        return bucket_width(hx)
    return 2.0 * hx * max(1, math.ceil(min(extent.width / (2.0 * hx) + 1.0, BUCKET_CELLS)))


def in_box(extent: Extent, hx: float, hy: float, x: str = "x", y: str = "y") -> Column:
    """Cells whose rectangle meets the box: four range tests on plain columns."""
    if extent.empty:
        return F.lit(False)
    return (
        (F.col(x) >= extent.xmin - hx)
        & (F.col(x) <= extent.xmax + hx)
        & (F.col(y) >= extent.ymin - hy)
        & (F.col(y) <= extent.ymax + hy)
    )


def bbox_clip(df: DataFrame, edges: DataFrame, res, x: str = "x", y: str = "y") -> DataFrame:
    """Cells that meet the bounding box around the area."""
    hx, hy = _sizes(res)
    return df.where(in_box(measure(edges, hx, hy, bucket_width(hx)), hx, hy, x, y))


def cell_spans(
    rows: DataFrame,
    edges: DataFrame,
    hx: float,
    hy: float,
    touches: bool,
    n_rows: int,
    limit: int = BROADCAST_ROW_LIMIT,
    several_parts: bool = True,
    width: float | None = None,
) -> DataFrame:
    """Spans ``(area_id, row_y, bucket, lo, hi)`` for distinct row coordinates ``row_y``."""
    sized = rows.select("row_y", F.lit(hx).alias("hx"), F.lit(hy).alias("hy"))
    spans = row_spans(sized, edges, ["row_y"], 2.0 * hy, touches, n_rows, limit, several_parts)
    width = width or bucket_width(hx)
    buckets = f"explode(sequence(floor(lo / {width!r}D), floor(hi / {width!r}D))) AS bucket"
    return spans.selectExpr("*", buckets)


def _clip_join(
    df: DataFrame,
    edges: DataFrame,
    res,
    touches: bool,
    how: str,
    x: str,
    y: str,
    rows: DataFrame | None,
    limit: int,
    ranges: tuple[DataFrame, Column] | None = None,
    dealt: bool = False,
) -> DataFrame:
    hx, hy = _sizes(res)
    extent = measure(edges, hx, hy, bucket_width(hx))
    width = fitting_bucket(extent, hx)
    boxed = df.where(in_box(extent, hx, hy, x, y))
    # given rows take the type of the data, so that equal coordinates are equal keys
    axis = (boxed if rows is None else rows).select(
        F.col(y).cast(df.schema[y].dataType).alias("row_y")
    ).distinct()
    # scattered coordinates have more rows than a regular grid in the box, so they are counted
    axis = materialise(axis)
    n_rows = axis.count()
    spans = cell_spans(axis, edges, hx, hy, touches, n_rows, limit, extent.parts > 1, width)
    n_spans = extent.spans_in(width)
    keys = ["row_y", "bucket"]
    if how != "inner":
        spans = spans.drop("area_id")
    if how == "left_outer" and extent.areas > 1:
        # several areas may hold the same cell, which must come out once
        spans = merge_spans(spans.distinct(), ["row_y", "bucket"])
    keyed = boxed.select("*", F.col(y).alias("row_y"), F.floor(F.col(x) / F.lit(width)).alias("bucket"))
    inside = (F.col(x) >= F.col("lo")) & (F.col(x) <= F.col("hi") if touches else F.col(x) < F.col("hi"))
    if ranges is not None:
        # each area has a time range of its own, which its spans carry into the slots of time it meets
        bounds, micros = ranges
        keyed = keyed.withColumn("__micros", micros)
        slots = time_slots(keyed, "__micros", bounds)
        keyed = keyed.withColumn("__slot", slots.of("__micros"))
        listed = slots.listed(bounds, "__slot")
        spans = lookup_join(spans, listed, ["area_id"], "inner", listed.count(), limit=limit)
        n_spans *= slots.last + 2
        keys.insert(0, "__slot")
        inside = inside & within("__micros")
    if dealt:
        joined = dealt_join(keyed, materialise(spans), keys, "area_id", inside, limit)
        return joined.drop("row_y", "bucket", "__micros", "__slot")
    if n_spans > limit or n_rows > extent.rows(hy):
        # the bound holds for a regular axis, and is loose for many small areas
        spans = materialise(spans)
        n_spans = spans.count()
    joined = lookup_join(keyed, spans, keys, how, n_spans, inside, limit)
    return joined.drop("row_y", "bucket", "__micros", "__slot")


def polygon_clip(
    df: DataFrame,
    edges: DataFrame,
    res: float | tuple[float, float],
    touches: bool = True,
    dense: bool = False,
    values: Sequence[str] | None = None,
    x: str = "x",
    y: str = "y",
    rows: DataFrame | None = None,
    limit: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Cells inside the union of the areas in ``edges``.

    ``dense`` keeps every cell of the bounding box and sets ``values`` (by
    default every column but coordinates and time) to null outside the area.
    ``rows`` may name a table of the grid's row coordinates (column ``y``); without
    it they are read from the data, one column in a pass of its own.
    """
    if not dense:
        return _clip_join(df, edges, res, touches, "left_semi", x, y, rows, limit)
    if values is None:
        values = [c for c in df.columns if c not in (x, y, "time")]
    joined = _clip_join(df, edges, res, touches, "left_outer", x, y, rows, limit)
    return joined.select(
        *[
            F.when(F.col("lo").isNotNull(), F.col(c)).alias(c) if c in values else F.col(c)
            for c in df.columns
        ]
    )


def clip_many(
    df: DataFrame,
    edges: DataFrame,
    res: float | tuple[float, float],
    touches: bool = True,
    x: str = "x",
    y: str = "y",
    rows: DataFrame | None = None,
    limit: int = BROADCAST_ROW_LIMIT,
    ranges: tuple[DataFrame, Column] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """All areas in one pass: each cell row once per area it belongs to.

    ``ranges`` gives every area a time range: a table ``(area_id, since, until)`` in microseconds,
    null for open ends, and the time of a row in microseconds.  ``dealt`` puts the rows of an
    area together, without a shuffle of them, for a write of a folder for each area.
    """
    joined = _clip_join(df, edges, res, touches, "inner", x, y, rows, limit, ranges, dealt)
    return joined.select("area_id", *df.columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long form without rows that have a null in any of the columns."""
    chosen = df if columns is None else df.select(*columns)
    return chosen.na.drop(how="any")


# Names of latitude and longitude columns taken as EPSG:4326.
LAT_LON_NAMES = (("latitudes", "longitudes"), ("latitude", "longitude"), ("lat", "lon"))


# Names of columns along x, besides those of longitudes.
X_NAMES = ("x", "lon", "longitude", "longitudes", "rlon", "easting", "projection_x_coordinate")


def coordinate_names(
    columns: Sequence[str], crs: int | None, space: Sequence[str] | None = None
) -> tuple[str, str, str]:
    """Names of the x and y columns, and a status.

    With a known system they are ``x`` and ``y``, else the two columns that the catalog
    names as ``space`` (by known names, else x first), else a latitude/longitude pair
    (status ``ok``).  Without a system a latitude/longitude pair is taken as EPSG:4326
    (status ``assumed_4326``); with no such pair the data must be left unclipped
    (status ``no_crs``).
    """
    if crs is not None:
        named = [c for c in dict.fromkeys(space or ()) if c in columns]
        if "x" in columns and "y" in columns:
            return "x", "y", "ok"
        if len(named) == 2:
            x, y = named if named[1].lower() not in X_NAMES else named[::-1]
            return x, y, "ok"
        for lat, lon in LAT_LON_NAMES:
            if lat in columns and lon in columns:
                return lon, lat, "ok"
        return "x", "y", "ok"
    for lat, lon in LAT_LON_NAMES:
        if lat in columns and lon in columns:
            return lon, lat, "assumed_4326"
    return "x", "y", "no_crs"


def resolve_coordinates(df: DataFrame, crs: int | None = None) -> tuple[DataFrame, str]:
    """The frame with its coordinate columns named ``x`` and ``y``, and the status."""
    x, y, status = coordinate_names(df.columns, crs)
    if status == "assumed_4326":
        shadowed = [c for c in ("x", "y") if c in df.columns]
        df = df.drop(*shadowed).withColumnsRenamed({x: "x", y: "y"})
    return df, status
