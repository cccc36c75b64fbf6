"""Raster tiles as pixel rows: positions, skip, crop, mask, mosaic, extent.

A tile table has ``tile_id, x0, y0, res_x, res_y, width, height, nodata`` with the
origin at the upper left corner.  A pixel table has ``tile_id, row, col, value`` and, for
several bands, ``band``; a band is carried through every operator.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from gridsieve.operators.clip import CONTACT, row_spans
from gridsieve.scale import BROADCAST_ROW_LIMIT, lookup_join, materialise, number_in_order

# Fixed value: marks masked pixels of a tile that names no value of its own.
DEFAULT_NODATA = -9999.0

# Side of the pixel blocks by which crop windows are looked up.
BLOCK_PIXELS = 64

_GEOMETRY = ("x0", "y0", "res_x", "res_y")


def pixel_x(col: Column) -> Column:
    return F.col("x0") + (col + F.lit(0.5)) * F.col("res_x")


def pixel_y(row: Column) -> Column:
    return F.col("y0") - (row + F.lit(0.5)) * F.col("res_y")


def pixel_positions(
    pixels: DataFrame, tiles: DataFrame, limit: int = BROADCAST_ROW_LIMIT
) -> DataFrame:
    """Pixels with the coordinates of their centres."""
    described = tiles.select("tile_id", *_GEOMETRY)
    joined = lookup_join(pixels, described, ["tile_id"], "inner", tiles.count(), limit=limit)
    return joined.select(
        *pixels.columns, pixel_x(F.col("col")).alias("x"), pixel_y(F.col("row")).alias("y")
    )


def crop_windows(
    tiles: DataFrame, boxes: DataFrame, limit: int = BROADCAST_ROW_LIMIT
) -> DataFrame:
    """The part of each tile that covers an area's box, for tiles that overlap it.

    Adds ``area_id``, the first row and column, the new size and origin.  Tiles
    that only touch or miss the box have no row.  Tiles and boxes meet through
    lattice cells as large as the largest tile.
    """
    known = tiles.agg(
        F.expr("coalesce(max(greatest(width * res_x, height * res_y)), 1D) AS size"),
        F.count("*").alias("n"),
    ).first()

    def cells(low: str, high: str) -> str:
        return f"explode(sequence(floor({low} / {known['size']!r}D), floor({high} / {known['size']!r}D)))"

    sided = tiles.selectExpr("*", "x0 + width * res_x AS x_right", "y0 - height * res_y AS y_bottom")
    placed_tiles = sided.selectExpr("*", f"{cells('x0', 'x_right')} AS gx").selectExpr(
        "*", f"{cells('y_bottom', 'y0')} AS gy"
    )
    placed_boxes = boxes.selectExpr("*", f"{cells('xmin', 'xmax')} AS gx").selectExpr(
        "*", f"{cells('ymin', 'ymax')} AS gy"
    )
    overlap = "xmax > x0 AND xmin < x_right AND ymax > y_bottom AND ymin < y0"
    # a pair counts in the one lattice cell that holds the lower left corner of its overlap
    corner = (
        f"gx = floor(greatest(x0, xmin) / {known['size']!r}D) "
        f"AND gy = floor(greatest(y_bottom, ymin) / {known['size']!r}D)"
    )
    # a tile is no larger than a lattice cell, so it lies in at most four of them
    met = lookup_join(
        placed_boxes, placed_tiles, ["gx", "gy"], "inner", 4 * known["n"],
        F.expr(f"{overlap} AND {corner}"), limit,
    )
    sized = met.selectExpr(
        "*",
        "greatest(floor((y0 - ymax) / res_y), 0L) AS row_off",
        "greatest(floor((xmin - x0) / res_x), 0L) AS col_off",
        "least(ceil((y0 - ymin) / res_y), CAST(height AS BIGINT)) AS row_stop",
        "least(ceil((xmax - x0) / res_x), CAST(width AS BIGINT)) AS col_stop",
    )
    return sized.selectExpr(
        "area_id",
        *[f"`{c}`" for c in tiles.columns],
        "row_off",
        "col_off",
        "row_stop - row_off AS new_height",
        "col_stop - col_off AS new_width",
        "x0 + col_off * res_x AS new_x0",
        "y0 - row_off * res_y AS new_y0",
    )


def cropped_tiles(windows: DataFrame) -> DataFrame:
    """Tile table of cropped pixels, whose rows and columns count from the corner of the crop."""
    return windows.select(
        "tile_id",
        F.col("new_x0").alias("x0"),
        F.col("new_y0").alias("y0"),
        "res_x",
        "res_y",
        F.col("new_width").alias("width"),
        F.col("new_height").alias("height"),
        F.coalesce("nodata", F.lit(DEFAULT_NODATA)).alias("nodata"),
    )


def skip_tiles(tiles: DataFrame, boxes: DataFrame) -> DataFrame:
    """Tiles that overlap the box of an area, once per area."""
    return crop_windows(tiles, boxes).select("area_id", *tiles.columns)


_WINDOW = ("row_off", "col_off", "new_height", "new_width", "new_x0", "new_y0")


def _block_bound(windows: DataFrame) -> int:
    """At most as many blocks of pixels as the windows lie in, counted window by window."""
    block = F.lit(BLOCK_PIXELS)
    per_window = (F.ceil(F.col("new_height") / block) + 1) * (F.ceil(F.col("new_width") / block) + 1)
    return windows.agg(F.coalesce(F.sum(per_window), F.lit(0)).alias("n")).first()["n"]


def _in_windows(
    pixels: DataFrame, windows: DataFrame, limit: int, how: str = "inner", bound: int | None = None
) -> DataFrame:
    """Pixels paired with the crop windows that hold them.

    Windows are listed per square block of pixels, so a pixel is tested against
    the areas near it and not against every area that meets its tile.
    """
    block = F.lit(BLOCK_PIXELS)

    def blocks(start: str, length: str) -> Column:
        return F.explode(
            F.sequence(
                F.floor(F.col(start) / block),
                F.floor((F.col(start) + F.col(length) - 1) / block),
            )
        )

    if bound is None:
        bound = _block_bound(windows)
    listed = windows.withColumn("block_row", blocks("row_off", "new_height")).withColumn(
        "block_col", blocks("col_off", "new_width")
    )
    inside = (
        (F.col("row") >= F.col("row_off"))
        & (F.col("row") < F.col("row_off") + F.col("new_height"))
        & (F.col("col") >= F.col("col_off"))
        & (F.col("col") < F.col("col_off") + F.col("new_width"))
    )
    keyed = pixels.withColumn("block_row", F.floor(F.col("row") / block)).withColumn(
        "block_col", F.floor(F.col("col") / block)
    )
    keys = ["tile_id", "block_row", "block_col"]
    return lookup_join(keyed, listed, keys, how, bound, inside, limit).drop(*keys[1:])


def _bands(pixels: DataFrame) -> list[str]:
    return ["band"] if "band" in pixels.columns else []


def _from_corner() -> list[Column]:
    return [
        (F.col("row") - F.col("row_off")).cast("long").alias("row"),
        (F.col("col") - F.col("col_off")).cast("long").alias("col"),
    ]


def raster_crop(
    pixels: DataFrame, windows: DataFrame, limit: int = BROADCAST_ROW_LIMIT
) -> DataFrame:
    """Pixels of each crop window, with rows and columns counted from its corner."""
    joined = _in_windows(pixels, windows.select("tile_id", "area_id", *_WINDOW), limit)
    return joined.select("area_id", "tile_id", *_bands(pixels), *_from_corner(), "value")


def _band_height() -> Column:
    """The power of two that is at least the height of a row, with its allowance for contact."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(F.col("res_y") * CONTACT)))


def raster_mask(
    pixels: DataFrame,
    windows: DataFrame,
    edges: DataFrame,
    touches: bool = True,
    limit: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Cropped pixels; those outside the area carry the tile's nodata value.

    Kept column intervals are worked out per tile row from the tile table alone,
    so the pixels are read once and joined on ``(area, tile, row)``.
    """
    last_row = F.col("row_off") + F.col("new_height") - 1
    rows = windows.withColumn("row", F.explode(F.sequence(F.col("row_off"), last_row))).select(
        "area_id",
        "tile_id",
        "row",
        pixel_y(F.col("row")).alias("row_y"),
        (F.col("res_x") / 2 * CONTACT).alias("hx"),
        (F.col("res_y") / 2 * CONTACT).alias("hy"),
        _band_height().alias("band_height"),
    )
    # bands as high as the next power of two of a row, so edges are cut once for each size class of rows
    known = windows.agg(
        F.sort_array(F.collect_set(_band_height())).alias("bands"),
        F.coalesce(F.sum("new_height"), F.lit(0)).alias("rows"),
    ).first()
    # the spans come from tile rows, so counting them does not read the pixels
    spans = materialise(
        row_spans(
            rows, edges, ["tile_id", "row"], known["bands"] or [1.0], touches, known["rows"], limit
        )
    )
    fill = F.coalesce(F.col("nodata"), F.lit(DEFAULT_NODATA)).alias("fill")
    cropped = _in_windows(
        pixels, windows.select("tile_id", "area_id", "x0", "res_x", fill, *_WINDOW), limit
    ).withColumn("px", pixel_x(F.col("col")))
    inside = (F.col("px") >= F.col("lo")) & (
        F.col("px") <= F.col("hi") if touches else F.col("px") < F.col("hi")
    )
    marked = lookup_join(
        cropped, spans, ["area_id", "tile_id", "row"], "left_outer", spans.count(), inside, limit
    )
    return marked.select(
        "area_id",
        "tile_id",
        *_bands(pixels),
        *_from_corner(),
        F.when(F.col("lo").isNotNull(), F.col("value")).otherwise(F.col("fill")).alias("value"),
    )


def raster_mosaic(
    pixels: DataFrame,
    tiles: DataFrame,
    x0: float,
    y0: float,
    res: float,
    limit: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Nearest-neighbour mosaic on a target lattice with its corner at ``x0, y0``.

    Where several valid pixels of a band fall on one target cell the nearest centre wins,
    then the lowest tile id, then the lowest row and column.  Distances are equal where they differ
    by less than their rounding.

    The precedence of a pixel within its cell is one number, so the winners are found by a hash
    aggregate with partial results in every task.  Where tiles share less than half of the area
    only pixels that may share a cell are grouped: those near another tile, and those of tiles finer
    than the lattice.  All others are alone in their cell and pass through without a shuffle.
    """
    x0, y0, res = float(x0), float(y0), float(res)
    tiles, ranked = _ranked(tiles)
    known = tiles.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.col("width") * F.col("height")), F.lit(0)).alias("pixels"),
        F.coalesce(F.max(ranked) - F.min(ranked), F.lit(0)).alias("ranks"),
        F.coalesce(F.min(ranked), F.lit(0)).alias("first"),
        F.coalesce(F.max(res / F.least("res_x", "res_y")), F.lit(1.0)).alias("finer"),
    ).first()
    described = tiles.select(
        "tile_id", (ranked - known["first"]).alias("rank"), *_GEOMETRY,
        F.coalesce("nodata", F.lit(DEFAULT_NODATA)).alias("fill"),
    )
    bands = _bands(pixels)
    precedence = _precedence(x0, y0, res, known["ranks"], known["finer"])

    def placed(part: DataFrame) -> DataFrame:
        """Valid pixels with their target cell and their precedence in it."""
        joined = lookup_join(part, described, ["tile_id"], "inner", known["n"], limit=limit)
        valid = joined.where(F.col("value").isNotNull() & (F.col("value") != F.col("fill")))
        x, y = pixel_x(F.col("col")), pixel_y(F.col("row"))
        grow, gcol = F.floor((F.lit(y0) - y) / F.lit(res)), F.floor((x - F.lit(x0)) / F.lit(res))
        celled = valid.select(
            *bands, "rank", "row", "col", *_GEOMETRY, "value", x.alias("x"), y.alias("y"), grow.alias("grow"), gcol.alias("gcol")
        )
        return celled.select(*bands, "grow", "gcol", "value", precedence.alias("precedence"))

    def winners(part: DataFrame) -> DataFrame:
        return placed(part).groupBy(*bands, "grow", "gcol").agg(F.min_by("value", "precedence").alias("value"))

    shared = materialise(_shared_windows(tiles, x0, y0, res, limit))
    block = F.lit(BLOCK_PIXELS)
    met = shared.agg(
        F.coalesce(F.sum(F.col("new_height") * F.col("new_width")), F.lit(0)).alias("pixels"),
        F.coalesce(
            F.sum((F.ceil(F.col("new_height") / block) + 1) * (F.ceil(F.col("new_width") / block) + 1)), F.lit(0)
        ).alias("blocks"),
    ).first()
    if 2 * met["pixels"] >= known["pixels"]:
        return winners(pixels)
    contested = _in_windows(pixels, shared, limit, "left_semi", met["blocks"])
    clear = placed(_in_windows(pixels, shared, limit, "left_anti", met["blocks"]))
    return winners(contested).unionByName(clear.select(*bands, "grow", "gcol", "value"))


def _ranked(tiles: DataFrame) -> tuple[DataFrame, Column]:
    """Tiles, and a number that orders them as their ids do: an integer id itself, or a count."""
    if isinstance(tiles.schema["tile_id"].dataType, IntegralType):
        return tiles, F.col("tile_id").cast("long")
    numbered = number_in_order(tiles.withColumn("__all", F.lit(0)), ["__all"], ["tile_id"], "__rank").drop("__all")
    return materialise(numbered), F.col("__rank")


# Bits of a precedence that distances need, so that they are told apart as far as their rounding lets them.
_DISTANCE_BITS = 40


def _precedence(x0: float, y0: float, res: float, ranks: int, finer: float) -> Column:
    """Distance to the centre of the cell, then tile, row and column, in one number.

    Rows and columns count from the first of the tile that can fall into the cell, so they
    take few bits; distances have what these leave of 62 bits.  Where that is too
    little, for pixels very much finer than the lattice, a struct of the four is compared instead.
    """
    gcol, grow = F.col("gcol"), F.col("grow")
    dx = F.col("x") - (F.lit(x0) + (gcol + 0.5) * F.lit(res))
    dy = F.col("y") - (F.lit(y0) - (grow + 0.5) * F.lit(res))
    distance = dx * dx + dy * dy
    place_bits = (math.ceil(finer) + 4).bit_length()
    rank_bits = int(ranks).bit_length()
    bits = min(62 - 2 * place_bits - rank_bits, 52)
    if bits < _DISTANCE_BITS:
        return F.struct(distance.alias("d"), "rank", "row", "col")
    # the first row and column whose centres lie in the cell, less one for rounding
    first_col = F.ceil((F.lit(x0) + gcol * F.lit(res) - F.col("x0")) / F.col("res_x") - 0.5) - 1
    first_row = F.ceil((F.col("y0") - (F.lit(y0) - grow * F.lit(res))) / F.col("res_y") - 0.5) - 1
    packed = F.round(distance * F.lit(2.0**bits / res**2)).cast("long")
    for value, width in ((F.col("rank"), rank_bits), (F.col("row") - first_row, place_bits), (F.col("col") - first_col, place_bits)):
        packed = F.shiftleft(packed, width) + value.cast("long")
    return packed


def _shared_windows(tiles: DataFrame, x0: float, y0: float, res: float, limit: int) -> DataFrame:
    """Windows of tiles whose pixels may share a cell of the lattice with others.

    A tile shares cells with each tile that comes within one cell of it, and with itself
    if its pixels are finer than the lattice or lie on its borders.
    """
    x0, y0, res = float(x0), float(y0), float(res)
    reach = tiles.selectExpr(
        "tile_id AS area_id",
        f"x0 - {res!r}D AS xmin", f"y0 - height * res_y - {res!r}D AS ymin",
        f"x0 + width * res_x + {res!r}D AS xmax", f"y0 + {res!r}D AS ymax",
    )

    def alone(size: str, phase: str) -> str:
        """Neighbouring centres are more than a cell apart, or a cell apart and not on its borders."""
        return (
            f"({size} > {res * (1 + 1e-6)!r}D OR ({size} = {res!r}D AND "
            f"({phase}) - floor({phase}) BETWEEN 0.001D AND 0.999D))"
        )

    phases = f"(x0 + res_x / 2 - {x0!r}D) / {res!r}D", f"({y0!r}D - y0 + res_y / 2) / {res!r}D"
    apart = F.expr(f"{alone('res_x', phases[0])} AND {alone('res_y', phases[1])}")
    met = crop_windows(tiles, reach, limit).where((F.col("area_id") != F.col("tile_id")) | ~apart)
    # a pixel more on each side makes up for rounding at a border
    return met.select(
        "tile_id",
        "area_id",
        F.greatest(F.col("row_off") - 1, F.lit(0)).alias("row_off"),
        F.greatest(F.col("col_off") - 1, F.lit(0)).alias("col_off"),
        (F.col("new_height") + 2).alias("new_height"),
        (F.col("new_width") + 2).alias("new_width"),
        "new_x0",
        "new_y0",
    )


def tile_extent(tiles: DataFrame) -> DataFrame:
    """Box around all tiles."""
    return tiles.agg(
        F.min("x0").alias("xmin"),
        F.min(F.col("y0") - F.col("height") * F.col("res_y")).alias("ymin"),
        F.max(F.col("x0") + F.col("width") * F.col("res_x")).alias("xmax"),
        F.max("y0").alias("ymax"),
    )


def extent_wkt(extent: DataFrame) -> DataFrame:
    """The box as a closed five-point polygon, and its midpoint, as WKT text."""
    def point(x: str, y: str) -> Column:
        return F.concat_ws(" ", F.col(x).cast("string"), F.col(y).cast("string"))

    ring = F.concat_ws(
        ", ",
        point("xmin", "ymin"),
        point("xmax", "ymin"),
        point("xmax", "ymax"),
        point("xmin", "ymax"),
        point("xmin", "ymin"),
    )
    middle = F.concat_ws(
        " ",
        ((F.col("xmin") + F.col("xmax")) / 2).cast("string"),
        ((F.col("ymin") + F.col("ymax")) / 2).cast("string"),
    )
    return extent.select(
        F.concat(F.lit("POLYGON(("), ring, F.lit("))")).alias("extent"),
        F.concat(F.lit("POINT ("), middle, F.lit(")")).alias("location"),
    )
