"""Catalog-driven extraction of tables, station series, grids and rasters on Spark."""

from gridsieve.operators.areas import (
    area_boxes,
    area_edges,
    area_vertices,
    areas_from_features,
    read_features,
    vertex_lines,
)
from gridsieve.operators.catalog import find_or_create, first_match, lookup, missing, search
from gridsieve.operators.clip import (
    bbox_clip,
    cell_size,
    clip_many,
    drop_incomplete,
    polygon_clip,
    resolve_coordinates,
)
from gridsieve.operators.combine import concat_frames, part_names, sort_time
from gridsieve.operators.raster import (
    crop_windows,
    extent_wkt,
    pixel_positions,
    raster_crop,
    raster_mask,
    raster_mosaic,
    skip_tiles,
    tile_extent,
)
from gridsieve.operators.requests import fan_out, parse_requests, requested_ids
from gridsieve.operators.timeclip import (
    file_skip,
    kept_files,
    project,
    project_grid,
    time_clip,
    time_manifest,
)
from gridsieve.plans.extract import CATALOG, extract
from gridsieve.plans.many import extract_many, read_extract
from gridsieve.plans.report import run_report, totals
from gridsieve.sources.cells import read_cells, read_tiles, unpack
from gridsieve.sources.csvfiles import scan_csv
from gridsieve.sources.paths import expand_path
from gridsieve.sources.tables import jdbc_options, read_jdbc, read_table

__all__ = [name for name in dir() if not name.startswith("_")]
