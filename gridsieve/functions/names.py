"""File names, suffixes, wildcard patterns and output names as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The suffixes that decide how a file source is read.
GRID_SUFFIXES = (".nc", ".netcdf", ".cdf", ".nc4")
RASTER_SUFFIXES = (".tif", ".tiff", ".dem")
CSV_SUFFIXES = (".csv", ".tsv", ".txt", ".dat")


def glob_like(text: Column, pattern: str) -> Column:
    """``*`` wildcard match; every other character stands for itself."""
    like = pattern
    for special in ("\\", "%", "_"):
        like = like.replace(special, "\\" + special)
    return text.like(like.replace("*", "%"))


def base_name(path: Column) -> Column:
    """The text after the last slash (empty for a path that ends in one)."""
    return F.substring_index(path, "/", -1)


def suffix(path: Column) -> Column:
    """Lower-cased last suffix of a path or pattern, with its dot, or ''."""
    last = base_name(F.regexp_replace(path, r"/+\z", ""))
    return F.lower(F.regexp_extract(last, r"^.+(\.[^.]+)\z", 1))


def source_route(type_name: Column, path: Column) -> Column:
    """How an entry is read: sql, unsupported, grid, raster, csv, or null."""
    ending = suffix(path)
    return (
        F.when(type_name == "internal", "sql")
        .when(type_name == "external", "unsupported")
        .when(ending.isin(*GRID_SUFFIXES), "grid")
        .when(ending.isin(*RASTER_SUFFIXES), "raster")
        .when(ending.isin(*CSV_SUFFIXES), "csv")
    )


def station_key(path: Column) -> Column:
    """Station or catchment id held at the end of a file name."""
    tail = F.substring_index(base_name(path), "_", -1)
    return F.regexp_replace(F.replace(tail, F.lit(".csv"), F.lit("")), r"^\s+|\s+\z", "")


def station_file(path: Column) -> Column:
    """Output file of a CSV source: its leading name part, the id and ``.csv``."""
    head = F.regexp_replace(base_name(path), r"_[^_]*\z", "")
    return F.concat(head, F.lit("_"), station_key(path), F.lit(".csv"))


def output_name(variable_name: Column, entry_id: Column) -> Column:
    """``<variable with underscores>_<entry id>``."""
    return F.concat(
        F.replace(variable_name, F.lit(" "), F.lit("_")), F.lit("_"), entry_id.cast("string")
    )
