"""Concatenation, order by time, and part names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.functions.names import output_name
from gridsieve.scale import lookup_join, materialise, number_in_order


def concat_frames(frames: list[DataFrame]) -> DataFrame:
    """Outer union by column name; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_time(df: DataFrame, time: str) -> DataFrame:
    """Ascending by time, nulls last, over all partitions.

    Rows of the same time keep their input order.  The input position is part of
    the sort key, so a time that holds many rows is spread over several ranges.
    """
    return (
        df.withColumn("__position", F.monotonically_increasing_id())
        .orderBy(F.col(time).asc_nulls_last(), "__position")
        .drop("__position")
    )


def part_names(files: DataFrame) -> DataFrame:
    """Output names of the files of an entry.

    ``files`` has ``entry_id, variable_name, route, path, kept``, one row per
    candidate file.  Grids number every kept file.  Rasters carry no number when
    the entry has one candidate, and numbers advance only for written tiles.
    Files are numbered in path order.
    """
    candidates = materialise(files.groupBy("entry_id").agg(F.count("*").alias("n_candidates")))
    numbered = number_in_order(files.where("kept"), ["entry_id"], ["path"], "part")
    stem = output_name(F.col("variable_name"), F.col("entry_id"))
    single = (F.col("route") == "raster") & (F.col("n_candidates") == 1)
    part = F.concat(stem, F.lit("_part_"), F.col("part").cast("string"))
    named = lookup_join(numbered, candidates, ["entry_id"], "inner", candidates.count())
    return named.select(
        "entry_id", "route", "path", "part", F.when(single, stem).otherwise(part).alias("target")
    )
