"""Grid cells in long form, and raster tiles, as Parquet tables."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsieve.operators.timeclip import Bound, time_clip

# how many tasks list the folders of a table; by default each folder is a task
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_CORE = 4
_listing = threading.Lock()


def read_cells(
    spark: SparkSession,
    path: str,
    time: str | None = None,
    start: Bound = None,
    end: Bound = None,
) -> DataFrame:
    """Cell table ``(time, y, x, values...)``; the time range reaches the scan."""
    return time_clip(spark.read.parquet(path), time, start, end)


def unpack(df: DataFrame, packing: Mapping[str, tuple[float, float, float | None]]) -> DataFrame:
    """Packed integers to values: ``raw * scale + offset``, the fill value to null.

    ``packing`` maps a column to ``(scale, offset, fill)``.  The fill value is
    compared with the raw number, before scaling.
    """
    unpacked = {}
    for column, (scale, offset, fill) in packing.items():
        raw = F.col(column)
        if fill is not None:
            raw = F.nullif(raw, F.lit(fill).cast(df.schema[column].dataType))
        unpacked[column] = raw.cast("double") * F.lit(float(scale)) + F.lit(float(offset))
    return df.withColumns(unpacked)


def read_tiles(spark: SparkSession, pixels: str, tiles: str) -> tuple[DataFrame, DataFrame]:
    """Pixel table and tile table of a raster entry."""
    return spark.read.parquet(pixels), spark.read.parquet(tiles)


def read_folders(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table of very many folders, which a few tasks for each core list.

    A session that sets the number of these tasks keeps its own.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    with _listing:
        if spark.conf.get(LISTING, None) is not None:
            return reader.parquet(path)
        spark.conf.set(LISTING, max(32, spark.sparkContext.defaultParallelism * LISTING_TASKS_PER_CORE))
        try:
            return reader.parquet(path)
        finally:
            spark.conf.unset(LISTING)
