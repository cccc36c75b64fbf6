"""Expected files of a download minus those already present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expected_tiles(ranges: DataFrame, pattern: str) -> DataFrame:
    """Tile keys of whole-degree ranges ``lat_min, lat_max, lon_min, lon_max``.

    ``pattern`` takes latitude and longitude, both ends are included, and a tile
    named by several ranges is listed once.
    """
    lats = ranges.withColumn("lat", F.explode(F.sequence("lat_min", "lat_max")))
    both = lats.withColumn("lon", F.explode(F.sequence("lon_min", "lon_max")))
    return both.select("lat", "lon").distinct().select(
        F.format_string(pattern, "lat", "lon").alias("key"), "lat", "lon"
    )


def expected_years(variables: DataFrame, years: DataFrame, pattern: str) -> DataFrame:
    """One file per variable and year.

    ``variables`` has ``folder, prefix, resolution, version``; ``years`` has
    ``folder, first_year, last_year``; ``pattern`` takes prefix, resolution, year and
    version.
    """
    spread = variables.join(years, "folder").withColumn(
        "year", F.explode(F.sequence("first_year", "last_year"))
    )
    return spread.select(
        "folder",
        "year",
        F.format_string(pattern, "prefix", "resolution", "year", "version").alias("key"),
    )


def not_present(expected: DataFrame, inventory: DataFrame, key: str = "key") -> DataFrame:
    """Expected files that the inventory does not hold."""
    return expected.join(inventory.select(key).distinct(), key, "left_anti")
