"""Status of every requested dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.functions.names import output_name, source_route, station_file
from gridsieve.scale import BROADCAST_ROW_LIMIT, lookup_join, materialise

STATUS = (
    "position INT, entry_id BIGINT, route STRING, status STRING, n_rows BIGINT, "
    "t_min TIMESTAMP_NTZ, t_max TIMESTAMP_NTZ, target STRING, seconds DOUBLE, detail STRING"
)


def run_report(
    wanted: DataFrame,
    catalog: DataFrame,
    stats: DataFrame,
    carry: Sequence[str] = ("request_id", "position"),
    limit: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """One status row per requested id, for many requests in one job.

    ``catalog`` has one row per ``entry_id`` (see ``first_match``); ``stats`` has
    ``entry_id, n_rows, t_min, t_max`` of the clipped data.  A request that names a
    missing, unsupported or empty dataset still reports all others.
    """
    known = catalog.count()
    entries = catalog.select(
        F.col("entry_id").cast("long").alias("dataset_id"),
        F.lit(True).alias("found"),
        source_route(F.col("ds_type"), F.col("path")).alias("route"),
        F.when(
            source_route(F.col("ds_type"), F.col("path")) == "csv", station_file(F.col("path"))
        ).otherwise(output_name(F.col("variable_name"), F.col("entry_id"))).alias("name"),
    )
    # one row per dataset; kept, because it is counted before it is joined
    measured = materialise(
        stats.select(F.col("entry_id").cast("long").alias("dataset_id"), "n_rows", "t_min", "t_max")
    )
    rows = lookup_join(wanted, entries, ["dataset_id"], "left_outer", known, limit=limit)
    rows = lookup_join(rows, measured, ["dataset_id"], "left_outer", measured.count(), limit=limit)
    readable = F.col("route").isin("sql", "csv", "grid", "raster")
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("route").isNull(), "unrouted")
        .when(F.col("route") == "unsupported", "unsupported")
        .when(F.coalesce(F.col("n_rows"), F.lit(0)) == 0, "empty")
        .otherwise("ok")
    )
    shown = readable & (F.coalesce(F.col("n_rows"), F.lit(0)) > 0)
    return rows.select(
        *carry,
        F.col("dataset_id").alias("entry_id"),
        "route",
        status.alias("status"),
        F.when(readable, F.coalesce(F.col("n_rows"), F.lit(0))).alias("n_rows"),
        F.when(shown, F.col("t_min")).alias("t_min"),
        F.when(shown, F.col("t_max")).alias("t_max"),
        F.when(shown, F.col("name")).alias("target"),
    )


def totals(report: DataFrame) -> DataFrame:
    """Datasets and rows per status."""
    return report.groupBy("status").agg(
        F.count("*").alias("datasets"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
    )
