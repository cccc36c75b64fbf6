"""Table sources: catalog tables, views and JDBC tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from gridsieve.operators.timeclip import Bound, project, time_clip


def read_table(
    spark: SparkSession,
    table: str,
    time_dims: Sequence[str] | None = None,
    variables: Sequence[str] | None = None,
    space_dims: Sequence[str] | None = None,
    start: Bound = None,
    end: Bound = None,
) -> DataFrame:
    """Catalogued columns of a table within the time range of its first time column.

    Without catalogued columns all are read.  There is no spatial clip and no order.
    """
    return select_entry(spark.table(table), time_dims, variables, space_dims, start, end)


def select_entry(
    df: DataFrame,
    time_dims: Sequence[str] | None = None,
    variables: Sequence[str] | None = None,
    space_dims: Sequence[str] | None = None,
    start: Bound = None,
    end: Bound = None,
) -> DataFrame:
    clipped = time_clip(df, time_dims[0] if time_dims else None, start, end)
    return project(clipped, time_dims, variables, space_dims)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of a JDBC table, split into parallel range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partition column needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options | dict(extra or {})


def read_jdbc(spark: SparkSession, options: Mapping[str, str], *scales, **bounds) -> DataFrame:
    """As :func:`read_table` over JDBC; columns and bounds are pushed to the database."""
    return select_entry(spark.read.format("jdbc").options(**options).load(), *scales, **bounds)
