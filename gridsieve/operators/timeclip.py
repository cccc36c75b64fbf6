"""Time range filter, file skipping by time extent, catalog-driven projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridsieve.functions.timestamps import bound
from gridsieve.scale import BROADCAST_ROW_LIMIT, lookup_join, materialise

Bound = str | datetime | Column | None

#: Most slots that a dataset's time range is cut into.
TIME_SLOTS = 4096


def _comparable(df: DataFrame, time: str, value: Column) -> Column:
    """The bound in the type of the time column, so the column itself stays bare."""
    if isinstance(df.schema[time].dataType, T.TimestampType):
        utc = F.concat(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z"))
        return utc.cast("timestamp")
    return value


def time_clip(df: DataFrame, time: str | None, start: Bound = None, end: Bound = None) -> DataFrame:
    """Rows with ``start <= time <= end``; a missing bound is open.

    Entries without a time scale (``time`` is None) pass unchanged.
    """
    if time is None:
        return df
    if start is not None:
        df = df.where(F.col(time) >= _comparable(df, time, bound(start)))
    if end is not None:
        df = df.where(F.col(time) <= _comparable(df, time, bound(end)))
    return df


def within(micros: str) -> Column:
    """Whether a time lies in a range ``since`` to ``until`` (microseconds, null for open ends)."""
    late, early = F.col("since").isNull(), F.col("until").isNull()
    return (late | (F.col(micros) >= F.col("since"))) & (early | (F.col(micros) <= F.col("until")))


@dataclass(frozen=True)
class TimeSlots:
    """Slots ``0`` to ``last`` of a dataset's time range, in microseconds; rows without a time have slot -1."""

    low: int
    width: int
    last: int

    def of(self, micros: str) -> Column:
        slot = F.floor((F.col(micros) - F.lit(self.low)) / F.lit(self.width))
        return F.coalesce(slot, F.lit(-1).cast("long"))

    def listed(self, ranges: DataFrame, slot: str) -> DataFrame:
        """``ranges`` once for each slot that they meet; rows without a time only belong to those open at both ends."""
        start, end = F.lit(0).cast("long"), F.lit(self.last).cast("long")
        first = F.when(F.col("since").isNull(), start).otherwise(F.greatest(self.of("since"), start))
        last = F.when(F.col("until").isNull(), end).otherwise(F.least(self.of("until"), end))
        met = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        timeless = F.when(
            F.col("since").isNull() & F.col("until").isNull(), F.array(F.lit(-1).cast("long"))
        ).otherwise(F.array().cast("array<bigint>"))
        return ranges.withColumn(slot, F.explode(F.concat(timeless, met)))


def time_slots(df: DataFrame, micros: str, ranges: DataFrame) -> TimeSlots:
    """Slots as long as a mean range ``since`` to ``until`` of those that meet the data.

    A range then lies in two or three slots on the average, and a row meets about twice as many
    ranges as hold it.
    """
    ends = df.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    since = F.greatest(F.coalesce("since", F.lit(low)), F.lit(low))
    until = F.least(F.coalesce("until", F.lit(high)), F.lit(high))
    mean = ranges.agg(F.avg(F.when(since <= until, until - since))).first()[0] or 0
    width = max(int(mean), (high - low) // TIME_SLOTS) + 1
    return TimeSlots(low, width, (high - low) // width)


def time_manifest(df: DataFrame, file: str, time: str) -> DataFrame:
    """Per file: first and last time and the number of rows."""
    return df.groupBy(file).agg(
        F.min(time).alias("t_min"), F.max(time).alias("t_max"), F.count("*").alias("n_rows")
    )


def outside(start: Bound, end: Bound) -> Column:
    """True for a manifest row whose file lies before the start or after the end."""
    late = F.lit(False) if start is None else F.coalesce(bound(start) > F.col("t_max"), F.lit(False))
    early = F.lit(False) if end is None else F.coalesce(bound(end) < F.col("t_min"), F.lit(False))
    return late | early


def kept_files(manifest: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
    """Manifest rows of the files that overlap the time range."""
    return manifest.where(~outside(start, end))


def file_skip(
    df: DataFrame,
    manifest: DataFrame,
    file: str,
    start: Bound = None,
    end: Bound = None,
    limit: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Rows of the files that overlap the time range.

    With data partitioned by ``file`` the semi join prunes partitions at run time.
    """
    kept = materialise(kept_files(manifest, start, end).select(file))
    return lookup_join(df, kept, [file], "left_semi", kept.count(), limit=limit)


def catalog_columns(
    time_dims: Sequence[str] | None, variables: Sequence[str] | None, space_dims: Sequence[str] | None
) -> list[str]:
    """Column order of an entry: time, variables, space; empty means all columns."""
    return [*(time_dims or []), *(variables or []), *(space_dims or [])]


def project(
    df: DataFrame,
    time_dims: Sequence[str] | None = None,
    variables: Sequence[str] | None = None,
    space_dims: Sequence[str] | None = None,
) -> DataFrame:
    """Only the catalogued columns, in catalog order."""
    columns = catalog_columns(time_dims, variables, space_dims)
    return df.select(*columns) if columns else df


def project_grid(df: DataFrame, variables: Sequence[str], coordinates: Sequence[str]) -> DataFrame:
    """The variables of a grid and every coordinate it has."""
    return df.select(*[c for c in coordinates if c in df.columns], *variables)
