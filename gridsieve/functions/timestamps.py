"""Time bounds and time columns on zone-less UTC timestamps.

Text with an offset names an instant, which is counted from the epoch in UTC; text
without one is taken as it is.  Neither the session zone nor a daylight-saving
switch matters.  Applied to a literal, the whole expression folds to one constant and can be
pushed into a scan.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# a clock time that ends in Z or an offset
_WITH_OFFSET = r"[T ]\d{1,2}(:\d{2}){0,2}(\.\d+)?\s*(Z|[+-]\d{2}(:?\d{2})?)\s*$"
# the same without seconds, which a cast with an offset does not take
_NO_SECONDS = r"([T ]\d{1,2}:\d{2})\s*(Z|[+-]\d{2}(?::?\d{2})?)\s*$"
_COMPACT = r"^\s*(\d{4})(\d{2})(\d{2})(?:T?(\d{2})(\d{2})(\d{2})?)?\s*\z"
_MONTH_FIRST = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(?:[T ]+(\S+))?\s*\z"
_DAY_FIRST = r"^\s*(\d{1,2})[./-](\d{1,2})[./-](\d{4})(?:[T ]+(\S+))?\s*\z"


def utc_wall_clock(text: Column) -> Column:
    """ISO text, with or without an offset, as a zone-less UTC timestamp.

    Text that is not a timestamp gives null.
    """
    with_seconds = F.regexp_replace(text, _NO_SECONDS, "$1:00$2")
    since_epoch = F.unix_micros(with_seconds.try_cast("timestamp"))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.when(
        text.rlike(_WITH_OFFSET), F.timestamp_add("MICROSECOND", since_epoch, epoch)
    ).otherwise(text.try_cast("timestamp_ntz"))


def parse_time(text: Column, day_first: bool = False) -> Column:
    """Time column of a text file: ISO, ``yyyyMMdd[HHmm[ss]]`` or month-first dates.

    With ``day_first``, dates with the day in front (``13.01.2000``, ``13/01/2000``) instead.
    """
    compact = F.regexp_replace(
        F.regexp_replace(text, _COMPACT, "$1-$2-$3 $4:$5:$6"), r"[ :]+\z", ""
    )
    pattern, order = (_DAY_FIRST, "$3-$2-$1 $4") if day_first else (_MONTH_FIRST, "$3-$1-$2 $4")
    spelled = F.trim(F.regexp_replace(text, pattern, order))
    return (
        F.when(text.rlike(_COMPACT), compact.try_cast("timestamp_ntz"))
        .when(text.rlike(pattern), spelled.try_cast("timestamp_ntz"))
        .otherwise(utc_wall_clock(text))
    )


def bound(value: str | datetime | Column | None) -> Column | None:
    """A request bound as a TIMESTAMP_NTZ column; ``None`` stays open."""
    if value is None or isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    elif not isinstance(value, str):
        raise TypeError(f"a time bound must be text or a datetime, not {type(value).__name__}")
    return utc_wall_clock(F.lit(value))
