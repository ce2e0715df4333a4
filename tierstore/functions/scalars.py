"""Scalar conversions applied at landing and in reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

from tierstore.schemas import VALUE_TYPE

# Landing text is 23 characters ('yyyy-MM-dd HH:mm:ss.SSS') followed by a NUL terminator.
TIME_TEXT_LENGTH = 23
STYLE_120 = "yyyy-MM-dd HH:mm:ss"


def parse_counter_time(text: Column | str) -> Column:
    """Landing text -> timestamp_ntz; unparsable text gives NULL (the row is quarantined)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.left(c, F.lit(TIME_TEXT_LENGTH)).try_cast("timestamp_ntz")


def to_stored_value(value: Column | str, value_type: DataType = VALUE_TYPE) -> Column:
    """float -> decimal(28,0) by default: rounds half away from zero, drops the fraction on
    purpose; overflow and NaN give NULL instead of an error (the row is quarantined)."""
    c = F.col(value) if isinstance(value, str) else value
    return c.try_cast(value_type)


def style_120(ts: Column | str) -> Column:
    """timestamp -> 'yyyy-MM-dd HH:mm:ss' text."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, STYLE_120)


def concat_text(*parts: Column) -> Column:
    """String concatenation in which NULL counts as '' (not NULL-propagating)."""
    return F.concat_ws("", *parts)


def year_start(year: Column | str) -> Column:
    """First instant of a year as timestamp_ntz."""
    y = F.col(year) if isinstance(year, str) else year
    return F.make_timestamp_ntz(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def elapsed(unit: str, start: Column | str, end: Column | str) -> Column:
    """Boundaries of ``unit`` (SECOND, MINUTE, DAY, ...) between two timestamps, as DATEDIFF counts
    them: 23:59:59.9 to 00:00:00.1 is one second and one day. NULL if either is NULL."""
    at = [F.date_trunc(unit, c).cast("timestamp_ntz") for c in (start, end)]
    return F.timestamp_diff(unit, *at)
