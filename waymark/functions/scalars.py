"""Scalar expressions. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; a zero denominator gives NULL under any ANSI setting."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column | str) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(ts)


def weekday(ts: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def parse_timestamp(text: Column | str, pattern: str | None = None) -> Column:
    """Text to timestamp; text that is not one gives NULL."""
    return F.try_to_timestamp(_col(text), F.lit(pattern) if pattern else None)


def split_field(text: Column | str, sep: str, index: int) -> Column:
    """The ``index``-th (from 0) field between literal separators, or NULL."""
    return F.get(F.split(_col(text), rf"\Q{sep}\E"), index)


def round_half_even(value: Column | str, places: int) -> Column:
    return F.bround(_col(value), places)


def whole_number(value: Column | str, dtype: str = "int") -> Column:
    """Truncate to an integer type; NaN and values out of range give NULL."""
    return _col(value).try_cast(dtype)
