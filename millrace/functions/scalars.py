"""Scalar column functions with the semantics the operators rely on.

Thin names over built-ins, kept where null, rounding or range rules need stating.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_get(text: Column, separator: str, n: int) -> Column:
    """The 0-based ``n``-th field of a separated line; null when there are fewer."""
    return F.get(F.split(text, separator), F.lit(n))


def cast_number(text: Column, to: str = "double") -> Column:
    """Text to a number, blanks around it ignored; null when it is not one."""
    return F.trim(text).try_cast(to)


def days_before(day: Column, days: int) -> Column:
    """The date so many days earlier, as ``yyyy-MM-dd`` text."""
    return F.date_format(F.date_sub(day, days), "yyyy-MM-dd")


def yesterday() -> Column:
    """Yesterday's date as ``yyyy-MM-dd`` text."""
    return days_before(F.current_date(), 1)


def format_batch_time(time: Column) -> Column:
    """A batch or window time as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def format_percent(share: Column, digits: int = 4) -> Column:
    """A share as percent text with a fixed number of decimals."""
    return F.format_string(f"%.{digits}f%%", share * 100)


def epoch_millis(value: Column) -> Column:
    """Milliseconds since 1970 to a timestamp."""
    return F.timestamp_millis(value)


def epoch_seconds(value: Column) -> Column:
    """Seconds since 1970 to a timestamp."""
    return F.timestamp_seconds(value)


def clamp_low(value: Column, low: float = 0.0) -> Column:
    """The value, or the bound where the value is below it."""
    return F.greatest(value, F.lit(low))


def threshold(score: Column, cut: float = 0.5) -> Column:
    """1 where the score is above the cut, else 0."""
    return F.when(score > cut, 1).otherwise(0)


def with_suffix(text: Column, suffix: Column, joint: str = "_") -> Column:
    """Text, a joint and a suffix of any type; null when either is null."""
    return F.concat(text, F.lit(joint), suffix.cast("string"))
