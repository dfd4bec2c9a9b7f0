"""Event-time arithmetic on epoch microseconds (bigint), so no time zone can creep in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def idiv(num: Column, den: int | Column) -> Column:
    """Integer quotient truncated toward zero, as bigint."""
    return F.call_function("div", num, F.lit(den) if isinstance(den, int) else den)


def floor_to(us: Column, size: int) -> Column:
    """Start of the epoch-aligned window of ``size`` holding ``us`` (also right before 1970)."""
    return us - F.pmod(us, F.lit(size))


def next_tick(us: Column, tick: int) -> Column:
    """First multiple of ``tick`` strictly after ``us``."""
    return floor_to(us, tick) + F.lit(tick)


def ceil_to(us: Column, tick: int) -> Column:
    """First multiple of ``tick`` at or after ``us``."""
    return floor_to(us + F.lit(tick - 1), tick)


def seconds_to_us(seconds: Column) -> Column:
    return seconds.cast("bigint") * F.lit(SECOND)


def interval(us: int) -> str:
    """A Spark duration string for ``us`` microseconds."""
    return f"{us} microseconds"
