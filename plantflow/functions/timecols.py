"""Expressions over timestamps and half-open intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def from_epoch_seconds(seconds: Column) -> Column:
    """Timestamp of a floating-point epoch, rounded to the microsecond."""
    return F.timestamp_micros(F.rint(seconds * 1e6).try_cast("bigint"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(1e6)


def seconds(micros: Column) -> Column:
    """Durations stay whole microseconds until this last division."""
    return micros / F.lit(1e6)


def overlaps(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """SQL-standard period overlap.

    Reversed endpoints are swapped; periods are half-open, so touching ones do not overlap; a period of zero
    length stands for its instant; equal starts always overlap.
    """
    first_a, last_a = F.least(start_a, end_a), F.greatest(start_a, end_a)
    first_b, last_b = F.least(start_b, end_b), F.greatest(start_b, end_b)
    return F.when(first_a > first_b, first_a < last_b).when(first_b > first_a, first_b < last_a).otherwise(
        first_a == first_b
    )


def contains(start: Column, end: Column, ts: Column) -> Column:
    """Start inclusive, end exclusive; an absent end never ends."""
    return (ts >= start) & (end.isNull() | (ts < end))


def chunk_start(ts: Column, days: int = 7) -> Column:
    """Start of the epoch-aligned storage chunk holding `ts`."""
    width = days * DAY_US
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))


def chunk_end(start: Column, days: int = 7) -> Column:
    return F.timestamp_micros(F.unix_micros(start) + F.lit(days * DAY_US))
