"""State changes as intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow.functions import timecols
from plantflow.operators import segments
from plantflow.operators.segments import SegmentPlan
from plantflow.params import TimeRange
from plantflow.sources import eventlog


def from_changes(
    changes: DataFrame,
    keys: Sequence[str],
    within: TimeRange,
    only_value: int | None = 1,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Intervals between consecutive change events of a key, cut to the range.

    A state holds from its event to the next event of the same key, the last one to the end of the range. Repeated
    equal values stay separate intervals. `only_value` keeps the intervals of one value, chosen after the next event
    is known; None keeps all.
    """
    seen = eventlog.relevant_changes(changes, keys, within)
    order = [F.col("timestamp"), F.col("event_id")]
    next_change = {"next_change": segments.following(F.col("timestamp"))}
    chained = segments.by_heat(
        seen, keys, order, plan, lambda rows, cut: segments.running(rows, keys, order, next_change, cut)
    )
    if only_value is not None:
        chained = chained.filter(F.col("value") == only_value)
    until = F.coalesce(F.col("next_change"), within.end)
    return chained.filter(timecols.overlaps(F.col("timestamp"), until, within.start, within.end)).select(
        *keys,
        "value",
        F.greatest(F.col("timestamp"), within.start).alias("interval_start"),
        F.least(until, within.end).alias("interval_end"),
    )


def length_us(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def both_active(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    first_on: Column,
    second_on: Column,
    plan: SegmentPlan | None = None,
    until: Column | None = None,
) -> DataFrame:
    """Stretches in which two states are on at once, from one merged log of their changes.

    `first_on` and `second_on` are null on rows that do not change the state, else whether it is on. The log is swept
    once; a stretch starts at a change and ends at the next one, so no pairs of intervals are formed.
    """
    both = {
        "_first": segments.last(first_on),
        "_second": segments.last(second_on),
        "_next": segments.following(F.col("timestamp")),
    }
    swept = segments.by_heat(
        changes, keys, order, plan, lambda rows, cut: segments.running(rows, keys, order, both, cut)
    )
    end = F.col("_next") if until is None else F.coalesce(F.col("_next"), until)
    return (
        swept.filter(F.col("_first") & F.col("_second"))
        .select(*keys, F.col("timestamp").alias("interval_start"), end.alias("interval_end"))
        .filter(F.col("interval_end") > F.col("interval_start"))
    )


def intersect(
    left: DataFrame, right: DataFrame, keys: Sequence[str], plan: SegmentPlan | None = None
) -> DataFrame:
    """Common parts of two sets of intervals; within a set, intervals of a key must not overlap.

    Empty parts are left out. Linear in the number of intervals: starts and ends are merged and swept.
    """

    def edges(df: DataFrame, is_left: bool) -> DataFrame:
        ends = F.array(
            F.struct(F.col("interval_start").alias("timestamp"), F.lit(True).alias("on")),
            F.struct(F.col("interval_end").alias("timestamp"), F.lit(False).alias("on")),
        )
        solid = df.filter(F.col("interval_end") > F.col("interval_start"))
        return solid.select(*keys, F.explode(ends).alias("edge"), F.lit(is_left).alias("is_left")).select(
            *keys, "edge.*", "is_left"
        )

    log = edges(left, True).unionByName(edges(right, False))
    # Ends sort before starts at the same instant, so a set stays on where one interval follows another.
    return both_active(
        log,
        keys,
        [F.col("timestamp"), F.col("on"), F.col("is_left")],
        F.when(F.col("is_left"), F.col("on")),
        F.when(~F.col("is_left"), F.col("on")),
        plan,
    )
