"""Machine states over a range: timeline and share of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantflow import schema
from plantflow.functions import values
from plantflow.operators import intervals
from plantflow.operators.segments import SegmentPlan
from plantflow.params import TimeRange
from plantflow.sources import eventlog

KEYS = ["machine_id", "variable"]


def _changes(events: DataFrame, states: Sequence[str] | None, machine_id: int | None) -> DataFrame:
    """`states` None means all machine states."""
    return eventlog.of_variables(events, schema.MACHINE_STATES if states is None else states, machine_id)


def state_intervals(
    events: DataFrame,
    within: TimeRange,
    states: Sequence[str] | None = None,
    machine_id: int | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """When each state was on."""
    return intervals.from_changes(_changes(events, states, machine_id), KEYS, within, 1, plan).drop("value")


def state_timeline(
    events: DataFrame,
    within: TimeRange,
    states: Sequence[str] | None = None,
    machine_id: int | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """When each state was on or off; in time order for a single machine."""
    timeline = intervals.from_changes(_changes(events, states, machine_id), KEYS, within, None, plan)
    return timeline if machine_id is None else timeline.orderBy("variable", "interval_start")


def state_time_share(
    events: DataFrame,
    within: TimeRange,
    states: Sequence[str] | None = None,
    machine_id: int | None = None,
    known_only: bool = False,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Percentage of the range each state was on.

    `known_only` takes the time since a state's first report as the whole instead of the range. A state that
    reported but never was on has share 0.
    """
    timeline = intervals.from_changes(_changes(events, states, machine_id), KEYS, within, None, plan)
    length = intervals.length_us(F.col("interval_start"), F.col("interval_end"))
    sums = timeline.groupBy(*KEYS).agg(
        F.coalesce(F.sum(F.when(F.col("value") == 1, length)), F.lit(0).cast("bigint")).alias("on_us"),
        F.sum(length).alias("known_us"),
    )
    whole = F.col("known_us") if known_only else F.lit(within.length_us).cast("bigint")
    return sums.select(*KEYS, "on_us", values.percentage(F.col("on_us"), whole).alias("share_percent"))
