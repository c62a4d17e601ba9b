"""Readings while a machine's data are valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow import schema
from plantflow.functions import values
from plantflow.operators import segments
from plantflow.operators.segments import SegmentPlan
from plantflow.params import TimeRange
from plantflow.sources import eventlog


def order() -> list[Column]:
    """Validity changes come first at a shared instant: an interval contains its start and not its end."""
    return [F.col("timestamp"), F.col("variable") != schema.DATA_VALID, F.col("event_id")]


def log_of(
    events: DataFrame,
    within: TimeRange,
    states: Sequence[str],
    samples: Sequence[str],
    machine_id: int | None = None,
    details: Sequence[str] = (),
) -> DataFrame:
    """The rows a report over the range needs: samples inside it, state changes inside it and the states before it.

    `details` are further columns of the samples; changes come without them.
    """
    changes = eventlog.of_variables(events, states, machine_id)
    log = eventlog.relevant_changes(changes, ["machine_id", "variable"], within)
    if not samples:
        return log
    readings = eventlog.during(eventlog.of_variables(events, samples, machine_id), within)
    return readings.select(*log.columns, *details).unionByName(log, allowMissingColumns=True)


def is_variable(name: str) -> Column:
    return F.col("variable") == name


def validity() -> dict[str, segments.Running]:
    """The validity change in force: its time and value."""
    change = is_variable(schema.DATA_VALID)
    return {
        "valid_since": segments.last(F.when(change, F.col("timestamp"))),
        "valid": segments.last(F.when(change, F.col("value"))),
    }


def interval_start(within: TimeRange) -> Column:
    return F.greatest(F.col("valid_since"), within.start)


def readings_before(name: str, prefix: str) -> dict[str, segments.Running]:
    """The reading of a counter before the row: its time and value."""
    reading = is_variable(name)
    return {
        f"{prefix}_ts": segments.previous(F.when(reading, F.col("timestamp"))),
        f"{prefix}_value": segments.previous(F.when(reading, F.col("value"))),
    }


def baseline(prefix: str, start: Column) -> Column:
    """The reading before, if it lies in the same validity interval, which begins at `start`."""
    return F.when(F.col(f"{prefix}_ts") >= start, F.col(f"{prefix}_value"))


def gate(
    events: DataFrame,
    within: TimeRange,
    variables: Sequence[str],
    machine_id: int | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Samples inside validity intervals, with the start of their interval cut to the range.

    Validity intervals of a machine follow one another, so carrying the last validity change along the log finds the
    interval of every sample: one shuffle and no join between samples and intervals.
    """
    return _carried(events, within, variables, machine_id, {}, plan)


def counter_deltas(
    events: DataFrame,
    within: TimeRange,
    variables: Sequence[str],
    machine_id: int | None = None,
    first: str = "zero",
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Advance of every counter reading since the one before in the same validity interval.

    The first reading of an interval has nothing before it: a new interval and the start of the range both begin anew.
    """
    before = {name: f"before_{i}" for i, name in enumerate(variables)}
    earlier = {}
    for name, prefix in before.items():
        earlier |= readings_before(name, prefix)
    gated = _carried(events, within, variables, machine_id, earlier, plan)
    previous = F.coalesce(
        *[F.when(is_variable(name), baseline(prefix, F.col("interval_start"))) for name, prefix in before.items()]
    )
    return (
        gated.withColumn("previous_value", previous)
        .withColumn("delta", values.counter_delta(F.col("value"), F.col("previous_value"), first))
        .drop(*earlier)
    )


def _carried(
    events: DataFrame,
    within: TimeRange,
    variables: Sequence[str],
    machine_id: int | None,
    more: dict[str, segments.Running],
    plan: SegmentPlan | None,
) -> DataFrame:
    log = log_of(events, within, [schema.DATA_VALID], variables, machine_id, ("type", "event_type"))
    carried = segments.by_heat(
        log,
        ["machine_id"],
        order(),
        plan,
        lambda rows, cut: segments.running(rows, ["machine_id"], order(), validity() | more, cut),
    )
    return (
        carried.filter(~is_variable(schema.DATA_VALID) & (F.col("valid") == 1))
        .withColumn("interval_start", interval_start(within))
        .drop("valid", "valid_since")
    )
