"""Production figures per machine, counted only while the machine's data are valid.

All five figures come from one ordered pass over a machine's log. The reports of single figures read only the
variables they need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow import schema
from plantflow.functions import timecols, values
from plantflow.operators import intervals, segments, validity
from plantflow.operators.segments import SegmentPlan
from plantflow.params import TimeRange

PIECES = "total_pieces_counted"
REJECTED = "total_rejected_pieces"
REJECTED_SHARE = "rejected_percentage"
ANOMALIES = "total_anomalies"
ANOMALY_SECONDS = "total_anomaly_seconds"


def machines_of(events: DataFrame) -> DataFrame:
    """Every machine that ever reported. Pass a registry instead where there is one."""
    return events.select("machine_id").distinct()


def _figures(
    events: DataFrame,
    within: TimeRange,
    names: Sequence[str],
    machine_id: int | None,
    machines: DataFrame | None,
    plan: SegmentPlan | None,
) -> DataFrame:
    want_pieces = PIECES in names or REJECTED_SHARE in names
    want_rejects = REJECTED in names or REJECTED_SHARE in names
    want_stretches = ANOMALY_SECONDS in names
    want_starts = ANOMALIES in names

    counters = [schema.PIECE_COUNTER] * want_pieces + [schema.REJECT_COUNTER] * want_rejects
    # Durations need the anomaly state the range begins with, starts only the changes inside it.
    states = [schema.DATA_VALID] + [schema.MACHINE_ANOMALY] * want_stretches
    samples = counters + [schema.MACHINE_ANOMALY] * (want_starts and not want_stretches)

    carried = validity.validity()
    for counter in counters:
        carried |= validity.readings_before(counter, counter)
    if want_stretches:
        carried["anomaly"] = segments.last(
            F.when(validity.is_variable(schema.MACHINE_ANOMALY), F.col("value"))
        )
        carried["until"] = segments.following(F.col("timestamp"))

    valid = F.col("valid") == 1

    def advance(counter: str) -> Column:
        delta = values.counter_delta(F.col("value"), validity.baseline(counter, validity.interval_start(within)))
        return F.sum(F.when(valid & validity.is_variable(counter), delta))

    sums = {}
    if want_pieces:
        sums[PIECES] = advance(schema.PIECE_COUNTER)
    if want_rejects:
        sums[REJECTED] = advance(schema.REJECT_COUNTER)
    if want_starts:
        started = validity.is_variable(schema.MACHINE_ANOMALY) & (F.col("value") == 1)
        inside = F.col("timestamp") >= within.start
        sums[ANOMALIES] = F.count(F.when(valid & started & inside, F.lit(1)))
    if want_stretches:
        # Any row ends the stretch before it, so a stretch may come in several parts; their sum is the same.
        begin = F.unix_micros(F.greatest(F.col("timestamp"), within.start))
        end = F.unix_micros(F.coalesce(F.col("until"), within.end))
        sums["anomaly_us"] = F.sum(F.when(valid & (F.col("anomaly") == 1) & (end > begin), end - begin))

    log = validity.log_of(events, within, states, samples, machine_id)
    measured = segments.by_heat(
        log,
        ["machine_id"],
        validity.order(),
        plan,
        lambda rows, cut: segments.running(rows, ["machine_id"], validity.order(), carried, cut),
    )
    totals = [s.alias(name) for name, s in sums.items()]
    if machine_id is not None:
        # One row, also for a machine without any.
        joined = measured.agg(*totals).withColumn("machine_id", F.lit(machine_id).cast("int"))
    else:
        everyone = machines_of(events) if machines is None else machines.select("machine_id").distinct()
        joined = everyone.join(measured.groupBy("machine_id").agg(*totals), "machine_id", "left")

    def whole(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint"))

    shown = {
        PIECES: lambda: whole(PIECES),
        REJECTED: lambda: whole(REJECTED),
        REJECTED_SHARE: lambda: values.percentage(whole(REJECTED), whole(PIECES)),
        ANOMALIES: lambda: whole(ANOMALIES),
        ANOMALY_SECONDS: lambda: timecols.seconds(whole("anomaly_us")),
    }
    return joined.select("machine_id", *[shown[name]().alias(name) for name in names])


def pieces_total(
    events: DataFrame,
    within: TimeRange,
    machine_id: int | None = None,
    machines: DataFrame | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Pieces produced while valid."""
    return _figures(events, within, [PIECES], machine_id, machines, plan)


def rejected_total(
    events: DataFrame,
    within: TimeRange,
    machine_id: int | None = None,
    machines: DataFrame | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Pieces rejected while valid."""
    return _figures(events, within, [REJECTED], machine_id, machines, plan)


def rejected_percentage(
    events: DataFrame,
    within: TimeRange,
    machine_id: int | None = None,
    machines: DataFrame | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Rejected pieces per hundred produced; 0 where nothing was produced."""
    return _figures(events, within, [REJECTED_SHARE], machine_id, machines, plan)


def anomaly_starts(
    events: DataFrame,
    within: TimeRange,
    machine_id: int | None = None,
    machines: DataFrame | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Anomaly events raised while valid. Every event with value 1 counts, also when one follows another."""
    return _figures(events, within, [ANOMALIES], machine_id, machines, plan)


def anomaly_seconds(
    events: DataFrame,
    within: TimeRange,
    machine_id: int | None = None,
    machines: DataFrame | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Time with an anomaly active while valid; an open anomaly lasts to the end of the range."""
    return _figures(events, within, [ANOMALY_SECONDS], machine_id, machines, plan)


def kpi_summary(
    events: DataFrame,
    within: TimeRange,
    machine_id: int | None = None,
    machines: DataFrame | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """All figures in one pass."""
    names = [PIECES, REJECTED, REJECTED_SHARE, ANOMALIES, ANOMALY_SECONDS]
    return _figures(events, within, names, machine_id, machines, plan)


def anomaly_valid_overlap(
    events: DataFrame, within: TimeRange, machine_id: int | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """The stretches behind `anomaly_seconds`: anomaly active, data valid, inside the range."""
    log = validity.log_of(events, within, [schema.DATA_VALID, schema.MACHINE_ANOMALY], [], machine_id)
    stretches = intervals.both_active(
        log.withColumn("value", F.col("value") == 1),
        ["machine_id"],
        validity.order(),
        F.when(validity.is_variable(schema.DATA_VALID), F.col("value")),
        F.when(validity.is_variable(schema.MACHINE_ANOMALY), F.col("value")),
        plan,
        until=within.end,
    )
    begin = F.greatest(F.col("interval_start"), within.start)
    return stretches.withColumn("interval_start", begin).filter(F.col("interval_end") > F.col("interval_start"))
