"""Production figures of long ranges from summaries of days.

What a machine's day adds to the figures depends on what it begins with: whether data are valid, whether an anomaly is
on, and the last reading of each counter. A summary keeps apart what is certain (after the day's first change of validity
or anomaly) from what only counts if an earlier state holds on, and what the day hands on. Two neighbouring summaries
make one of the same kind, so any range is whole days from the stored table, two parts of days from the events, and one
pass over a few rows per machine.

    summaries = DaySummaries("/data/days")
    summaries.refresh(eventtable.read(spark, table), ["2024-01-19"])       # closed days, and days with late events
    history.kpi_summary(summaries.read(spark), events, TimeRange.of("2023-01-05 07:30", "2024-01-24 15:45"), machines)
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow import schema
from plantflow.functions import timecols, values
from plantflow.operators import segments, validity
from plantflow.operators.segments import SegmentPlan
from plantflow.params import TimeRange, instant
from plantflow.plans import kpis
from plantflow.sources import eventlog

COUNTERS = {"pieces": schema.PIECE_COUNTER, "rejects": schema.REJECT_COUNTER}
VARIABLES = (schema.DATA_VALID, schema.MACHINE_ANOMALY, *COUNTERS.values())

_LONGS = ["head_starts", "body_starts", "none_us", "valid_us", "anomaly_us", "both_us"]
_LONGS += [f"{name}_{part}" for name in COUNTERS for part in ("head", "body")]
_INTS = ["last_valid", "last_anomaly", *(f"{name}_{part}" for name in COUNTERS for part in ("head_first", "head_last", "tail_last"))]
#: machine_id, begin and end of the time summed up, and:
#: head_* counts if data are valid as the day begins, body_* counts anyhow;
#: none_us, valid_us, anomaly_us, both_us: time in which both states are the earlier ones, valid is on and the anomaly's
#: state the earlier one, the other way round, and both are on;
#: last_*: states handed on, null for the earlier ones; *_tail_last: the last reading since the last change of validity.
FIELDS = T.StructType(
    [T.StructField("machine_id", T.IntegerType()), *(T.StructField(c, T.TimestampType()) for c in ("begin", "end"))]
    + [T.StructField(c, T.LongType()) for c in _LONGS]
    + [T.StructField(c, T.IntegerType()) for c in _INTS]
)


def _day_start(ts: Column) -> Column:
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(timecols.DAY_US)))


def summarise(events: DataFrame, within: TimeRange, plan: SegmentPlan | None = None) -> DataFrame:
    """One summary per machine and UTC day with events in the range; the first and last day are cut to the range."""
    log = eventlog.during(eventlog.of_variables(events, VARIABLES), within)
    day = _day_start(F.col("timestamp"))
    log = log.select("machine_id", "timestamp", "event_id", "variable", "value", day.alias("_day")).filter("machine_id IS NOT NULL")
    carried = validity.validity() | {
        "anomaly": segments.last(F.when(validity.is_variable(schema.MACHINE_ANOMALY), F.col("value"))),
        "until": segments.following(F.col("timestamp")),
    }
    for name, variable in COUNTERS.items():
        carried |= validity.readings_before(variable, name)
    keys = ["machine_id", "_day"]
    rows = segments.by_heat(log, keys, validity.order(), plan, lambda r, cut: segments.running(r, keys, validity.order(), carried, cut))

    end = F.least(F.timestamp_micros(F.unix_micros("_day") + F.lit(timecols.DAY_US)), within.end)
    stands = F.unix_micros(F.coalesce("until", end)) - F.unix_micros("timestamp")
    head, valid = F.col("valid").isNull(), F.col("valid") == 1
    no_anomaly, anomaly = F.col("anomaly").isNull(), F.col("anomaly") == 1
    started = validity.is_variable(schema.MACHINE_ANOMALY) & (F.col("value") == 1)
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(validity.order())])

    def last_of(variable: str) -> Column:
        return F.max_by("value", F.when(validity.is_variable(variable), place))

    figures = {
        "first_row": F.min("timestamp"),
        "head_starts": F.count(F.when(started & head, 1)),
        "body_starts": F.count(F.when(started & valid, 1)),
        "none_us": F.sum(F.when(head & no_anomaly, stands)),
        "valid_us": F.sum(F.when(valid & no_anomaly, stands)),
        "anomaly_us": F.sum(F.when(head & anomaly, stands)),
        "both_us": F.sum(F.when(valid & anomaly, stands)),
        "last_valid": last_of(schema.DATA_VALID),
        "last_anomaly": last_of(schema.MACHINE_ANOMALY),
        "_since": F.max("valid_since"),
    }
    for name, variable in COUNTERS.items():
        reading = validity.is_variable(variable)
        before = F.when(head | (F.col(f"{name}_ts") >= F.col("valid_since")), F.col(f"{name}_value"))
        delta = values.counter_delta(F.col("value"), before)
        figures[f"{name}_head"] = F.sum(F.when(reading & head, delta))
        figures[f"{name}_body"] = F.sum(F.when(reading & valid, delta))
        figures[f"{name}_head_first"] = F.min_by("value", F.when(reading & head, place))
        figures[f"{name}_head_last"] = F.max_by("value", F.when(reading & head, place))
        figures[f"_{name}"] = F.max_by(F.struct("value", "valid_since"), F.when(reading, place))
    summed = rows.groupBy(*keys).agg(*[f.alias(c) for c, f in figures.items()])
    begin = F.greatest("_day", within.start)
    zero = F.lit(0).cast("bigint")
    shown = {c: F.coalesce(c, zero) for c in _LONGS} | {c: F.col(c) for c in _INTS if not c.endswith("tail_last")}
    shown["none_us"] = shown["none_us"] + F.unix_micros("first_row") - F.unix_micros(begin)
    for name in COUNTERS:
        shown[f"{name}_tail_last"] = F.when(F.col(f"_{name}.valid_since") == F.col("_since"), F.col(f"_{name}.value"))
    return summed.select("machine_id", begin.alias("begin"), end.alias("end"), *[shown[c].alias(c) for c in (*_LONGS, *_INTS)])


def _opening(events: DataFrame, within: TimeRange) -> DataFrame:
    """The states each machine begins the range with, as a summary of no time."""
    changes = eventlog.of_variables(events, (schema.DATA_VALID, schema.MACHINE_ANOMALY))
    slim = changes.select("machine_id", "variable", "timestamp", "event_id", "value", *[c for c in changes.columns if c == eventlog.EVENT_DATE])
    latest = F.struct("timestamp", "event_id", "value")
    found = (
        eventlog.before(slim, within)
        .filter("machine_id IS NOT NULL")
        .groupBy("machine_id")
        .agg(*[F.max(F.when(validity.is_variable(v), latest))["value"].alias(c) for c, v in (("last_valid", schema.DATA_VALID), ("last_anomaly", schema.MACHINE_ANOMALY))])
    )
    empty = {c: F.lit(0).cast("bigint") for c in _LONGS} | {c: F.lit(None).cast("int") for c in _INTS}
    empty |= {c: F.col(c) for c in ("last_valid", "last_anomaly")}
    return found.select("machine_id", within.start.alias("begin"), within.start.alias("end"), *[c.alias(n) for n, c in empty.items()])


def merged(summaries: DataFrame, until: Column | None = None) -> DataFrame:
    """One summary per machine from summaries of times that follow one another, gaps filled with the states that hold on;
    to `until`, or to the last one's end. Merging parts of the rows first, in runs, gives the same."""
    ordered = Window.partitionBy("machine_id").orderBy("begin", "end")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    carried = {c: F.last(f"last_{c}", ignorenulls=True).over(earlier) for c in ("valid", "anomaly")}
    next_begin = F.lead("begin").over(ordered)
    rows = summaries.withColumns({f"_in_{c}": v for c, v in carried.items()} | {"_next": F.coalesce(next_begin, F.col("end") if until is None else until)})
    for name in COUNTERS:
        changed = F.col("last_valid").isNotNull()
        handed = F.when(changed, F.struct(F.col(f"{name}_tail_last").alias("v"))).when(F.col(f"{name}_head_last").isNotNull(), F.struct(F.col(f"{name}_head_last").alias("v")))
        rows = rows.withColumn(f"_hand_{name}", handed).withColumn(f"_before_{name}", F.last(f"_hand_{name}", ignorenulls=True).over(earlier)["v"])

    in_valid, in_anomaly = F.col("_in_valid"), F.col("_in_anomaly")
    out_valid, out_anomaly = F.coalesce("last_valid", in_valid), F.coalesce("last_anomaly", in_anomaly)
    gap = F.unix_micros("_next") - F.unix_micros("end")

    def known(state: Column) -> Column:
        return state.isNotNull()

    def when(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(F.lit(0).cast("bigint"))

    none, valid, anomaly, both = (F.col(f"{c}_us") for c in ("none", "valid", "anomaly", "both"))
    times = {
        "none_us": when(~known(in_valid) & ~known(in_anomaly), none) + when(~known(out_valid) & ~known(out_anomaly), gap),
        "valid_us": when(~known(in_anomaly), valid) + when((in_valid == 1) & ~known(in_anomaly), none) + when((out_valid == 1) & ~known(out_anomaly), gap),
        "anomaly_us": when(~known(in_valid), anomaly) + when((in_anomaly == 1) & ~known(in_valid), none) + when((out_anomaly == 1) & ~known(out_valid), gap),
        "both_us": both + when(in_anomaly == 1, valid) + when(in_valid == 1, anomaly)
        + when((in_valid == 1) & (in_anomaly == 1), none) + when((out_valid == 1) & (out_anomaly == 1), gap),
    }
    sums = {c: F.sum(v) for c, v in times.items()}
    sums["head_starts"] = F.sum(when(~known(in_valid), F.col("head_starts")))
    sums["body_starts"] = F.sum(F.col("body_starts") + when(in_valid == 1, F.col("head_starts")))
    place = F.struct("begin", "end")
    for name in COUNTERS:
        first, before = F.col(f"{name}_head_first"), F.col(f"_before_{name}")
        joint = F.col(f"{name}_head") + when(first.isNotNull(), values.counter_delta(first, before))
        sums[f"{name}_head"] = F.sum(when(~known(in_valid), joint))
        sums[f"{name}_body"] = F.sum(F.col(f"{name}_body") + when(in_valid == 1, joint))
        in_head = F.when(~known(in_valid), place)
        sums[f"{name}_head_first"] = F.min_by(first, F.when(first.isNotNull(), in_head))
        last = F.col(f"{name}_head_last")
        sums[f"{name}_head_last"] = F.max_by(last, F.when(last.isNotNull(), in_head))
        sums[f"_tail_{name}"] = F.max_by(f"_hand_{name}", F.when(F.col(f"_hand_{name}").isNotNull(), place))
    for c in ("last_valid", "last_anomaly"):
        sums[c] = F.max_by(c, F.when(F.col(c).isNotNull(), place))
    found = rows.groupBy("machine_id").agg(F.min("begin").alias("begin"), F.max("_next").alias("end"), *[s.alias(c) for c, s in sums.items()])
    # what is handed on is a tail only after a change of validity; before one it is the head's
    tails = {f"{name}_tail_last": F.when(F.col("last_valid").isNotNull(), F.col(f"_tail_{name}.v")) for name in COUNTERS}
    return found.withColumns(tails).select(*FIELDS.names)


def kpi_summary(
    days: DataFrame, events: DataFrame, within: TimeRange, machines: DataFrame | None = None, plan: SegmentPlan | None = None
) -> DataFrame:
    """All figures of `kpis.kpi_summary` from stored days; of the events only parts of days at the range's ends and the
    states before it are read."""
    first, last = -(-within.start_us // timecols.DAY_US) * timecols.DAY_US, within.end_us // timecols.DAY_US * timecols.DAY_US
    opening = _opening(events, within)
    if first >= last:
        parts = summarise(events, within, plan)
    else:
        edges = [TimeRange(within.start_us, first), TimeRange(last, within.end_us)]
        parts = days.filter((F.col("begin") >= instant(first)) & (F.col("end") <= instant(last)))
        if eventlog.EVENT_DATE in days.columns:
            parts = parts.filter(F.col(eventlog.EVENT_DATE).between(F.lit(eventlog.date_of(first)), F.lit(eventlog.date_of(last - 1))))
        parts = parts.select(*FIELDS.names)
        for edge in edges:
            if edge.length_us:
                parts = parts.unionByName(summarise(events, edge, plan))
    whole = merged(opening.unionByName(parts), within.end)
    pieces, rejects = F.col("pieces_body"), F.col("rejects_body")
    shown = whole.select(
        "machine_id",
        pieces.alias(kpis.PIECES),
        rejects.alias(kpis.REJECTED),
        F.col("body_starts").alias(kpis.ANOMALIES),
        F.col("both_us").alias("_us"),
    )
    everyone = kpis.machines_of(events) if machines is None else machines.select("machine_id").distinct()
    zero = F.lit(0).cast("bigint")
    every = everyone.join(shown, "machine_id", "left").withColumns({c: F.coalesce(c, zero) for c in (kpis.PIECES, kpis.REJECTED, kpis.ANOMALIES, "_us")})
    return every.select(
        "machine_id",
        kpis.PIECES,
        kpis.REJECTED,
        values.percentage(F.col(kpis.REJECTED), F.col(kpis.PIECES)).alias(kpis.REJECTED_SHARE),
        kpis.ANOMALIES,
        timecols.seconds(F.col("_us")).alias(kpis.ANOMALY_SECONDS),
    )


@dataclass(frozen=True)
class DaySummaries:
    """The stored summaries, a folder for each UTC day."""

    path: str

    def refresh(self, stored: DataFrame, days: Sequence[str], plan: SegmentPlan | None = None) -> None:
        """Computes ISO dates anew from the event table: closed days, and days that late events have come for."""
        for day in sorted(set(days)):
            begin = date.fromisoformat(day)
            rows = summarise(stored, TimeRange.of(begin.isoformat(), (begin + timedelta(days=1)).isoformat()), plan)
            rows.write.mode("overwrite").parquet(f"{self.path.rstrip('/')}/event_date={day}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All days; a report opens those of its range only."""
        stored = spark.read.schema(T.StructType([*FIELDS.fields, T.StructField("event_date", T.DateType())])).parquet(self.path)
        return stored


def touched_days(events: DataFrame) -> list[str]:
    """ISO dates of a batch's events, at most as many as the batch has dates."""
    day = F.date_from_unix_date(F.floor(F.unix_micros("timestamp") / F.lit(timecols.DAY_US)).cast("int"))
    return sorted(r[0] for r in events.filter("timestamp IS NOT NULL").select(day.cast("string")).distinct().collect())
