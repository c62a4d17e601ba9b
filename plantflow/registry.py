"""Every operator as a query over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow import schema
from plantflow.functions import timecols
from plantflow.operators import intervals, orders, segments, validity, watchdog
from plantflow.params import TimeRange, WatchdogConfig, instant, to_micros
from plantflow.plans import history, kpis, observability, sqlfunctions, states
from plantflow.sources import eventtable, sample, shared, snapshots, summaries, wire

Query = Callable[[SparkSession, str], DataFrame]

RANGE = TimeRange.of("2024-01-05", "2024-01-25")
WHOLE_DAYS = TimeRange.of("2024-01-01", "2024-02-01")
PART_DAYS = TimeRange.of("2024-01-05T07:30:00", "2024-01-24T15:45:00")
SEALED = "2024-01-03"
# The sample's lines are slow: half a day and 30 pieces instead of seconds and single pieces.
WATCHDOG = WatchdogConfig(timeout_seconds=43_200, min_pieces=30)
AS_OF = "2025-02-15"
MOMENT = "2024-01-12T06:00:00"
ITEMS = "LinePieceCounter| |MachinePieceCounter"
COUNTERS = (schema.PIECE_COUNTER, schema.REJECT_COUNTER)
GATED = (schema.PIECE_COUNTER, schema.REJECT_COUNTER, schema.LINE_COUNTER, schema.MACHINE_ANOMALY)


def _measured(name: str, key: str, ts: str, column: Callable[[SparkSession, str], DataFrame]):
    """Where hot keys of a table are, looked up once per session and table."""

    @lru_cache(maxsize=64)
    def plan(spark: SparkSession, sf_dir: str) -> segments.SegmentPlan:
        return segments.measure(column(spark, sf_dir), key, ts)

    plan.__name__ = name
    return plan


def _event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("machine_id"), F.col("ts").cast("timestamp").alias("timestamp")
    )


def _order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.production_orders(spark, sf_dir).select("machine_id", "start_date")


machine_plan = _measured("machine_plan", "machine_id", "timestamp", _event_keys)
statement_plan = _measured("statement_plan", "order_id", "timestamp", sample.order_progress)
schedule_plan = _measured("schedule_plan", "machine_id", "start_date", _order_keys)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.machine_events(spark, sf_dir, machine_plan(spark, sf_dir))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.counter_samples(spark, sf_dir, machine_plan(spark, sf_dir))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.production_orders(spark, sf_dir, schedule_plan(spark, sf_dir))


def _meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observability.meter_records(
        sample.log_records(spark, sf_dir), sample.spans(spark, sf_dir), sample.metric_points(spark, sf_dir)
    )


def _parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = wire.filter_topic(sample.messages(spark, sf_dir, machine_plan(spark, sf_dir)), sample.TOPIC_ROOT)
    return wire.parse_payload(received)


def _checked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = wire.parse_payload(sample.damaged_messages(spark, sf_dir, machine_plan(spark, sf_dir)))
    return wire.check(wire.normalise_time(parsed, F.col("ingest_ts")))


# --- ingest -----------------------------------------------------------------------------------------------------------


def ingest_topic_filter(spark, sf_dir):
    received = sample.messages(spark, sf_dir, machine_plan(spark, sf_dir))
    return wire.filter_topic(received, sample.TOPIC_ROOT).select("event_id", "topic")


def ingest_payload_projection(spark, sf_dir):
    return _parsed_messages(spark, sf_dir).select("event_id", *[f.name for f in schema.PAYLOAD])


def ingest_timestamp(spark, sf_dir):
    timed = wire.normalise_time(_parsed_messages(spark, sf_dir), F.col("ingest_ts"))
    return timed.select("event_id", "variable", "timestamp")


def ingest_valid_rows(spark, sf_dir):
    return wire.accepted(_checked_messages(spark, sf_dir))


def ingest_quarantine(spark, sf_dir):
    rejected = wire.quarantined(_checked_messages(spark, sf_dir))
    return rejected.select("event_id", "topic", F.array_join("reject_reasons", ", ").alias("reject_reasons"))


def monitored_items_filter(spark, sf_dir):
    return wire.select_items(_events(spark, sf_dir), ITEMS)


def node_metadata_lookup(spark, sf_dir):
    return wire.with_metadata(sample.node_samples(spark, sf_dir), sample.node_metadata(spark, sf_dir))


def value_to_int(spark, sf_dir):
    return wire.parse_payload(sample.value_texts(spark, sf_dir)).select("event_id", "machine_id", "value")


def static_enrichment(spark, sf_dir):
    return wire.with_constants(_events(spark, sf_dir), {"site": "north", "type": "Tag"})


def payload_roundtrip(spark, sf_dir):
    sent = _events(spark, sf_dir).select("event_id", wire.to_payload(_events(spark, sf_dir)).alias("payload"))
    parsed = wire.parse_payload(sent)
    return parsed.withColumn("timestamp", timecols.from_epoch_seconds(F.col("timestamp"))).select(*schema.MODEL_COLUMNS)


def merged_event_log(spark, sf_dir):
    raw = _samples(spark, sf_dir)
    return watchdog.merged(raw, watchdog.batch(raw, WATCHDOG, plan=machine_plan(spark, sf_dir)))


# --- storage ----------------------------------------------------------------------------------------------------------


def chunk_inventory(spark, sf_dir):
    return eventtable.chunks(_events(spark, sf_dir))


def retention_surviving_chunks(spark, sf_dir):
    return eventtable.chunks(eventtable.retain(_events(spark, sf_dir), AS_OF))


# --- intervals and counters -------------------------------------------------------------------------------------------


def state_intervals(spark, sf_dir):
    return states.state_intervals(sample.state_events(spark, sf_dir), RANGE, plan=machine_plan(spark, sf_dir))


def state_timeline(spark, sf_dir):
    return states.state_timeline(sample.state_events(spark, sf_dir), RANGE, plan=machine_plan(spark, sf_dir))


def state_time_share(spark, sf_dir):
    return states.state_time_share(sample.state_events(spark, sf_dir), RANGE, plan=machine_plan(spark, sf_dir))


def state_known_share(spark, sf_dir):
    chosen = ["InAlarm", "InCycle"]
    return states.state_time_share(
        sample.state_events(spark, sf_dir), RANGE, chosen, known_only=True, plan=machine_plan(spark, sf_dir)
    )


def overlaps_predicate(spark, sf_dir):
    both = [F.col(c) for c in ("start_a", "end_a", "start_b", "end_b")]
    return sample.periods(spark, sf_dir).select("event_id", timecols.overlaps(*both).alias("overlaps"))


def events_in_valid_intervals(spark, sf_dir):
    return validity.gate(_events(spark, sf_dir), RANGE, GATED, plan=machine_plan(spark, sf_dir))


def _optional(df: DataFrame, name: str) -> DataFrame:
    """An integer column with nulls as doubles, since pandas frames differ in how they hold integer nulls."""
    return df.withColumn(name, F.col(name).cast("double"))


def _deltas(spark: SparkSession, sf_dir: str, first: str) -> DataFrame:
    found = validity.counter_deltas(
        _events(spark, sf_dir), RANGE, COUNTERS, first=first, plan=machine_plan(spark, sf_dir)
    )
    return _optional(found, "previous_value")


def counter_deltas(spark, sf_dir):
    return _deltas(spark, sf_dir, "zero")


def counter_deltas_from_zero(spark, sf_dir):
    return _deltas(spark, sf_dir, "value")


def anomaly_valid_overlap(spark, sf_dir):
    return kpis.anomaly_valid_overlap(_events(spark, sf_dir), RANGE, plan=machine_plan(spark, sf_dir))


def interval_intersection(spark, sf_dir):
    """Time in alarm while in cycle."""
    changes = sample.state_events(spark, sf_dir)
    plan = machine_plan(spark, sf_dir)
    alarm = states.state_intervals(changes, RANGE, ["InAlarm"], plan=plan)
    cycle = states.state_intervals(changes, RANGE, ["InCycle"], plan=plan)
    return intervals.intersect(alarm, cycle, ["machine_id"], plan)


# --- production figures -----------------------------------------------------------------------------------------------


def _kpi(report) -> Query:
    def query(spark, sf_dir):
        machines = sample.machines(spark, sf_dir)
        return report(_events(spark, sf_dir), RANGE, machines=machines, plan=machine_plan(spark, sf_dir))

    return query


def kpi_summary_from_days(spark, sf_dir):
    """A range that begins and ends within a day, from summaries of days."""
    events, plan = _events(spark, sf_dir), machine_plan(spark, sf_dir)
    days = history.summarise(events, WHOLE_DAYS, plan)
    return history.kpi_summary(days, events, PART_DAYS, sample.machines(spark, sf_dir), plan)


def kpi_summary_stored(spark, sf_dir):
    """From the stored table: loaded in batches, the last one late, compacted; the states before the range from a snapshot,
    the machines from the register."""
    events, root = _events(spark, sf_dir), f"{shared.folder(spark)}/plant-{uuid.uuid4().hex}"
    states_, register = snapshots.StateSnapshots(f"{root}/states"), snapshots.Register(f"{root}/machines")
    for k in range(3):
        batch = events.filter(F.pmod("event_id", F.lit(3)) == k)
        eventtable.append(batch, f"{root}/events", f"load-{k}")
        states_.correct(batch, f"load-{k}")
        register.add(batch, f"load-{k}")
        if k == 1:
            states_.seal(spark, eventtable.read(spark, f"{root}/events"), SEALED)
    eventtable.compact(spark, f"{root}/events", "2024-02-01")
    register.fold(spark)
    stored = states_.events(eventtable.read(spark, f"{root}/events"), RANGE)
    return kpis.kpi_summary(stored, RANGE, machines=register.read(spark), plan=machine_plan(spark, sf_dir))


def kpi_summary_sql(spark, sf_dir):
    """Through the SQL table function."""
    sqlfunctions.register(spark, _events(spark, sf_dir), sample.machines(spark, sf_dir))
    return spark.sql(f"SELECT * FROM kpi_summary(timestamp_micros({RANGE.start_us}), timestamp_micros({RANGE.end_us}), NULL)")


def machine_register(spark, sf_dir):
    return snapshots.sightings(_events(spark, sf_dir))


def usage_meter_merged(spark, sf_dir):
    """The hourly meter from partial roll-ups of three batches, one of them added twice, folded in between."""
    records, path = _meter(spark, sf_dir), f"{shared.folder(spark)}/meter-{uuid.uuid4().hex}"
    table = summaries.Summaries(path, {"records": "sum", "size": "sum"}, by="window_start")
    for k in (0, 1, 1, 2):
        partial = observability.meter_usage(records.filter(F.pmod(F.xxhash64("ts"), F.lit(3)) == k))
        table.add(partial, f"batch-{k}")
        if k == 1:
            table.fold(spark, partial.schema)
    return table.read(spark, partial.schema)


def pieces_total_one_machine(spark, sf_dir):
    return kpis.pieces_total(_events(spark, sf_dir), RANGE, machine_id=7, plan=machine_plan(spark, sf_dir))


# --- watchdog ---------------------------------------------------------------------------------------------------------

_SAMPLE_COLUMNS = ["event_id", "timestamp", "machine_id", "variable", "value"]


def watchdog_epochs(spark, sf_dir):
    found = watchdog.epochs(_samples(spark, sf_dir), WATCHDOG, plan=machine_plan(spark, sf_dir))
    return found.select(*_SAMPLE_COLUMNS, "epoch", "last_machine_ts")


def line_pieces_since_machine(spark, sf_dir):
    found = watchdog.line_pieces(_samples(spark, sf_dir), WATCHDOG, plan=machine_plan(spark, sf_dir))
    return found.select(*_SAMPLE_COLUMNS, "epoch", "delta", "pieces")


def watchdog_raised(spark, sf_dir):
    found = watchdog.raised(_samples(spark, sf_dir), WATCHDOG, plan=machine_plan(spark, sf_dir))
    return found.select("event_id", "timestamp", "machine_id", "epoch", "last_machine_ts", "pieces")


def watchdog_events(spark, sf_dir):
    return watchdog.batch(_samples(spark, sf_dir), WATCHDOG, plan=machine_plan(spark, sf_dir))


# --- orders -----------------------------------------------------------------------------------------------------------


def order_enrichment(spark, sf_dir):
    found = orders.enrich(_events(spark, sf_dir), _orders(spark, sf_dir), machine_plan(spark, sf_dir))
    return _optional(found.select("event_id", "machine_id", "timestamp", "variable", "order_id"), "order_id")


def order_enrichment_overlapping(spark, sf_dir):
    """The same with orders that stay open or run on into the next ones."""
    number, end = F.col("order_id"), F.col("end_date")
    longer = F.when(number % 7 == 0, F.lit(None)).when(number % 7 == 3, end + F.expr("INTERVAL 20 DAY")).otherwise(end)
    found = orders.enrich(_events(spark, sf_dir), _orders(spark, sf_dir).withColumn("end_date", longer), machine_plan(spark, sf_dir))
    return _optional(found.select("event_id", "machine_id", "timestamp", "variable", "order_id"), "order_id")


def active_order_at(spark, sf_dir):
    return orders.active_at(_orders(spark, sf_dir), instant(to_micros(MOMENT)))


def order_dates(spark, sf_dir):
    return orders.dates(sample.order_progress(spark, sf_dir))


def order_completion(spark, sf_dir):
    return orders.completion(
        sample.order_progress(spark, sf_dir), _orders(spark, sf_dir), statement_plan(spark, sf_dir)
    )


def order_summary(spark, sf_dir):
    return orders.summary(_orders(spark, sf_dir), sample.articles(spark, sf_dir), RANGE)


def order_progress(spark, sf_dir):
    return orders.progress(sample.order_progress(spark, sf_dir), plan=statement_plan(spark, sf_dir)).drop(
        "statement_order"
    )


# --- observability ----------------------------------------------------------------------------------------------------


def _logs(spark, sf_dir) -> DataFrame:
    return observability.parse_logs(sample.log_records(spark, sf_dir), sample.APPLICATION)


def log_parse(spark, sf_dir):
    resource = F.col("resource")
    return _logs(spark, sf_dir).select(
        "event_id",
        "ts",
        "severity",
        "host",
        "component",
        "text",
        observability.dimension(resource, "host.name").alias("resource_host"),
        observability.dimension(resource, "deployment.environment", "default").alias("environment"),
    )


def log_rollup(spark, sf_dir):
    return observability.roll_up_logs(_logs(spark, sf_dir))


def reconnects_per_host(spark, sf_dir):
    return observability.reconnects(_logs(spark, sf_dir))


def usage_meter_hourly(spark, sf_dir):
    return observability.meter_usage(_meter(spark, sf_dir))


def span_latency_histogram(spark, sf_dir):
    return observability.latency_histogram(sample.spans(spark, sf_dir))


def span_exp_histogram(spark, sf_dir):
    return observability.exponential_histogram(sample.spans(spark, sf_dir))


def latency_quantiles(spark, sf_dir):
    histogram = observability.latency_histogram(sample.spans(spark, sf_dir))
    return observability.latency_quantiles(histogram, (0.5, 0.95, 0.99))


def attribute_catalogue(spark, sf_dir):
    return observability.attribute_catalogue(_meter(spark, sf_dir))


_QUERIES: dict[str, Query] = {
    "pieces_total": _kpi(kpis.pieces_total),
    "rejected_total": _kpi(kpis.rejected_total),
    "rejected_percentage": _kpi(kpis.rejected_percentage),
    "anomaly_starts": _kpi(kpis.anomaly_starts),
    "anomaly_seconds": _kpi(kpis.anomaly_seconds),
    "kpi_summary": _kpi(kpis.kpi_summary),
    **{
        query.__name__: query
        for query in (
            pieces_total_one_machine,
            kpi_summary_from_days,
            kpi_summary_stored,
            kpi_summary_sql,
            machine_register,
            usage_meter_merged,
            ingest_topic_filter,
            ingest_payload_projection,
            ingest_timestamp,
            ingest_valid_rows,
            ingest_quarantine,
            monitored_items_filter,
            node_metadata_lookup,
            value_to_int,
            static_enrichment,
            payload_roundtrip,
            merged_event_log,
            chunk_inventory,
            retention_surviving_chunks,
            state_intervals,
            state_timeline,
            state_time_share,
            state_known_share,
            overlaps_predicate,
            events_in_valid_intervals,
            counter_deltas,
            counter_deltas_from_zero,
            anomaly_valid_overlap,
            interval_intersection,
            watchdog_epochs,
            line_pieces_since_machine,
            watchdog_raised,
            watchdog_events,
            order_enrichment,
            order_enrichment_overlapping,
            active_order_at,
            order_dates,
            order_completion,
            order_summary,
            order_progress,
            log_parse,
            log_rollup,
            reconnects_per_host,
            usage_meter_hourly,
            span_latency_histogram,
            span_exp_histogram,
            latency_quantiles,
            attribute_catalogue,
        )
    },
}


def _zoneless(query: Query) -> Query:
    """Timestamps without a zone, as the sample tables have them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name)
                for f in df.schema
            ]
        )

    return run


def queries() -> dict[str, Query]:
    return {name: _zoneless(query) for name, query in _QUERIES.items()}
