"""Streams against their batch twins."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantflow import WatchdogConfig, registry
from plantflow.operators import orders, watchdog
from plantflow.plans import kpis, observability
from plantflow.sources import eventtable, sample, wire
from plantflow.streaming import ingest
from plantflow.streaming import observability as live
from plantflow.streaming import watchdog as live_watchdog
from tests import compare

NOW = {"availableNow": True}


def state_machine(samples, cfg):
    """The watchdog as one would write it for a single machine: (time, is machine sample, value) -> changes."""
    changes = []
    anomaly, pieces, line, since = False, 0, 0, samples[0][0] if samples else 0
    for at, (ts, is_machine, value) in enumerate(samples):
        if is_machine:
            since, pieces = ts, 0
            if anomaly:
                changes.append((at, 0))
            anomaly = False
            continue
        pieces += value if value < line else value - line
        line = value
        if not anomaly and ts - since > cfg.timeout_us and pieces >= cfg.min_pieces:
            anomaly = True
            changes.append((at, 1))
    return changes


SAMPLES = st.lists(st.tuples(st.integers(0, 9_000_000), st.booleans(), st.integers(-3, 40)), min_size=1, max_size=60)


@settings(max_examples=300, deadline=None)
@given(SAMPLES, st.lists(st.integers(1, 59), max_size=4), st.integers(0, 12))
def test_arrays_equal_state_machine(gaps, cuts, min_pieces):
    cfg = WatchdogConfig(timeout_seconds=20, min_pieces=min_pieces)
    times = np.cumsum([g for g, _, _ in gaps])
    samples = [(int(t), m, v) for t, (_, m, v) in zip(times, gaps)]
    state, found, start = None, [], 0
    for end in sorted({c for c in cuts if c < len(samples)} | {len(samples)}):
        part = samples[start:end]
        state, change = live_watchdog.advance(
            state,
            np.array([p[0] for p in part], dtype=np.int64),
            np.array([p[1] for p in part], dtype=bool),
            np.array([p[2] for p in part], dtype=np.int64),
            cfg,
        )
        found += [(start + int(i), int(change[i])) for i in np.flatnonzero(change >= 0)]
        start = end
    assert found == state_machine(samples, cfg)


@pytest.mark.parametrize("files", [1, 4])
def test_watchdog_stream_equals_batch(spark, tmp_path, files):
    """In one micro-batch and in several, with rows of a file in any order."""
    samples = sample.counter_samples(spark, compare.data("sf0.001")).persist()
    rows = sorted(samples.collect(), key=lambda r: (r.timestamp, r.event_id))
    source = tmp_path / "in"
    source.mkdir()
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size : (i + 1) * size]
        random.Random(i).shuffle(part)
        with open(source / f"part-{i}.json", "w") as out:
            for r in part:
                out.write(json.dumps({**r.asDict(), "timestamp": r.timestamp.isoformat()}) + "\n")
        # The file source takes files in the order of their age.
        import os

        os.utime(source / f"part-{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    arriving = ingest.read_json(spark, str(source), samples.schema, max_files=1)
    query = (
        live_watchdog.stream(arriving, registry.WATCHDOG)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**NOW)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    got = compare.spark_rows(spark.read.parquet(str(tmp_path / "out")))
    expected = compare.spark_rows(watchdog.batch(samples, registry.WATCHDOG))
    assert got == expected
    assert len(got[1]) > 50


def test_late_samples_are_corrected(spark, tmp_path):
    """A stream whose files come in a wrong order, plus corrections of the machines that were late, is the batch."""
    samples = sample.counter_samples(spark, compare.data("sf0.001")).persist()
    late = samples.filter("event_id % 6 = 0 AND machine_id < 6")
    source = tmp_path / "in"
    for turn, rows in enumerate((samples.join(late, "event_id", "left_anti").select(samples.columns), late)):
        rows.coalesce(1).write.parquet(str(source / str(turn)))
        arriving = spark.readStream.schema(samples.schema).parquet(str(source / "*"))
        stream = live_watchdog.stream(arriving, registry.WATCHDOG).writeStream.format("parquet")
        stream.option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start(str(tmp_path / "out")).awaitTermination()
    derived = spark.read.parquet(str(tmp_path / "out"))
    expected = compare.spark_rows(watchdog.batch(samples, registry.WATCHDOG))
    assert compare.spark_rows(derived) != expected
    found = watchdog.corrections(samples, derived, registry.WATCHDOG, machines=late).persist()
    assert {r.machine_id for r in found.collect()} <= set(range(6)) and {r.retracted for r in found.collect()} == {True, False}
    mended = watchdog.corrected(derived, found)
    assert compare.spark_rows(mended) == expected == compare.spark_rows(watchdog.corrected(mended, found))
    assert watchdog.corrections(samples, mended, registry.WATCHDOG).count() == 0


def _write_messages(rows, path):
    with open(path, "w") as out:
        for r in rows:
            out.write(
                json.dumps(
                    {
                        "topic": r.topic,
                        "payload": r.payload,
                        "message_id": r.event_id,
                        # samples of these say when they were taken, validity would go by the order of receipt
                        **({} if r["_unordered"] else {"received_at": r.ingest_ts.isoformat()}),
                    }
                )
                + "\n"
            )


def test_ingest_with_restart(spark, tmp_path):
    """Messages arrive, the query stops, more arrive, it goes on: table and quarantine as from one batch."""
    messages = sample.damaged_messages(spark, compare.data("sf0.001"))
    rows = sorted(messages.collect(), key=lambda r: r.event_id)
    source, table, rejected = (str(tmp_path / n) for n in ("in", "table", "quarantine"))
    (tmp_path / "in").mkdir()

    def run():
        for query in ingest.start(
            spark,
            source,
            table,
            rejected,
            str(tmp_path / "checkpoints"),
            sample.TOPIC_ROOT,
            registry.WATCHDOG,
            NOW,
            max_files=1,
        ):
            query.awaitTermination()

    _write_messages(rows[:400], f"{source}/a.json")
    run()
    first = eventtable.read(spark, table).count()
    _write_messages(rows[400:], f"{source}/b.json")
    run()

    kept = wire.filter_topic(messages, sample.TOPIC_ROOT)
    accepted, quarantine = wire.validate(wire.normalise_time(wire.parse_payload(kept), F.col("ingest_ts")))
    expected = watchdog.merged(accepted, watchdog.batch(accepted, registry.WATCHDOG))
    stored = eventtable.read(spark, table)
    assert 0 < first < stored.count()
    assert compare.spark_rows(stored.drop("event_date")) == compare.spark_rows(expected)
    back = spark.read.parquet(rejected)
    assert sorted(r.event_id for r in back.collect()) == sorted(r.event_id for r in quarantine.collect())


def _received(spark, tmp_path, records):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    run = ingest.start(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "q"), str(tmp_path / "cp"), "prod/plant", trigger=NOW)
    for query in run:
        query.awaitTermination()


def _payload(variable, value, machine=7):
    kind = "Boolean" if variable == "DataValid" else "Int32"
    fields = {"timestamp": 1704067200.0, "machine_id": machine, "variable": variable, "type": kind, "value": value, "event_type": "R"}
    return {"topic": "prod/plant/7/", "payload": json.dumps(fields)}


def test_time_of_receipt_is_optional_for_samples_only(spark, tmp_path):
    _received(spark, tmp_path, [_payload("DataValid", 1), _payload("LinePieceCounter", 5), _payload("LinePieceCounter", "12d")])
    (row,) = eventtable.read(spark, str(tmp_path / "t")).collect()
    assert (row.variable, row.value, row.timestamp.year) == ("LinePieceCounter", 5, 2024)
    reasons = sorted(r.reject_reasons[0] for r in spark.read.parquet(str(tmp_path / "q")).collect())
    assert reasons == ["no order of receipt", "no value"]


@pytest.mark.parametrize("sent", [(0, 1), (1, 0)])
def test_validity_keeps_the_order_of_receipt(spark, tmp_path, sent):
    """Two changes of many machines in one micro-batch end as they were sent."""
    records = [
        {**_payload("DataValid", value, machine), "received_at": "2024-01-01T00:00:00", "message_id": 1000 * turn + machine}
        for machine in range(50)
        for turn, value in enumerate(sent)
    ]
    random.Random(1).shuffle(records)
    _received(spark, tmp_path, records)
    last = eventtable.read(spark, str(tmp_path / "t")).groupBy("machine_id").agg(F.max_by("value", "event_id").alias("v"))
    assert [r.v for r in last.collect()] == [sent[1]] * 50


def test_samples_and_publishing(spark, tmp_path):
    record = {"timestamp": 1704067200.123, "machine_id": 7, "type": "Int32", "value": 12, "event_type": "R"}
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "a.json", "w") as out:
        for name in ("LinePieceCounter", "InCycle"):
            out.write(json.dumps({**record, "variable": name}) + "\n")
    arriving = ingest.read_samples(spark, str(tmp_path / "in"), "LinePieceCounter| |")
    timed = arriving.withColumn("timestamp", F.timestamp_micros(F.rint(F.col("timestamp") * 1e6).cast("long")))
    typed = timed.withColumn("value", F.col("value").cast("int"))
    ingest.publish(typed, "prod/plant", str(tmp_path / "out"), str(tmp_path / "cp"), NOW).awaitTermination()
    (row,) = spark.read.schema("topic string, payload string").json(str(tmp_path / "out")).collect()
    assert row.topic == "prod/plant/7/"
    assert json.loads(row.payload) == {**record, "variable": "LinePieceCounter"}


def test_orders_are_stored_with_events(spark, tmp_path):
    """Open, overlapping and late ones, and orders that come while the stream runs."""
    sf = compare.data("sf0.001")
    events = sample.machine_events(spark, sf)
    scheduled = sample.production_orders(spark, sf)
    until = F.when(F.col("order_id") % 7 == 0, F.lit(None)).otherwise(F.col("end_date") + F.expr("INTERVAL 9 DAYS"))
    scheduled = scheduled.withColumn("end_date", until).persist()
    known = str(tmp_path / "orders")
    arriving = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in" / "*"))

    def run():
        ingest.append_to_table(
            arriving, str(tmp_path / "t"), str(tmp_path / "cp"), NOW, orders=lambda: spark.read.parquet(known)
        ).awaitTermination()

    scheduled.filter("order_id % 2 = 0").write.parquet(known)
    events.filter("event_id % 3 = 0").write.parquet(str(tmp_path / "in" / "a"))
    run()
    scheduled.filter("order_id % 2 = 1").write.mode("append").parquet(known)
    events.filter("event_id % 3 > 0").write.parquet(str(tmp_path / "in" / "b"))
    run()
    stored = eventtable.read(spark, str(tmp_path / "t"), with_orders=True).select("event_id", "order_id")
    first = orders.enrich(events.filter("event_id % 3 = 0"), scheduled.filter("order_id % 2 = 0"))
    later = orders.enrich(events.filter("event_id % 3 > 0"), scheduled)
    assert compare.spark_rows(stored) == compare.spark_rows(first.union(later).select("event_id", "order_id"))
    assert orders.overlaps(scheduled).count() > 0


def test_one_file_per_date_and_variable(spark, tmp_path):
    events = sample.machine_events(spark, compare.data("sf0.001")).filter("machine_id < 3").repartition(8)
    events.write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    ingest.append_to_table(arriving, str(tmp_path / "t"), str(tmp_path / "cp"), NOW).awaitTermination()
    stored = eventtable.read(spark, str(tmp_path / "t"))
    files = stored.select(F.col("_metadata.file_path")).distinct().count()
    assert files == stored.select("event_date", "variable").distinct().count()
    assert stored.count() == events.count()


def test_late_records_count(spark, tmp_path):
    """Roll-ups kept over files that come in any order are those of one batch."""
    sf = compare.data("sf0.001")
    spans = sample.spans(spark, sf).persist()
    logs = observability.parse_logs(sample.log_records(spark, sf), "PLANT").drop("resource").persist()
    kinds = {
        "latency": (live.latency_histogram, observability.latency_histogram, spans),
        "exponential": (live.exponential_histogram, observability.exponential_histogram, spans),
        "meter": (live.meter_usage, observability.meter_usage, observability.meter_records(spans=spans)),
        "logs": (live.roll_up_logs, observability.roll_up_logs, logs),
    }
    for name, (on_stream, on_batch, records) in kinds.items():
        source, place = tmp_path / name / "in", str(tmp_path / name / "out")
        for turn in (2, 0, 1):  # the same hours come again and again, and older ones after newer ones
            records.filter(F.pmod(F.xxhash64("ts"), F.lit(3)) == turn).write.parquet(str(source / str(turn)))
            arriving = spark.readStream.schema(records.schema).parquet(str(source / "*"))
            on_stream(arriving, place, str(tmp_path / name / "cp"), NOW).awaitTermination()
        assert compare.spark_rows(live.read(spark, place)) == compare.spark_rows(on_batch(records))


def test_one_table_for_all(spark, tmp_path):
    """Streamed, restarted, backfilled, retained and compacted, with a repeated batch, and read as a whole."""
    events = sample.machine_events(spark, compare.data("sf0.001")).persist()
    table, source = str(tmp_path / "t"), tmp_path / "in"
    arriving = spark.readStream.schema(events.schema).parquet(str(source / "*"))
    for turn in (0, 1):
        events.filter(f"event_id % 4 = {turn}").write.parquet(str(source / str(turn)))
        ingest.append_to_table(arriving, table, str(tmp_path / "cp"), NOW).awaitTermination()
    eventtable.append(events.filter("event_id % 4 = 2"), table)
    for _ in range(2):
        eventtable.append(events.filter("event_id % 4 = 3"), table, "backfill-7")
    assert compare.spark_rows(eventtable.read(spark, table).drop("event_date")) == compare.spark_rows(events)
    assert eventtable.drop_expired(spark, table, registry.AS_OF)
    kept = compare.spark_rows(eventtable.retain(events, registry.AS_OF))
    assert compare.spark_rows(eventtable.read(spark, table).drop("event_date")) == kept
    assert len(eventtable.compact(spark, table, "2024-01-21")) > 5
    assert compare.spark_rows(eventtable.read(spark, table).drop("event_date")) == kept
    closed = eventtable.read(spark, table).filter("event_date < '2024-01-21'")
    files = closed.select("_metadata.file_path").distinct().count()
    assert files == closed.select("event_date", "variable").distinct().count()
    summary = kpis.kpi_summary(eventtable.read(spark, table), registry.RANGE)
    assert compare.spark_rows(summary) == compare.spark_rows(kpis.kpi_summary(eventtable.retain(events, registry.AS_OF), registry.RANGE))
