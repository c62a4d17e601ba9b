"""Hand-made cases of the production figures and the other reports, and known totals on the sample tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from plantflow import TimeRange, WatchdogConfig, registry, schema
from plantflow.functions import histograms, timecols, values
from plantflow.operators import intervals, orders, validity, watchdog
from plantflow.plans import kpis, observability, states
from plantflow.sources import sample
from tests import compare

START = dt.datetime(2024, 1, 1)
RANGE = TimeRange.of("2024-01-01T01:00:00", "2024-01-01T02:00:00")  # minutes 60 to 120


def log(spark, *rows, machine=7):
    """(minute, variable, value) as events; the row number is the event number."""
    return logs_of(spark, {machine: rows})


def logs_of(spark, rows_of_machines):
    return spark.createDataFrame(
        [
            (i, START + dt.timedelta(minutes=minute), machine, variable, "x", value, "R")
            for machine, rows in rows_of_machines.items()
            for i, (minute, variable, value) in enumerate(rows)
        ],
        schema.MACHINE_EVENTS,
    )


def by_machine(df, column):
    return {r.machine_id: r[column] for r in df.collect()}


def readings(*pairs, name="MachinePieceCounter"):
    return [(minute, name, value) for minute, value in pairs]


def valid(*pairs):
    return readings(*pairs, name="DataValid")


def anomaly(*pairs):
    return readings(*pairs, name="MachineAnomaly")


def only(df):
    (row,) = df.collect()
    return row[1]


PIECES = {
    "nothing valid": (readings((70, 5), (80, 9)), 0),
    "valid since before the range": (valid((10, 1)) + readings((70, 5), (80, 9)), 4),
    "reading before the range is no baseline": (valid((10, 1)) + readings((50, 10), (70, 15), (80, 18)), 3),
    "reset": (valid((10, 1)) + readings((70, 5), (75, 9), (80, 2), (85, 4)), 8),
    "two intervals side by side": (
        valid((10, 1), (78, 1)) + readings((70, 5), (75, 9), (80, 12), (85, 20)),
        12,
    ),
    "reading at the start of an interval counts": (valid((70, 1)) + readings((70, 5), (75, 9)), 4),
    "reading at the end of an interval does not": (
        valid((10, 1), (75, 0)) + readings((70, 5), (74, 7), (75, 9)),
        2,
    ),
    "reading at the end of the range does not": (valid((10, 1)) + readings((70, 5), (120, 9)), 0),
    "gap between intervals": (
        valid((10, 1), (75, 0), (80, 1)) + readings((70, 5), (72, 6), (77, 50), (82, 60), (84, 61)),
        2,
    ),
    "validity lost before the range": (valid((10, 1), (20, 0)) + readings((70, 5), (75, 9)), 0),
    "no rows in the range": (valid((10, 1)) + readings((50, 10)), 0),
    "same reading twice": (valid((10, 1)) + readings((70, 5), (75, 5), (80, 6)), 1),
}


def test_pieces(spark):
    """One machine per case."""
    cases = list(PIECES)
    events = logs_of(spark, {m: PIECES[case][0] for m, case in enumerate(cases)})
    for report in (kpis.pieces_total, kpis.kpi_summary):
        found = by_machine(report(events, RANGE), kpis.PIECES)
        assert {case: found[m] for m, case in enumerate(cases)} == {case: PIECES[case][1] for case in cases}
    renamed = F.when(F.col("variable") == schema.PIECE_COUNTER, schema.REJECT_COUNTER).otherwise(F.col("variable"))
    found = by_machine(kpis.rejected_total(events.withColumn("variable", renamed), RANGE), kpis.REJECTED)
    assert {case: found[m] for m, case in enumerate(cases)} == {case: PIECES[case][1] for case in cases}


def test_first_reading_counts_whole_on_request(spark):
    events = log(spark, *valid((10, 1), (78, 1)), *readings((70, 5), (75, 9), (80, 12)))
    deltas = validity.counter_deltas(events, RANGE, ["MachinePieceCounter"], first="value")
    assert [r.delta for r in deltas.orderBy("timestamp").collect()] == [5, 4, 12]
    with pytest.raises(ValueError):
        values.counter_delta(F.lit(1), F.lit(1), "other")


def test_rejected_percentage(spark):
    rejects = readings((70, 0), (80, 3), name="MachineRejectedPieces")
    assert only(kpis.rejected_percentage(log(spark, *valid((10, 1)), *rejects), RANGE)) == 0.0
    pieces = readings((71, 0), (81, 12))
    assert only(kpis.rejected_percentage(log(spark, *valid((10, 1)), *rejects, *pieces), RANGE)) == 25.0


ANOMALIES = {
    "twice in a row": (valid((10, 1)) + anomaly((70, 1), (75, 1)), 2, 50 * 60),
    "raised while invalid": (valid((80, 1)) + anomaly((70, 1)), 0, 40 * 60),
    "raised before the range": (valid((10, 1)) + anomaly((20, 1), (90, 0)), 0, 30 * 60),
    "raised at the end of the range": (valid((10, 1)) + anomaly((120, 1)), 0, 0),
    "cleared": (valid((10, 1)) + anomaly((70, 1), (75, 0)), 1, 5 * 60),
    "validity lost meanwhile": (valid((10, 1), (75, 0), (80, 1)) + anomaly((70, 1), (90, 0)), 1, 15 * 60),
    "raised as validity starts": (anomaly((70, 1)) + valid((70, 1)), 1, 50 * 60),
    "raised as validity ends": (anomaly((80, 1)) + valid((70, 1), (80, 0)), 0, 0),
    "two intervals side by side": (valid((10, 1), (80, 1)) + anomaly((70, 1), (90, 0)), 1, 20 * 60),
}


def test_anomalies(spark):
    """One machine per case."""
    cases = list(ANOMALIES)
    events = logs_of(spark, {m: ANOMALIES[case][0] for m, case in enumerate(cases)})
    starts = {m: ANOMALIES[case][1] for m, case in enumerate(cases)}
    seconds = {m: ANOMALIES[case][2] for m, case in enumerate(cases)}
    assert by_machine(kpis.anomaly_starts(events, RANGE), kpis.ANOMALIES) == starts
    assert by_machine(kpis.anomaly_seconds(events, RANGE), kpis.ANOMALY_SECONDS) == seconds
    summary = kpis.kpi_summary(events, RANGE)
    assert by_machine(summary, kpis.ANOMALIES) == starts and by_machine(summary, kpis.ANOMALY_SECONDS) == seconds
    length = intervals.length_us(F.col("interval_start"), F.col("interval_end"))
    stretches = kpis.anomaly_valid_overlap(events, RANGE).groupBy("machine_id").agg(F.sum(length).alias("us"))
    assert by_machine(stretches, "us") == {m: s * 1_000_000 for m, s in seconds.items() if s}


def test_machines(spark):
    events = log(spark, *valid((10, 1)), *readings((70, 5), (80, 9))).unionByName(
        log(spark, *readings((70, 1)), machine=8)
    )
    registry_of = spark.createDataFrame([(7,), (8,), (9,)], "machine_id int")
    everyone = {r[0]: r[1] for r in kpis.pieces_total(events, RANGE).collect()}
    assert everyone == {7: 4, 8: 0}
    listed = {r[0]: r[1] for r in kpis.pieces_total(events, RANGE, machines=registry_of).collect()}
    assert listed == {7: 4, 8: 0, 9: 0}
    assert [tuple(r) for r in kpis.pieces_total(events, RANGE, machine_id=9).collect()] == [(9, 0)]


def test_range_must_not_end_before_it_starts():
    with pytest.raises(ValueError):
        TimeRange.of("2024-01-02", "2024-01-01")


OVERLAPS = {
    "apart": (0, 1, 2, 3, False),
    "reversed ends": (5, 0, 4, 9, True),
    "equal starts": (3, 3, 3, 9, True),
    "touching": (0, 5, 5, 9, False),
    "instant inside": (0, 9, 4, 4, True),
    "instant at the end": (0, 9, 9, 9, False),
    "inside": (0, 9, 3, 4, True),
    "two equal instants": (4, 4, 4, 4, True),
    "two instants": (4, 4, 5, 5, False),
}


def test_overlaps(spark):
    rows = [(name, *[START + dt.timedelta(hours=h) for h in v[:4]]) for name, v in OVERLAPS.items()]
    df = spark.createDataFrame(rows, "name string, a timestamp, b timestamp, c timestamp, d timestamp")
    cols = [F.col(c) for c in "abcd"]
    found = df.select("name", timecols.overlaps(*cols), timecols.overlaps(*cols[2:], *cols[:2])).collect()
    for name, there, back in found:
        assert there == back == OVERLAPS[name][4], name


def _intervals(spark, *pairs):
    rows = [(1, START + dt.timedelta(hours=a), START + dt.timedelta(hours=b)) for a, b in pairs]
    return spark.createDataFrame(rows, "machine_id int, interval_start timestamp, interval_end timestamp")


def test_intersect(spark):
    left = _intervals(spark, (0, 4), (4, 6), (8, 9), (12, 12))
    right = _intervals(spark, (1, 2), (3, 5), (6, 8), (11, 13))
    got = intervals.intersect(left, right, ["machine_id"]).orderBy("interval_start").collect()
    hours = [tuple(int((t - START).total_seconds() // 3600) for t in r[1:]) for r in got]
    assert hours == [(1, 2), (3, 4), (4, 5)]


def test_state_reports(spark):
    events = log(spark, (10, "InCycle", 1), (90, "InCycle", 0), (100, "InAlarm", 1), (130, "InAlarm", 0), (30, "Other", 1))
    share = {r.variable: r.share_percent for r in states.state_time_share(events, RANGE).collect()}
    assert share == {"InCycle": 50.0, "InAlarm": pytest.approx(100 / 3)}
    known = {r.variable: r.share_percent for r in states.state_time_share(events, RANGE, known_only=True).collect()}
    assert known == {"InCycle": 50.0, "InAlarm": 100.0}
    chosen = states.state_time_share(events, RANGE, ["InAlarm"], machine_id=7).collect()
    assert [r.variable for r in chosen] == ["InAlarm"]
    timeline = states.state_timeline(events, RANGE, machine_id=7).collect()
    assert [(r.variable, r.value) for r in timeline] == [("InAlarm", 1), ("InCycle", 1), ("InCycle", 0)]


# Seconds, M for a machine and L for a line sample, value; timeout 20 seconds.
WATCHDOG = [
    ("exactly the timeout", 1, [(0, "M", 1), (20, "L", 5)], []),
    ("past the timeout", 1, [(0, "M", 1), (21, "L", 5)], [(21, 1)]),
    ("a piece short", 5, [(0, "M", 1), (21, "L", 4)], []),
    ("just enough pieces", 5, [(0, "M", 1), (21, "L", 5)], [(21, 1)]),
    ("first line sample counts whole", 100, [(0, "L", 100), (30, "L", 100)], [(30, 1)]),
    ("after a reset what is read counts", 4, [(0, "L", 90), (1, "M", 1), (30, "L", 4)], [(30, 1)]),
    ("and no more", 5, [(0, "L", 90), (1, "M", 1), (30, "L", 4)], []),
    (
        "raised once, cleared by the next machine sample whatever it reads",
        1,
        [(0, "M", 5), (30, "L", 3), (40, "L", 6), (50, "M", 5), (60, "M", 5)],
        [(30, 1), (50, 0)],
    ),
    ("machine sample without anomaly", 1, [(0, "M", 1), (5, "L", 3), (100, "M", 2)], []),
    ("no line sample after the timeout", 1, [(0, "M", 1), (15, "L", 3)], []),
    ("the line count outlives machine samples", 1, [(0, "L", 10), (1, "M", 1), (30, "L", 10)], []),
]


@pytest.mark.parametrize("min_pieces", sorted({case[1] for case in WATCHDOG}))
def test_watchdog(spark, min_pieces):
    """One machine per case."""
    cases = [case for case in WATCHDOG if case[1] == min_pieces]
    names = {"L": schema.LINE_COUNTER, "M": schema.PIECE_COUNTER}
    samples = logs_of(spark, {m: [(t / 60, names[n], v) for t, n, v in c[2]] for m, c in enumerate(cases)})
    found = {m: [] for m in range(len(cases))}
    for r in watchdog.batch(samples, WatchdogConfig(20, min_pieces)).orderBy("timestamp").collect():
        found[r.machine_id].append(((r.timestamp - START).total_seconds(), r.value))
    assert {cases[m][0]: changes for m, changes in found.items()} == {c[0]: c[3] for c in cases}


def test_orders(spark):
    at = lambda h: START + dt.timedelta(hours=h)
    scheduled = spark.createDataFrame(
        [(1, 10, 7, 100, at(0), at(2)), (2, 11, 7, 50, at(3), None)],
        "order_id long, article_id long, machine_id int, target_qty long, start_date timestamp, end_date timestamp",
    )
    events = log(spark, (0, "x", 1), (119, "x", 1), (120, "x", 1), (180, "x", 1), (900, "x", 1))
    found = orders.enrich(events, scheduled).orderBy("timestamp").collect()
    assert [r.order_id for r in found] == [1, 1, None, 2, 2]
    other = log(spark, (0, "x", 1), machine=8)
    assert [r.order_id for r in orders.enrich(other, scheduled).collect()] == [None]
    assert [tuple(r) for r in orders.active_at(scheduled, F.lit(at(1))).collect()] == [(7, 1)]
    assert orders.active_at(scheduled, F.lit(at(2))).count() == 0
    articles = spark.createDataFrame([(10, "bolt"), (11, "nut")], "article_id long, description string")
    shown = orders.summary(scheduled, articles, TimeRange.of(at(2), at(9))).collect()
    assert [(r.order_id, r.description) for r in shown] == [(2, "nut")]
    assert orders.summary(scheduled, articles, TimeRange.of(at(0), at(9)), order_id=1).count() == 1
    statements = spark.createDataFrame(
        [(1, at(0), 1, 60, 5), (1, at(1), 2, 44, 0), (1, at(2), 3, 1, 0), (2, at(4), 4, 9, 0)],
        "order_id long, timestamp timestamp, statement_order long, produced_qty int, discarded_qty int",
    )
    done = {r.order_id: r.completed_at for r in orders.completion(statements, scheduled).collect()}
    assert done == {1: at(2), 2: None}
    within = TimeRange.of(at(1), at(3))
    progress = orders.progress(statements, order_id=1, within=within).orderBy("timestamp").collect()
    assert [(r.produced_total, r.good_total) for r in progress] == [(104, 99), (105, 100)]


def test_histogram_quantile(spark):
    def quantile(counts, q):
        limits = F.array(F.lit(1.0), F.lit(2.0), F.lit(4.0))
        values_of = F.array(*[F.lit(float(c)) for c in counts])
        return spark.range(1).select(histograms.histogram_quantile(limits, values_of, q)).first()[0]

    assert quantile([0, 0, 0, 0], 0.5) is None
    assert quantile([4, 0, 0, 0], 0.5) == 0.5
    assert quantile([0, 0, 10, 0], 0.9) == pytest.approx(3.8)
    assert quantile([1, 0, 0, 9], 0.5) == 4.0
    assert quantile([2, 2, 0, 0], 0.5) == 1.0
    assert quantile([0, 3, 0, 0], 0.0) == 1.0


def test_exponential_bucket(spark):
    cases = {1.0: -1, 1.5: 0, 2.0: 0, 2.1: 1, 4.0: 1, 0.5: -2, 0.0: None, -1.0: None}
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    found = df.select("v", histograms.exponential_bucket(F.col("v"), 0)).collect()
    assert {r[0]: r[1] for r in found} == cases


def test_logs(spark):
    rows = [
        (1, "INFO", "PLANT | GW-1 | MQTT | Client started."),
        (2, "DEBUG", "PLANT | GW-1 | MQTT | noise"),
        (3, "ERROR", "PLANT | GW-1 | OPC UA | lost | New connection attempt in 3s...\nmore"),
        (4, "INFO", "PLANT | GW-2 | Server ready"),
        (5, "INFO", "something else"),
    ]
    logs = spark.createDataFrame(rows, "event_id long, severity string, body string")
    parsed = observability.parse_logs(logs, "PLANT").orderBy("event_id").collect()
    assert [(r.event_id, r.host, r.component, r.text) for r in parsed] == [
        (1, "GW-1", "MQTT", "Client started."),
        (3, "GW-1", "OPC UA", "lost | New connection attempt in 3s...\nmore"),
        (4, "GW-2", None, "Server ready"),
    ]
    counted = observability.reconnects(observability.parse_logs(logs, "PLANT")).collect()
    assert [tuple(r) for r in counted] == [("GW-1", 1)]


# --- totals on the sample tables --------------------------------------------------------------------------------------

TOTALS = {
    "sf0.001": (1743, 1455, 50, 10679278692485, 226),
    "sf0.01": (20199, 11021, 511, 93230666490441, 1954),
}


@pytest.mark.parametrize("sf", TOTALS)
def test_totals(spark, sf):
    events = sample.machine_events(spark, compare.data(sf))
    row = (
        kpis.kpi_summary(events, registry.RANGE)
        .agg(
            F.sum("total_pieces_counted"),
            F.sum("total_rejected_pieces"),
            F.sum("total_anomalies"),
            F.sum(F.round(F.col("total_anomaly_seconds") * 1e6).cast("long")),
        )
        .first()
    )
    read = validity.gate(events, registry.RANGE, registry.COUNTERS).count()
    assert (*row, read) == TOTALS[sf]


STATE_TIMES = {
    "sf0.001": {
        "InAlarm": (15743805884785, 90),
        "InBypass": (14818568494297, 110),
        "InCycle": (13622449027836, 108),
        "InWarning": (11914045519795, 79),
    },
    "sf0.01": {
        "InAlarm": (123576514669629, 865),
        "InBypass": (127258422925825, 871),
        "InCycle": (123592032437982, 840),
        "InWarning": (125098671580825, 906),
    },
}


@pytest.mark.parametrize("sf", STATE_TIMES)
def test_state_totals(spark, sf):
    length = intervals.length_us(F.col("interval_start"), F.col("interval_end"))
    found = (
        states.state_intervals(sample.state_events(spark, compare.data(sf)), registry.RANGE)
        .groupBy("variable")
        .agg(F.sum(length), F.count("*"))
        .collect()
    )
    assert {r[0]: (r[1], r[2]) for r in found} == STATE_TIMES[sf]


@pytest.mark.parametrize(("sf", "expected"), [("sf0.001", (1000, 991, 751873)), ("sf0.01", (10000, 9878, 75476443))])
def test_enrichment_totals(spark, sf, expected):
    found = registry.queries()["order_enrichment"](spark, compare.data(sf))
    assert tuple(found.agg(F.count("*"), F.count("order_id"), F.sum("order_id")).first()) == expected


@pytest.mark.parametrize(("sf", "expected"), [("sf0.001", (1473, 694, 476)), ("sf0.01", (14743, 6974, 4860))])
def test_completion_totals(spark, sf, expected):
    found = registry.queries()["order_completion"](spark, compare.data(sf))
    early = F.count(F.when(F.col("completed_at") < F.col("last_statement_at"), 1))
    assert tuple(found.agg(F.count("*"), F.count("completed_at"), early).first()) == expected


def test_watchdog_and_observability_totals(spark):
    sf = compare.data("sf0.01")
    assert registry.queries()["watchdog_events"](spark, sf).count() == 1185
    logs = observability.parse_logs(sample.log_records(spark, sf), sample.APPLICATION, "DEBUG")
    found = {r[0]: r[1] for r in logs.groupBy("component").count().collect()}
    assert found == {"MQTT": 3467, "OPC UA": 3285, "MESAPI": 3248}
    spans = registry.queries()["span_latency_histogram"](spark, sf).groupBy("bucket").agg(F.sum("spans"))
    assert {r[0]: r[1] for r in spans.collect()} == dict(
        enumerate((14, 166, 210, 759, 667, 4519, 2349, 1255, 61))
    )
    p95 = {r.service_name: round(r.p95, 3) for r in registry.queries()["latency_quantiles"](spark, sf).collect()}
    assert p95 == {"click": 200.904, "error": 199.375, "purchase": 192.119, "signup": 197.652, "view": 196.621}


@pytest.mark.parametrize("scale", [0, 3, 8])
def test_exponential_buckets_at_their_bounds(spark, scale):
    """A power of two belongs to the bucket it ends; the next number above to the following one."""
    rows = [(2.0**k, math.nextafter(2.0**k, math.inf), k * 2**scale) for k in range(-300, 301)]
    df = spark.createDataFrame(rows, "at double, above double, i int")
    buckets = [histograms.exponential_bucket(F.col(c), scale).alias(c) for c in ("at", "above")]
    assert all((r["at"], r["above"]) == (r["i"] - 1, r["i"]) for r in df.select("i", *buckets).collect())
