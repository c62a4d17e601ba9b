"""Hot keys cut into segments give what plain windows give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantflow import registry
from plantflow.operators import orders, segments, validity, watchdog
from plantflow.plans import kpis, states
from plantflow.sources import sample
from tests import compare

SF = compare.data("sf0.001")
HOUR, DAY = 3_600_000_000, 86_400_000_000


@pytest.fixture(scope="module")
def events(spark):
    return sample.machine_events(spark, SF).persist()


@pytest.fixture(scope="module", params=["hour", "mixed", "all"])
def plan(request):
    some, others = tuple(range(0, 8)), tuple(range(8, 12))
    if request.param == "all":
        return segments.SegmentPlan("machine_id", "timestamp", others=7 * DAY)
    cuts = {"hour": ((HOUR, some),), "mixed": ((HOUR, some), (DAY, others))}
    return segments.SegmentPlan("machine_id", "timestamp", cuts[request.param])


REPORTS = {
    "kpi_summary": lambda ev, plan: kpis.kpi_summary(ev, registry.RANGE, plan=plan),
    "gate": lambda ev, plan: validity.gate(ev, registry.RANGE, registry.GATED, plan=plan),
    "counter_deltas": lambda ev, plan: validity.counter_deltas(ev, registry.RANGE, registry.COUNTERS, plan=plan),
    "anomaly_valid_overlap": lambda ev, plan: kpis.anomaly_valid_overlap(ev, registry.RANGE, plan=plan),
    "epochs": lambda ev, plan: watchdog.epochs(ev, registry.WATCHDOG, plan=plan),
    "line_pieces": lambda ev, plan: watchdog.line_pieces(ev, registry.WATCHDOG, plan=plan),
    "raised": lambda ev, plan: watchdog.raised(ev, registry.WATCHDOG, plan=plan),
    "watchdog": lambda ev, plan: watchdog.batch(ev, registry.WATCHDOG, plan=plan),
}


@pytest.mark.parametrize("name", REPORTS)
def test_machine_reports(events, plan, name):
    got = compare.spark_rows(REPORTS[name](events, plan))
    assert got == compare.spark_rows(REPORTS[name](events, None))
    assert len(got[1]) > 10


def test_state_reports(spark, plan):
    changes = sample.state_events(spark, SF)
    for report in (states.state_intervals, states.state_timeline, states.state_time_share):
        assert compare.spark_rows(report(changes, registry.RANGE, plan=plan)) == compare.spark_rows(
            report(changes, registry.RANGE)
        )


def test_order_enrichment(spark, events, plan):
    scheduled = sample.production_orders(spark, SF)
    assert compare.spark_rows(orders.enrich(events, scheduled, plan)) == compare.spark_rows(
        orders.enrich(events, scheduled)
    )


def test_sample_tables(spark, plan):
    assert compare.spark_rows(sample.machine_events(spark, SF, plan)) == compare.spark_rows(
        sample.machine_events(spark, SF)
    )
    schedule = segments.SegmentPlan("machine_id", "start_date", plan.cuts, plan.others)
    assert compare.spark_rows(sample.production_orders(spark, SF, schedule)) == compare.spark_rows(
        sample.production_orders(spark, SF)
    )


def test_order_reports(spark):
    statements = sample.order_progress(spark, SF)
    scheduled = sample.production_orders(spark, SF)
    month = 30 * DAY
    plan = segments.SegmentPlan("order_id", "timestamp", ((month, tuple(range(0, 700))), (DAY, tuple(range(700, 900)))))
    assert compare.spark_rows(orders.completion(statements, scheduled, plan)) == compare.spark_rows(
        orders.completion(statements, scheduled)
    )
    totals = ["order_id", "timestamp", "produced_qty", "produced_total", "discarded_total", "good_total"]
    assert compare.spark_rows(orders.progress(statements, plan=plan).select(totals)) == compare.spark_rows(
        orders.progress(statements).select(totals)
    )


def test_watchdog_with_negative_counters(spark):
    """A counter may read anything; pieces then go down and an anomaly must still be raised only once per epoch."""
    import random

    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for machine in (1, 2):
        clock = start
        for i in range(400):
            clock += dt.timedelta(seconds=rng.choice([1, 5, 30, 400, 2000]))
            name = "MachinePieceCounter" if rng.random() < 0.08 else "LinePieceCounter"
            rows.append((i, clock, machine, name, "Int32", rng.randint(-20, 30), "R"))
    from plantflow import WatchdogConfig, schema

    samples = spark.createDataFrame(rows, schema.MACHINE_EVENTS)
    cfg = WatchdogConfig(timeout_seconds=60, min_pieces=25)
    plan = segments.SegmentPlan("machine_id", "timestamp", ((HOUR, (1,)), (60_000_000, (2,))))
    got = compare.spark_rows(watchdog.batch(samples, cfg, plan=plan))
    assert got == compare.spark_rows(watchdog.batch(samples, cfg))
    from tests.test_streaming import state_machine

    expected = set()
    for machine in (1, 2):
        mine = [r for r in rows if r[2] == machine]
        simple = [(int((r[1] - start).total_seconds() * 1e6), r[3] == "MachinePieceCounter", r[5]) for r in mine]
        expected |= {(machine, mine[at][0], change) for at, change in state_machine(simple, cfg)}
    where = {name: i for i, name in enumerate(got[0])}
    assert {(r[where["machine_id"]], r[where["event_id"]], r[where["value"]]) for r in got[1]} == expected
    assert len(expected) > 20


def test_measure(spark):
    """One machine with most rows, half of them within a minute; the others are left alone."""
    base = 1_704_067_200_000_000
    hot = spark.range(4000).select(
        F.lit(1).alias("machine_id"),
        F.timestamp_micros(
            F.lit(base) + F.when(F.col("id") < 2000, F.col("id") * 30_000).otherwise(F.col("id") * 600_000_000)
        ).alias("timestamp"),
    )
    even = spark.range(1500).select(
        F.lit(2).alias("machine_id"), F.timestamp_micros(F.lit(base) + F.col("id") * 600_000_000).alias("timestamp")
    )
    few = spark.range(300).select(
        F.lit(3).alias("machine_id"), F.timestamp_micros(F.lit(base) + F.col("id") * 1_000_000).alias("timestamp")
    )
    log = hot.unionByName(even).unionByName(few)
    assert segments.measure(log, "machine_id", "timestamp", max_rows=5000).cuts == ()
    cuts = dict(segments.measure(log, "machine_id", "timestamp", max_rows=1000).cuts)
    assert cuts == {1_000_000: (1,), DAY: (2,)}


def test_measure_many_large_keys(spark, monkeypatch):
    """Too many to list: all are cut alike."""
    monkeypatch.setattr(segments, "MAX_HOT_KEYS", 5)
    log = spark.range(3000).select(
        (F.col("id") % 10).cast("int").alias("machine_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 600_000_000).alias("timestamp"),
    )
    plan = segments.measure(log, "machine_id", "timestamp", max_rows=100)
    assert plan == segments.SegmentPlan("machine_id", "timestamp", others=DAY)
    assert segments.measure(log, "machine_id", "timestamp", max_rows=300).cuts_any is False


def test_one_machine_holds_most_rows(spark):
    """The skew the segments are for: the largest task's share falls with the width of the segments."""
    base = 1_704_067_200_000_000
    log = spark.range(20_000).select(
        F.col("id").alias("event_id"),
        F.timestamp_micros(F.lit(base) + F.col("id") * 60_000_000).alias("timestamp"),
        F.when(F.col("id") % 10 < 8, 1).otherwise((F.col("id") % 97).cast("int")).alias("machine_id"),
        F.when(F.col("id") % 50 == 0, "DataValid").otherwise("MachinePieceCounter").alias("variable"),
        F.lit("Int32").alias("type"),
        F.when(F.col("id") % 50 == 0, (F.col("id") / 50 % 3 > 0).cast("int"))
        .otherwise((F.col("id") * 7 % 301).cast("int"))
        .alias("value"),
        F.lit("R").alias("event_type"),
    )
    from plantflow import TimeRange

    within = TimeRange.of("2024-01-03", "2024-01-12")
    plan = segments.measure(log, "machine_id", "timestamp", max_rows=2000)
    assert plan.hot_keys == (1,)
    hot = log.filter(plan.is_hot())
    largest = hot.groupBy(plan.segment()).count().agg(F.max("count")).first()[0]
    assert largest <= 2000 < hot.count()
    assert compare.spark_rows(kpis.kpi_summary(log, within, plan=plan)) == compare.spark_rows(
        kpis.kpi_summary(log, within)
    )


def _with_nulls(df, key, ts, every=9):
    """Some rows without key, some without time, and a dense second."""
    number = F.abs(F.xxhash64(*df.columns)) % every
    dense = F.lit(dt.datetime(2024, 1, 9, 1)).cast("timestamp")
    return df.withColumns(
        {
            key: F.when(number == 0, F.lit(None)).otherwise(F.col(key)),
            ts: F.when(number == 1, F.lit(None)).when(number.isin(2, 3), dense).otherwise(F.col(ts)),
        }
    )


CUTS = {
    "listed": lambda key, ts: segments.SegmentPlan(key, ts, ((HOUR, (1, 2, 3)), (1_000_000, (4, 5, 6)), (1, (7, 8)))),
    "others": lambda key, ts: segments.SegmentPlan(key, ts, others=DAY),
    "finest": lambda key, ts: segments.SegmentPlan(key, ts, others=1),
}


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("name", ["epochs", "line_pieces", "raised", "watchdog"])
def test_nulls_and_dense_seconds(events, name, cut):
    odd = _with_nulls(events, "machine_id", "timestamp").persist()
    got = compare.spark_rows(REPORTS[name](odd, CUTS[cut]("machine_id", "timestamp")))
    assert got == compare.spark_rows(REPORTS[name](odd, None)) and len(got[1]) > 5


@pytest.mark.parametrize("cut", CUTS)
def test_nulls_in_orders(spark, events, cut):
    statements = _with_nulls(sample.order_progress(spark, SF), "order_id", "timestamp").persist()
    plan = CUTS[cut]("order_id", "timestamp")
    assert compare.spark_rows(orders.progress(statements, plan=plan)) == compare.spark_rows(orders.progress(statements))
    odd, plan = _with_nulls(events, "machine_id", "timestamp").persist(), CUTS[cut]("machine_id", "timestamp")
    scheduled = sample.production_orders(spark, SF)
    assert compare.spark_rows(orders.enrich(odd, scheduled, plan)) == compare.spark_rows(orders.enrich(odd, scheduled))


def test_stretches_of_segments(spark, monkeypatch):
    """Values carried over many stretches, some of them without any."""
    monkeypatch.setattr(segments, "SEGMENTS_OF_STRETCH", 3)
    rows = [(k % 2, dt.datetime(2024, 1, 1) + dt.timedelta(hours=5 * k), k, k if k % 7 == 0 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "machine_id int, timestamp timestamp, n int, v int")
    order = [F.col("timestamp"), F.col("n")]
    values = {
        "last": segments.last(F.col("v")),
        "before": segments.previous(F.col("v")),
        "first": segments.first(F.col("v")),
        "next": segments.following(F.col("n")),
        "sum": segments.total(F.col("n")),
    }

    def run(plan):
        return compare.spark_rows(
            segments.by_heat(df, ["machine_id"], order, plan, lambda r, c: segments.running(r, ["machine_id"], order, values, c))
        )

    assert run(segments.SegmentPlan("machine_id", "timestamp", others=HOUR)) == run(None)
