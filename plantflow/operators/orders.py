"""Production orders: what ran when, how far it got."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantflow.functions import timecols
from plantflow.operators import segments
from plantflow.operators.segments import SegmentPlan
from plantflow.params import TimeRange, instant

# 0001-01-01, the first moment timestamps reach.
_BEFORE_ALL_US = -62_135_596_800_000_000
_FOREVER_US = 2**63 - 1


def reigns(orders: DataFrame) -> DataFrame:
    """The order of each machine from moment to moment: the last started among those still running.

    Rows (machine_id, since, until, order_id) that do not overlap; times in microseconds. An order that no other one of
    its machine overlaps stands as it is. Those that overlap, directly or over others, are swept in order of their start
    with those still running on a stack, batch by batch, so memory holds what runs at once and no more.
    """
    # An order without an end outlasts every event; one that ends before it starts never runs.
    until = F.coalesce(F.unix_micros("end_date"), F.lit(_FOREVER_US))
    given = orders.filter(F.col("machine_id").isNotNull() & F.col("start_date").isNotNull())
    placed = given.select("machine_id", F.unix_micros("start_date").alias("since"), until.alias("until"), "order_id").filter("until > since")
    by_start = Window.partitionBy("machine_id").orderBy("since", "order_id")
    earlier = F.max("until").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    apart = placed.withColumn("_apart", (earlier.isNull() | (F.col("since") >= earlier)).cast("int"))
    told = apart.withColumns({"_group": F.sum("_apart").over(by_start.rowsBetween(Window.unboundedPreceding, 0)), "_next": F.lead("_apart").over(by_start)})
    alone = (F.col("_apart") == 1) & (F.coalesce("_next", F.lit(1)) == 1)
    columns = placed.columns
    swept = told.filter(~alone).repartition("machine_id", "_group").sortWithinPartitions("machine_id", "since", "order_id").select(columns)
    return told.filter(alone).select(columns).unionByName(_swept(swept))


def _swept(swept: DataFrame) -> DataFrame:
    names = swept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, now, running, out = None, 0, [], []

        def advance(to: int) -> None:
            nonlocal now
            while running and now < to:
                until, order = running[-1]
                if until > now:
                    out.append((machine, now, min(until, to), order))
                    now = min(until, to)
                if until <= now:
                    running.pop()

        types = None
        for batch in batches:
            types = batch.schema
            for key, since, until, order in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != machine:
                    advance(_FOREVER_US)
                    machine, running = key, []
                advance(since)
                now = since
                if until > since:
                    running.append((until, order))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=types)
            out = []
        if types is not None:
            advance(_FOREVER_US)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=types)

    return swept.mapInArrow(run, swept.schema)


def enrich(events: DataFrame, orders: DataFrame, plan: SegmentPlan | None = None) -> DataFrame:
    """Events with the order running on their machine, null where none runs: one row an event.

    Of orders that overlap, the last started among those still running counts. The moments at which a machine's order
    changes are merged into the events and carried along: linear in events plus orders, where a join on the machine
    alone would compare every event with every order of its machine.
    """
    samples = events.select(
        "machine_id",
        "timestamp",
        F.lit(True).alias("_is_sample"),
        F.col("event_id").alias("_tie"),
        F.struct(*[F.col(c) for c in events.columns]).alias("_sample"),
    )
    starts = reigns(orders).select(
        "machine_id",
        F.timestamp_micros("since").alias("timestamp"),
        F.lit(False).alias("_is_sample"),
        F.col("order_id").alias("_tie"),
        "order_id",
        F.col("until").alias("_until"),
    )
    merged = samples.unionByName(starts, allowMissingColumns=True)
    order = [F.col("timestamp"), F.col("_is_sample"), F.col("_tie")]
    latest = {"_order": segments.last(F.col("order_id")), "_ends": segments.last(F.col("_until"))}
    carried = segments.by_heat(
        merged, ["machine_id"], order, plan, lambda rows, cut: segments.running(rows, ["machine_id"], order, latest, cut)
    )
    runs = F.unix_micros("timestamp") < F.col("_ends")
    return carried.filter(F.col("_is_sample")).select("_sample.*", F.when(runs, F.col("_order")).alias("order_id"))


def active_at(orders: DataFrame, moment: Column, machine_id: int | None = None) -> DataFrame:
    """Order running on each machine at an instant, the last started if several do."""
    picked = orders if machine_id is None else orders.filter(F.col("machine_id") == machine_id)
    running = picked.filter(timecols.contains(F.col("start_date"), F.col("end_date"), moment))
    return running.groupBy("machine_id").agg(F.max_by("order_id", F.struct("start_date", "order_id")).alias("order_id"))


def overlaps(orders: DataFrame) -> DataFrame:
    """Orders that start on a machine while an earlier one still runs."""
    before = Window.partitionBy("machine_id").orderBy("start_date", "order_id").rowsBetween(Window.unboundedPreceding, -1)
    until = F.coalesce(F.unix_micros("end_date"), F.lit(_FOREVER_US))
    return orders.withColumn("_before", F.max(until).over(before)).filter(F.unix_micros("start_date") < F.col("_before")).drop("_before")


def dates(statements: DataFrame) -> DataFrame:
    """Start and end of an order: its first and last progress statement."""
    return statements.groupBy("order_id").agg(
        F.min("timestamp").alias("start_date"), F.max("timestamp").alias("end_date")
    )


def progress(
    statements: DataFrame,
    order_id: int | None = None,
    within: TimeRange | None = None,
    plan: SegmentPlan | None = None,
) -> DataFrame:
    """Progress statements with running totals; statements report what was made since the one before.

    `order_id` None means all. A range shows its statements with totals that count from the start of the order.
    """
    picked = statements if order_id is None else statements.filter(F.col("order_id") == order_id)
    if within is not None:
        picked = picked.filter(F.col("timestamp") < within.end)
    order = [F.col("timestamp"), F.col("statement_order")]
    totals = {
        "produced_total": segments.total(F.col("produced_qty")),
        "discarded_total": segments.total(F.col("discarded_qty")),
    }
    summed = segments.by_heat(
        picked, ["order_id"], order, plan, lambda rows, cut: segments.running(rows, ["order_id"], order, totals, cut)
    )
    if within is not None:
        summed = summed.filter(F.col("timestamp") >= within.start)
    return summed.withColumn("good_total", F.col("produced_total") - F.col("discarded_total"))


def completion(statements: DataFrame, orders: DataFrame, plan: SegmentPlan | None = None) -> DataFrame:
    """When each order with statements reached its target of good pieces; null while it has not.

    An order's target is put ahead of its statements and carried along them, which takes one shuffle and no join.
    """
    good = F.col("produced_qty") - F.col("discarded_qty")
    targets = orders.select(
        "order_id", instant(_BEFORE_ALL_US).alias("timestamp"), F.lit(False).alias("_is_statement"), "target_qty"
    )
    log = statements.select(
        "order_id", "timestamp", F.lit(True).alias("_is_statement"), "statement_order", good.alias("_good")
    ).unionByName(targets, allowMissingColumns=True)
    order = [F.col("timestamp"), F.col("_is_statement"), F.col("statement_order")]
    carried = {"good_total": segments.total(F.col("_good")), "_target": segments.last(F.col("target_qty"))}
    summed = segments.by_heat(
        log, ["order_id"], order, plan, lambda rows, cut: segments.running(rows, ["order_id"], order, carried, cut)
    )
    return (
        summed.filter(F.col("_is_statement") & F.col("_target").isNotNull())
        .groupBy("order_id")
        .agg(
            F.max("_target").alias("target_qty"),
            F.sum("_good").alias("good_qty"),
            F.min(F.when(F.col("good_total") >= F.col("_target"), F.col("timestamp"))).alias("completed_at"),
            F.max("timestamp").alias("last_statement_at"),
        )
    )


def summary(
    orders: DataFrame, articles: DataFrame, within: TimeRange, order_id: int | None = None, machine_id: int | None = None
) -> DataFrame:
    """Orders that ran during the range, with their article."""
    picked = orders if order_id is None else orders.filter(F.col("order_id") == order_id)
    if machine_id is not None:
        picked = picked.filter(F.col("machine_id") == machine_id)
    until = F.coalesce(F.col("end_date"), F.greatest(within.end, F.col("start_date")))
    ran = picked.filter(timecols.overlaps(F.col("start_date"), until, within.start, within.end))
    return ran.join(articles, "article_id").select(
        "order_id", "machine_id", "article_id", "description", "target_qty", "start_date", "end_date"
    )
