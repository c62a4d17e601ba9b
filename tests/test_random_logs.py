"""Random logs with many shared timestamps against a plain computation, one machine per log."""

import datetime as dt
import random

from pyspark.sql import functions as F

from plantflow import TimeRange, schema
from plantflow.operators import segments, validity
from plantflow.plans import kpis
from tests import compare

START = dt.datetime(2024, 1, 1)
FROM, TO = 20, 80  # minutes
RANGE = TimeRange.of(START + dt.timedelta(minutes=FROM), START + dt.timedelta(minutes=TO))
NAMES = ["DataValid", "DataValid", "MachineAnomaly", "MachinePieceCounter", "MachinePieceCounter", "MachineRejectedPieces"]


def random_logs(count, seed):
    rng = random.Random(seed)
    rows = []
    for machine in range(count):
        for number in range(rng.randint(0, 25)):
            name = rng.choice(NAMES)
            value = rng.choice([0, 1, 1]) if name in NAMES[:3] else rng.randint(0, 9)
            rows.append((len(rows), machine, rng.randrange(0, 100, 5), name, value))
    return rows


def stretches(rows, name):
    """[start, end) of every change of one variable, the last open to the end of the range."""
    changes = sorted((minute, number, value) for number, _, minute, n, value in rows if n == name and minute <= TO)
    ends = [c[0] for c in changes[1:]] + [TO]
    return [(c[0], end) for c, end in zip(changes, ends) if c[2] == 1]


def figures(rows):
    intervals = [(max(s, FROM), min(e, TO)) for s, e in stretches(rows, "DataValid")]
    intervals = [(s, e) for s, e in intervals if s < e]

    def advance(name):
        total = 0
        for s, e in intervals:
            inside = sorted((m, number, v) for number, _, m, n, v in rows if n == name and s <= m < e)
            for before, now in zip(inside, inside[1:]):
                total += now[2] - before[2] if now[2] >= before[2] else now[2]
        return total

    pieces, rejects = advance("MachinePieceCounter"), advance("MachineRejectedPieces")
    starts = sum(
        s <= m < e for s, e in intervals for _, _, m, n, v in rows if n == "MachineAnomaly" and v == 1
    )
    lost = sum(
        max(0, min(e, end) - max(s, start)) for s, e in intervals for start, end in stretches(rows, "MachineAnomaly")
    )
    return pieces, rejects, rejects * 100.0 / pieces if pieces else 0.0, starts, lost * 60.0


def test_figures(spark):
    rows = random_logs(800, 11)
    events = spark.createDataFrame(
        [(n, START + dt.timedelta(minutes=m), machine, name, "x", v, "R") for n, machine, m, name, v in rows],
        schema.MACHINE_EVENTS,
    )
    expected = {m: figures([r for r in rows if r[1] == m]) for m in {r[1] for r in rows}}
    plans = (
        None,
        segments.SegmentPlan("machine_id", "timestamp", others=600_000_000),
        segments.SegmentPlan("machine_id", "timestamp", ((60_000_000, tuple(range(0, 800, 3))),)),
    )
    for plan in plans:
        found = {r[0]: tuple(r)[1:] for r in kpis.kpi_summary(events, RANGE, plan=plan).collect()}
        assert found == expected
        overlap = kpis.anomaly_valid_overlap(events, RANGE, plan=plan)
        seconds = F.sum(F.unix_micros("interval_end") - F.unix_micros("interval_start")) / 1e6
        lost = {r[0]: r[1] for r in overlap.groupBy("machine_id").agg(seconds).collect()}
        assert lost == {m: f[4] for m, f in expected.items() if f[4]}
    assert sum(f[3] for f in expected.values()) > 300
    counted = [compare.spark_rows(validity.counter_deltas(events, RANGE, NAMES[3:], plan=p)) for p in plans]
    assert counted[0] == counted[1] == counted[2]
