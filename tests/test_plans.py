"""Shapes of physical plans."""

import re

import pytest

from plantflow import registry
from plantflow.operators import orders, validity, watchdog
from plantflow.plans import kpis, states
from plantflow.sources import eventtable, sample
from tests import compare


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "events")
    eventtable.append(sample.machine_events(spark, compare.data("sf0.001")), path)
    return eventtable.read(spark, path)


def plan_of(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def exchanges(df):
    return len(re.findall(r"Exchange (hash|range|Single)", plan_of(df)))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_pairwise_joins(spark, name):
    plan = plan_of(registry.queries()[name](spark, compare.data("sf0.001")))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_figures_shuffle_the_log_once(spark, stored):
    """One shuffle condenses the state before the range, one orders the log; the machine list is given."""
    machines = spark.createDataFrame([(1,)], "machine_id int")
    for report in (kpis.pieces_total, kpis.anomaly_seconds, kpis.kpi_summary):
        df = report(stored, registry.RANGE, machines=machines)
        assert exchanges(df) - plan_of(df).count("Scan ExistingRDD") <= 2


def test_operators_shuffle_once(spark, stored):
    assert exchanges(watchdog.batch(stored, registry.WATCHDOG)) == 1
    assert exchanges(validity.counter_deltas(stored, registry.RANGE, registry.COUNTERS)) == 2
    assert exchanges(states.state_time_share(stored, registry.RANGE, ["DataValid"])) == 2
    scheduled = sample.production_orders(spark, compare.data("sf0.001"))
    # The schedule's own window and the merged log.
    assert exchanges(orders.enrich(stored, scheduled)) == 2


def test_completion_shuffles_once(spark):
    """Statements and targets together, by order; the aggregation needs no further shuffle."""
    sf = compare.data("sf0.001")
    scheduled = sample.production_orders(spark, sf)
    assert exchanges(orders.completion(sample.order_progress(spark, sf), scheduled)) == 1
