"""Figures as SQL table functions: equal to the reports, with arguments that reach the scan."""

import pytest

from plantflow import registry
from plantflow.plans import kpis, sqlfunctions
from plantflow.sources import eventtable, sample
from tests import compare
from tests.test_storage import _scans

ARGS = "TIMESTAMP '2024-01-07 03:00:00', TIMESTAMP '2024-01-21 20:00:00'"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "events")
    eventtable.append(sample.machine_events(spark, compare.data("sf0.001")), path)
    events = eventtable.read(spark, path)
    assert sqlfunctions.register(spark, events, sample.machines(spark, compare.data("sf0.001"))) == list(sqlfunctions.FUNCTIONS)
    return events


@pytest.mark.parametrize("name", sqlfunctions.FUNCTIONS)
def test_functions_equal_reports(spark, stored, name):
    within = registry.TimeRange.of("2024-01-07T03:00:00", "2024-01-21T20:00:00")
    report = getattr(kpis, name)
    assert compare.spark_rows(spark.sql(f"SELECT * FROM {name}({ARGS}, NULL)")) == compare.spark_rows(report(stored, within))
    for machine in (7, 999):
        found = spark.sql(f"SELECT * FROM {name}({ARGS}, {machine})")
        assert compare.spark_rows(found) == compare.spark_rows(report(stored, within, machine_id=machine))


def test_arguments_reach_the_scan(spark, stored):
    scans = _scans(spark.sql(f"SELECT * FROM pieces_total({ARGS}, 7)"))
    of_table = [s for s in scans if "machine_id" in s["PushedFilters"]]
    assert len(of_table) == 2 and all("EqualTo(machine_id,7)" in s["PushedFilters"] for s in of_table)
    inside = [s for s in of_table if ">= 2024-01-07" in s["PartitionFilters"]]
    assert len(inside) == 1 and "<= 2024-01-21" in inside[0]["PartitionFilters"]
    assert all("variable" in s["PartitionFilters"] for s in of_table)


def test_in_other_queries(spark, stored):
    both = spark.sql(f"SELECT count(*) FROM kpi_summary({ARGS}, NULL) k JOIN pieces_total({ARGS}, NULL) p USING (machine_id, total_pieces_counted)")
    assert both.first()[0] == 15
