"""The stored event table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from plantflow import TimeRange, registry, schema
from plantflow.plans import kpis
from plantflow.sources import eventtable, sample
from tests import compare


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "events")
    eventtable.append(sample.machine_events(spark, compare.data("sf0.001")), path)
    return path


def test_roundtrip(spark, stored):
    got = eventtable.read(spark, stored).drop("event_date")
    assert compare.spark_rows(got) == compare.spark_rows(sample.machine_events(spark, compare.data("sf0.001")))


def test_append_adds(spark, tmp_path):
    events = sample.machine_events(spark, compare.data("sf0.001"))
    path = str(tmp_path / "t")
    eventtable.append(events.filter("machine_id < 5"), path)
    eventtable.append(events.filter("machine_id >= 5"), path)
    assert eventtable.read(spark, path).count() == 1000


def test_reports_on_the_table(spark, stored):
    events = eventtable.read(spark, stored)
    assert compare.spark_rows(kpis.kpi_summary(events, registry.RANGE)) == compare.spark_rows(
        kpis.kpi_summary(sample.machine_events(spark, compare.data("sf0.001")), registry.RANGE)
    )


def _scans(df):
    """Per scan, its lines of the formatted plan as a dictionary."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = [b for b in text.split("\n\n") if "Scan parquet" in b and "ReadSchema" in b]
    return [dict(line.split(": ", 1) for line in b.splitlines() if ": " in line) for b in blocks]


def test_only_needed_partitions_are_read(spark, stored):
    """Counters from the range's dates; from before it only validity."""
    within = TimeRange.of("2024-01-20", "2024-01-22")
    machines = spark.createDataFrame([(1,)], "machine_id int")
    scans = _scans(kpis.pieces_total(eventtable.read(spark, stored), within, machines=machines))
    dates = {s["PartitionFilters"].split("(", 1)[1] for s in scans}
    assert len(scans) == len(dates) == 3
    before = [s for s in scans if ">= 2024-01-20" not in s["PartitionFilters"]]
    assert len(before) == 1
    assert "<= 2024-01-19" in before[0]["PartitionFilters"] and "= DataValid" in before[0]["PartitionFilters"]
    for scan in scans:
        assert "timestamp,2024-01-2" in scan["PushedFilters"]
        assert "type:string" not in scan["ReadSchema"]
        if scan is not before[0]:
            assert ">= 2024-01-20" in scan["PartitionFilters"] and "<= 2024-01-21" in scan["PartitionFilters"]


def test_one_machine_is_pushed_down(spark, stored):
    within = TimeRange.of("2024-01-20", "2024-01-22")
    scans = _scans(kpis.pieces_total(eventtable.read(spark, stored), within, machine_id=7))
    assert scans and all("EqualTo(machine_id,7)" in s["PushedFilters"] for s in scans)


def test_retention(spark, tmp_path):
    path = str(tmp_path / "t")
    events = sample.machine_events(spark, compare.data("sf0.001"))
    eventtable.append(events, path)
    kept = eventtable.retain(events, registry.AS_OF)
    dropped = eventtable.drop_expired(spark, path, registry.AS_OF)
    assert dropped and all(name < "event_date=2024-01-11" for name in dropped)
    assert not [d for d in os.listdir(path) if d in dropped]
    after = eventtable.read(spark, path, as_of=registry.AS_OF)
    assert compare.spark_rows(after.drop("event_date")) == compare.spark_rows(kept)
    assert 0 < after.count() < 1000
    assert eventtable.drop_expired(spark, path, registry.AS_OF) == []


@pytest.mark.parametrize(
    ("as_of", "months", "first"),
    [
        ("2025-02-15", 13, "2024-01-11"),
        # 31 March less one month is the last of February.
        ("2024-03-31", 1, "2024-02-29"),
        ("2024-01-31T12:00:00", 13, "2022-12-29"),
    ],
)
def test_first_kept_date(as_of, months, first):
    assert eventtable.first_kept_date(as_of, months).isoformat() == first


def test_sizes(spark, stored):
    sizes = {r.chunk_start: r for r in eventtable.chunk_sizes(eventtable.read(spark, stored)).collect()}
    inventory = {r.chunk_start: r for r in eventtable.chunks(eventtable.read(spark, stored)).collect()}
    assert {k: v.rows for k, v in sizes.items()} == {k: v.rows for k, v in inventory.items()}
    on_disk = [
        os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(stored) for f in files if f.endswith(".parquet")
    ]
    total = eventtable.table_size(eventtable.read(spark, stored)).first()
    assert (total.files, total.bytes, total.rows) == (len(on_disk), sum(on_disk), 1000)


def test_dates_are_utc(spark):
    row = [(1, dt.datetime(2024, 1, 1, 23, 30), 7, "DataValid", "Boolean", 1, "R")]
    events = spark.createDataFrame(row, schema.MACHINE_EVENTS)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        found = eventtable.with_date(events).select(F.col("event_date").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == "2024-01-01"


def test_dimensions(spark, stored):
    found = {r.dimension: (r.partitions, r.first, r.last) for r in eventtable.dimensions(eventtable.read(spark, stored)).collect()}
    assert found == {
        "event_date": (30, "2024-01-01", "2024-01-30"),
        "variable": (5, "DataValid", "MachineRejectedPieces"),
    }


def test_views(spark, stored):
    from plantflow.plans import views

    events = eventtable.read(spark, stored)
    names = views.register(events, registry.RANGE)
    assert {v.name for v in spark.catalog.listTables()} >= set(names)
    one = "SELECT total_pieces_counted FROM pieces_total WHERE machine_id = :machine"
    found = spark.sql(one, args={"machine": 7})
    assert [r[0] for r in found.collect()] == [
        r.total_pieces_counted for r in kpis.pieces_total(events, registry.RANGE, machine_id=7).collect()
    ]
    assert all("EqualTo(machine_id,7)" in s["PushedFilters"] for s in _scans(found))
    share = spark.sql("SELECT count(*) FROM kpi_summary k JOIN pieces_total p USING (machine_id)").first()[0]
    assert share == 15


def _in_three_batches(spark, path):
    events = sample.machine_events(spark, compare.data("sf0.001"))
    for k in range(3):
        eventtable.append(events.filter(F.pmod("event_id", F.lit(3)) == k), path, f"part-{k}")
    return compare.spark_rows(events)


class _Stopped(Exception):
    pass


def _stop(*_, **__):
    raise _Stopped


def test_compaction_may_stop_after_any_step(spark, tmp_path, monkeypatch):
    """Stopped after the new batch, inside the log, and after it; run again; read equal rows each time."""
    from plantflow.sources import labels

    path = str(tmp_path / "t")
    rows = _in_three_batches(spark, path)

    def same():
        return compare.spark_rows(eventtable.read(spark, path).drop("event_date")) == rows

    for stopped in ((labels, "publish"), (labels._Store, "rename")):
        with monkeypatch.context() as patch:
            patch.setattr(*stopped, _stop)
            with pytest.raises(_Stopped):
                eventtable.compact(spark, path, "2024-01-20")
        assert same()
    before = eventtable.read(spark, path).drop("event_date")  # a reader that began earlier
    assert len(eventtable.compact(spark, path, "2024-01-20")) == 19
    assert same() and compare.spark_rows(before) == rows
    eventtable.append(sample.machine_events(spark, compare.data("sf0.001")).filter("event_id % 3 = 1"), path, "part-1")  # repeated
    assert same()
    assert eventtable.compact(spark, path, "2024-01-20") == []
    with monkeypatch.context() as patch:
        patch.setattr(labels._Store, "delete", _stop)
        with pytest.raises(_Stopped):
            eventtable.clean(spark, path)
    assert same()
    assert eventtable.clean(spark, path) and same()
    assert eventtable.clean(spark, path) == []
    late = sample.machine_events(spark, compare.data("sf0.001")).limit(20).withColumn("event_id", -F.col("event_id") - 1)
    eventtable.append(late, path, "late")
    assert eventtable.read(spark, path).count() == 1020
    eventtable.compact(spark, path, "2024-02-20")
    eventtable.clean(spark, path)
    assert eventtable.read(spark, path).count() == 1020
    assert len({(d, b) for d, b, _ in eventtable._folders(labels._Store(spark, path))}) == 30


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    """The second to publish fails and changes nothing."""
    from plantflow.sources import labels

    path = str(tmp_path / "t")
    rows = _in_three_batches(spark, path)
    seen = labels.current(spark, path)
    eventtable.compact(spark, path, "2024-01-20")
    monkeypatch.setattr(labels, "current", lambda *_: seen)
    with pytest.raises(RuntimeError):
        eventtable.compact(spark, path, "2024-01-20")
    monkeypatch.undo()
    assert compare.spark_rows(eventtable.read(spark, path).drop("event_date")) == rows
    eventtable.clean(spark, path)
    assert compare.spark_rows(eventtable.read(spark, path).drop("event_date")) == rows
