"""Messages to events."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plantflow.sources import wire

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)
GOOD = {
    "timestamp": 1704067200.123,
    "machine_id": 7,
    "variable": "LinePieceCounter",
    "type": "Int32",
    "value": 12,
    "event_type": "R",
}
LIFECYCLE = {"timestamp": 0.0, "machine_id": 7, "variable": "DataValid", "type": "Boolean", "value": 0, "order_id": 0}


def messages(spark, *payloads):
    rows = [(i, "prod/plant/7/", p if isinstance(p, str) else json.dumps(p), NOW) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "event_id long, topic string, payload string, ingest_ts timestamp")


def validated(spark, *payloads, **options):
    parsed = wire.normalise_time(wire.parse_payload(messages(spark, *payloads)), F.col("ingest_ts"))
    accepted, rejected = wire.validate(parsed, **options)
    return accepted.orderBy("event_id").collect(), {r.event_id: r.reject_reasons for r in rejected.collect()}


def without(name):
    return {k: v for k, v in GOOD.items() if k != name}


def test_topics(spark):
    topics = ["prod/plant", "prod/plant/7/", "prod/plant/a/b", "prod/plantx/7", "test/plant/7", "prod"]
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    assert [r.topic for r in wire.filter_topic(df, "prod/plant").collect()] == topics[:3]


def test_time(spark):
    accepted, rejected = validated(spark, GOOD, LIFECYCLE)
    assert rejected == {}
    assert accepted[0].timestamp == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert accepted[1].timestamp == NOW
    assert accepted[1].event_type == "R"


def test_lifecycle_without_event_type(spark):
    accepted, _ = validated(spark, LIFECYCLE, lifecycle_event_type="D")
    assert accepted[0].event_type == "D"
    accepted, rejected = validated(spark, LIFECYCLE, strict=True)
    assert accepted == [] and rejected == {0: ["no event_type"]}


@pytest.mark.parametrize("name", list(GOOD))
def test_missing_field(spark, name):
    accepted, rejected = validated(spark, without(name))
    assert accepted == [] and rejected == {0: [f"no {name}"]}


def test_unreadable(spark):
    huge = dict(GOOD, timestamp=1e300)
    accepted, rejected = validated(
        spark, '{"timestamp": 1', "", "[]", dict(GOOD, machine_id="M7"), dict(GOOD, value="abc"), huge, GOOD
    )
    assert [r.event_id for r in accepted] == [6]
    assert rejected[0] == rejected[3] == ["unreadable payload"]
    assert rejected[4] == ["no value"]
    assert rejected[5] == ["no timestamp"]
    assert set(rejected) == {0, 1, 2, 3, 4, 5}


def test_name_lengths(spark):
    long = dict(GOOD, variable="MachineRejectedPieces")
    assert len(validated(spark, long)[0]) == 1
    assert validated(spark, long, max_name_length=20)[1] == {0: ["variable too long"]}
    assert validated(spark, dict(GOOD, event_type="RR"))[1] == {0: ["event_type too long"]}


@pytest.mark.parametrize(
    ("sent", "kept"),
    [(True, 1), (False, 0), (2.9, 2), (-2.7, -2), (12, 12), (2**40, None), ("x", None), (None, None)],
)
def test_values(spark, sent, kept):
    parsed = wire.parse_payload(messages(spark, dict(GOOD, value=sent)))
    assert parsed.first().value == kept


def test_monitored_items(spark):
    assert wire.monitored_items("a| |b ") == ["a", "b "]
    assert wire.monitored_items("") == []
    df = spark.createDataFrame([("a",), ("b",), ("b ",)], "variable string")
    assert [r.variable for r in wire.select_items(df, "a| |b ").collect()] == ["a", "b "]


def test_metadata(spark):
    samples = spark.createDataFrame([("n1", 3), ("n2", 4)], "node_id string, value int")
    nodes = spark.createDataFrame([("n1", "Pieces", "Int32")], "node_id string, name string, type string")
    found = {r.node_id: (r.variable, r.type) for r in wire.with_metadata(samples, nodes).collect()}
    assert found == {"n1": ("Pieces", "Int32"), "n2": ("n2", "Unknown")}


def test_constants(spark):
    df = spark.createDataFrame([(1, "a")], "machine_id int, variable string")
    assert wire.with_constants(df, {"machine_id": 9, "site": "north"}).first().asDict() == {
        "machine_id": 9,
        "variable": "a",
        "site": "north",
    }
    assert wire.with_constants(df, {}).columns == df.columns


def test_payload_is_parsed_once(spark):
    parsed = wire.normalise_time(wire.parse_payload(messages(spark, GOOD)), F.col("ingest_ts"))
    plan = wire.validate(parsed)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
