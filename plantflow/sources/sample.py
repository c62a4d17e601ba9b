"""The sample tables projected into the telemetry model.

Stands in for a plant: machines are users, their samples are events, production orders are orders and lineitems.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantflow import schema
from plantflow.functions import timecols
from plantflow.operators import segments
from plantflow.operators.segments import SegmentPlan

TOPIC_ROOT = "prod/plant"
APPLICATION = "PLANT"


# Columns of the sample tables in use, so that no file is opened to learn them.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register of machines."""
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("int").alias("machine_id")).distinct()


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with the numbers every projection uses: machine, tag number `k` and whole value `iv`."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("int").alias("machine_id"),
        F.col("event_type").alias("kind"),
        F.col("value").alias("reading"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.floor("value").cast("bigint").alias("iv"),
    )


def _model(df: DataFrame, value: Column, type_name: str, event_type: Column, *more: str) -> DataFrame:
    return df.select(
        "event_id",
        "timestamp",
        "machine_id",
        "variable",
        F.lit(type_name).alias("type"),
        value.cast("int").alias("value"),
        event_type.alias("event_type"),
        *more,
    )


def machine_events(spark: SparkSession, sf_dir: str, plan: SegmentPlan | None = None) -> DataFrame:
    """Validity, anomaly and counter events of all machines."""
    return _numbered_events(spark, sf_dir, plan).drop("k")


def _numbered_events(spark: SparkSession, sf_dir: str, plan: SegmentPlan | None) -> DataFrame:
    events = _events(spark, sf_dir)
    signals = events.filter(F.col("kind").isin("signup", "error")).withColumn(
        "variable",
        F.when(F.col("kind") == "signup", F.lit(schema.DATA_VALID)).otherwise(F.lit(schema.MACHINE_ANOMALY)),
    )
    is_validity = F.col("kind") == "signup"
    flag = F.when(is_validity, F.when(F.col("k") % 4 == 0, 0).otherwise(1)).otherwise(F.col("k") % 2)
    origin = F.when(is_validity, F.lit(schema.RAW)).otherwise(F.lit(schema.DERIVED))

    readings = events.filter(F.col("kind").isin("view", "click", "purchase")).withColumn(
        "variable",
        F.when(F.col("kind") == "view", F.lit(schema.PIECE_COUNTER))
        .when(F.col("kind") == "click", F.lit(schema.LINE_COUNTER))
        .otherwise(F.lit(schema.REJECT_COUNTER)),
    )
    turn = F.when(F.col("kind") == "purchase", F.lit(97)).otherwise(F.lit(503))
    keys, order = ["machine_id", "variable"], [F.col("timestamp"), F.col("event_id")]
    counted = {"counted": segments.total(F.col("iv"))}
    counters = segments.by_heat(
        readings, keys, order, plan, lambda rows, cut: segments.running(rows, keys, order, counted, cut), gather=False
    )
    return _model(signals, flag, "Boolean", origin, "k").unionByName(
        _model(counters, F.col("counted") % turn, "Int32", F.lit(schema.RAW), "k")
    )


def counter_samples(spark: SparkSession, sf_dir: str, plan: SegmentPlan | None = None) -> DataFrame:
    """What devices report themselves, without derived events: the input of the watchdog."""
    return machine_events(spark, sf_dir, plan).filter(F.col("event_type") == schema.RAW)


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean machine states."""
    number = F.col("k") % 4
    variable = F.lit(schema.MACHINE_STATES[3])
    for i in (2, 1, 0):
        variable = F.when(number == i, F.lit(schema.MACHINE_STATES[i])).otherwise(variable)
    states = _events(spark, sf_dir).withColumn("variable", variable)
    return _model(states, F.col("iv") % 2, "Boolean", F.lit(schema.RAW))


def messages(spark: SparkSession, sf_dir: str, plan: SegmentPlan | None = None) -> DataFrame:
    """Machine events as published: topic and JSON payload, with the time and number of their receipt.

    Validity messages carry timestamp 0.0 and no event type, as a message registered before it happens does.
    """
    validity = F.col("variable") == schema.DATA_VALID
    payload = F.to_json(
        F.struct(
            F.when(validity, F.lit(0.0)).otherwise(timecols.epoch_seconds(F.col("timestamp"))).alias("timestamp"),
            "machine_id",
            "variable",
            "type",
            "value",
            F.when(~validity, F.col("event_type")).alias("event_type"),
            F.when(validity, F.lit(0)).alias("order_id"),
        )
    )
    environment = F.when(F.col("k") % 10 == 0, F.lit("test/plant")).otherwise(F.lit(TOPIC_ROOT))
    return _numbered_events(spark, sf_dir, plan).select(
        "event_id",
        F.concat(environment, F.lit("/"), F.col("machine_id").cast("string"), F.lit("/")).alias("topic"),
        payload.alias("payload"),
        F.col("timestamp").alias("ingest_ts"),
        "k",
    )


def damaged_messages(spark: SparkSession, sf_dir: str, plan: SegmentPlan | None = None) -> DataFrame:
    """Messages of which some lack a field or the order of receipt, are cut short or carry a machine's name."""
    turn = F.col("k") % 17
    payload = F.col("payload")
    broken = (
        F.when(turn == 3, F.regexp_replace(payload, '"type":"[A-Za-z0-9]+",', ""))
        .when(turn == 5, F.substring_index(payload, ",", 2))
        .when(turn == 7, F.regexp_replace(payload, '"machine_id":([0-9]+)', '"machine_id":"M$1"'))
        .otherwise(payload)
    )
    damaged = messages(spark, sf_dir, plan).withColumn("payload", broken)
    return damaged.withColumn("_unordered", F.col("k") % 17 == 9)


def value_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample messages whose value is a JSON boolean, a float or a negative float."""
    reading = F.col("reading")
    value = (
        F.when(F.col("k") % 3 == 0, F.when(F.col("iv") % 2 == 1, F.lit("true")).otherwise(F.lit("false")))
        .when(F.col("k") % 3 == 1, reading.cast("string"))
        .otherwise((-reading).cast("string"))
    )
    payload = F.concat(F.lit('{"machine_id":'), F.col("machine_id").cast("string"), F.lit(',"value":'), value, F.lit("}"))
    return _events(spark, sf_dir).select(
        "event_id", F.lit(TOPIC_ROOT).alias("topic"), payload.alias("payload"), F.col("timestamp").alias("ingest_ts")
    )


def node_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples that still carry a device's node id."""
    return _events(spark, sf_dir).select(
        "event_id",
        "machine_id",
        F.concat(F.lit("ns=2;s=Channel1.Device1."), F.col("kind")).alias("node_id"),
        F.col("iv").alias("value"),
    )


def node_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and type of the nodes that were browsed; errors and signups were not."""
    kinds = _events(spark, sf_dir).filter(F.col("kind").isin("view", "click", "purchase")).select("kind").distinct()
    return kinds.select(
        F.concat(F.lit("ns=2;s=Channel1.Device1."), F.col("kind")).alias("node_id"),
        F.initcap("kind").alias("name"),
        F.lit("Int32").alias("type"),
    )


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two periods per event, some with reversed, equal or touching ends."""
    def shifted(minutes: Column) -> Column:
        return F.timestamp_micros(F.unix_micros("timestamp") + minutes.cast("bigint") * F.lit(60_000_000))

    offset = F.col("k") - 50
    return _events(spark, sf_dir).select(
        "event_id",
        F.col("timestamp").alias("start_a"),
        shifted(F.col("iv") % 60 - 30).alias("end_a"),
        shifted(offset).alias("start_b"),
        shifted(offset + (F.col("k") % 7 - 3) * 10).alias("end_b"),
    )


def production_orders(spark: SparkSession, sf_dir: str, plan: SegmentPlan | None = None) -> DataFrame:
    """Orders, one after the other on each machine."""
    day = timecols.DAY_US
    days = F.floor((F.unix_micros(F.col("o_orderdate").cast("timestamp")) - F.lit(788_918_400_000_000)) / F.lit(day))
    placed = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_orderkey") % 200).alias("article_id"),
        F.floor(F.col("o_custkey") / 10).cast("int").alias("machine_id"),
        (F.lit(50) + F.col("o_orderkey") % 100).alias("target_qty"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + days * F.lit(1_080_000_000)).alias("start_date"),
    )
    order = [F.col("start_date"), F.col("order_id")]
    until = {"end_date": segments.following(F.col("start_date"))}
    keys = ["machine_id"]
    return segments.by_heat(
        placed, keys, order, plan, lambda rows, cut: segments.running(rows, keys, order, until, cut), gather=False
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("article_id"), F.col("p_name").alias("description")
    )


def order_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress statements; `statement_order` settles the order of statements made at the same time."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("qty"), "l_discount").alias(
            "statement_order"
        ),
        F.col("l_quantity").cast("int").alias("produced_qty"),
        F.floor(F.col("l_quantity") * F.col("l_discount")).cast("int").alias("discarded_qty"),
    )


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gateway log lines with their resource attributes."""
    component = (
        F.when(F.col("k") % 3 == 0, F.lit("MQTT")).when(F.col("k") % 3 == 1, F.lit("OPC UA")).otherwise(F.lit("MESAPI"))
    )
    severity = (
        F.when(F.col("kind") == "error", F.lit("ERROR"))
        .when(F.col("kind") == "signup", F.lit("WARNING"))
        .when(F.col("kind") == "purchase", F.lit("DEBUG"))
        .otherwise(F.lit("INFO"))
    )
    text = F.when(
        (F.col("kind") == "error") & (F.col("k") % 3 < 2), F.lit("Connection lost. New connection attempt in 3s...")
    ).otherwise(F.col("kind"))
    host = F.concat(F.lit("GW-"), F.col("machine_id").cast("string"))
    return _events(spark, sf_dir).select(
        "event_id",
        F.col("timestamp").alias("ts"),
        severity.alias("severity"),
        F.concat_ws(" | ", F.lit(APPLICATION), host, component, text).alias("body"),
        _attributes(host).alias("resource"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace spans: duration and attributes."""
    return _events(spark, sf_dir).select(
        "event_id",
        F.col("timestamp").alias("ts"),
        F.col("reading").alias("duration_ms"),
        F.map_concat(
            F.create_map(F.lit("service.name"), F.col("kind")),
            _attributes(F.concat(F.lit("GW-"), F.col("machine_id").cast("string"))),
        ).alias("attributes"),
    )


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported metric values."""
    host = F.concat(F.lit("GW-"), F.col("machine_id").cast("string"))
    return (
        _events(spark, sf_dir)
        .filter(F.col("kind") == "view")
        .select("event_id", F.col("timestamp").alias("ts"), F.lit("pieces").alias("name"), _attributes(host).alias("attributes"))
    )


def _attributes(host: Column) -> Column:
    """Host always; environment only on two of three records, so that defaults have something to do."""
    return F.when(
        F.col("k") % 3 == 0, F.create_map(F.lit("host.name"), host)
    ).otherwise(
        F.create_map(
            F.lit("host.name"),
            host,
            F.lit("deployment.environment"),
            F.when(F.col("k") % 3 == 1, F.lit("development")).otherwise(F.lit("production")),
        )
    )
