"""Messages to events: topic filter, payload parsing, time, checks, metadata. All row-local but the metadata lookup."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow import schema
from plantflow.functions import timecols, values

_UNREADABLE = "_unreadable"
# Whether a message came without what orders it, the time or the number of its receipt.
UNORDERED = "_unordered"
_FIELDS = tuple(f.name for f in schema.PAYLOAD)


def topic_matches(topic: Column, root: str) -> Column:
    """Whether a topic is the root itself or lies below it, level by level: the meaning of `<root>/#`."""
    return (topic == root) | topic.startswith(root.rstrip("/") + "/")


def filter_topic(messages: DataFrame, root: str) -> DataFrame:
    return messages.filter(topic_matches(F.col("topic"), root))


def parse_payload(messages: DataFrame) -> DataFrame:
    """The six payload fields as columns, null where absent. `_unreadable` holds payloads that do not fit the schema."""
    wire = T.StructType([*schema.PAYLOAD.fields, T.StructField(_UNREADABLE, T.StringType())])
    parsed = F.from_json("payload", wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE})
    rest = [c for c in messages.columns if c not in _FIELDS]
    # As a generator, so that later filters see finished columns: pushed into a projection, each use would parse again.
    return messages.select(*rest, F.inline_outer(F.array(parsed))).withColumn(
        "value", values.whole_number(F.col("value"))
    )


def normalise_time(parsed: DataFrame, ingest_ts: Column) -> DataFrame:
    """Epoch seconds to timestamps.

    Validity messages are written before the moment they tell about, so they take the time of receipt.
    """
    return parsed.withColumn(
        "timestamp",
        F.when(F.col("variable") == schema.DATA_VALID, ingest_ts).otherwise(
            timecols.from_epoch_seconds(F.col("timestamp"))
        ),
    )


def check(
    events: DataFrame,
    lifecycle_event_type: str = schema.RAW,
    strict: bool = False,
    max_name_length: int | None = None,
) -> DataFrame:
    """Add `reject_reasons`, empty for rows the event table takes.

    Every column of the table is required. Validity messages come without an event type and get
    `lifecycle_event_type`, unless `strict`. `max_name_length` bounds variable and type names.
    """
    if not strict:
        lifecycle = (F.col("variable") == schema.DATA_VALID) & F.col("event_type").isNull()
        events = events.withColumn(
            "event_type", F.when(lifecycle, F.lit(lifecycle_event_type)).otherwise(F.col("event_type"))
        )
    unreadable = F.col(_UNREADABLE).isNotNull()
    reasons = [F.when(unreadable, F.lit("unreadable payload"))]
    for name in _FIELDS:
        reasons.append(F.when(~unreadable & F.col(name).isNull(), F.lit(f"no {name}")))
    if UNORDERED in events.columns:
        # Validity has no time of its own: without the order of receipt a 0 and a 1 could change places.
        reasons.append(F.when((F.col("variable") == schema.DATA_VALID) & F.col(UNORDERED), F.lit("no order of receipt")))
    reasons.append(F.when(F.length("event_type") > 1, F.lit("event_type too long")))
    if max_name_length is not None:
        for name in ("variable", "type"):
            reasons.append(F.when(F.length(name) > max_name_length, F.lit(f"{name} too long")))
    return events.withColumn("reject_reasons", F.array_compact(F.array(*reasons)))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reject_reasons") == 0).select(*schema.MODEL_COLUMNS)


def quarantined(checked: DataFrame) -> DataFrame:
    """Rejected rows with their message and the reasons."""
    return checked.filter(F.size("reject_reasons") > 0).select("event_id", "topic", "payload", "ingest_ts", "reject_reasons")


def validate(
    events: DataFrame,
    lifecycle_event_type: str = schema.RAW,
    strict: bool = False,
    max_name_length: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows for the event table and rows for the quarantine."""
    checked = check(events, lifecycle_event_type, strict, max_name_length)
    return accepted(checked), quarantined(checked)


def monitored_items(spec: str) -> list[str]:
    """Names in a `|`-separated list; blank ones are dropped, the others kept as they are."""
    return [item for item in re.split(r"\|", spec) if not item.isspace() and item]


def select_items(events: DataFrame, spec: str, column: str = "variable") -> DataFrame:
    return events.filter(F.col(column).isin(monitored_items(spec)))


def with_metadata(samples: DataFrame, nodes: DataFrame) -> DataFrame:
    """Name and type of each sample's node; an unknown node is named by its id."""
    known = nodes.select("node_id", F.col("name").alias("_name"), F.col("type").alias("_type"))
    return (
        samples.join(known, "node_id", "left")
        .withColumn("variable", F.coalesce(F.col("_name"), F.col("node_id")))
        .withColumn("type", F.coalesce(F.col("_type"), F.lit(schema.UNKNOWN_TYPE)))
        .drop("_name", "_type")
    )


def with_constants(samples: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Constant fields merged into every record; they replace fields of the same name."""
    return samples.withColumns({name: F.lit(value) for name, value in constants.items()}) if constants else samples


def to_payload(events: DataFrame, *more: str) -> Column:
    """A record as flat JSON with its time in epoch seconds."""
    return F.to_json(
        F.struct(
            timecols.epoch_seconds(F.col("timestamp")).alias("timestamp"),
            "machine_id",
            "variable",
            "type",
            "value",
            "event_type",
            *more,
        )
    )


def publish(events: DataFrame, root: str, *more: str) -> DataFrame:
    """Events as messages below a topic root, one level per machine."""
    topic = F.concat(F.lit(root.rstrip("/") + "/"), F.col("machine_id").cast("string"), F.lit("/"))
    return events.select(topic.alias("topic"), to_payload(events, *more).alias("payload"))
