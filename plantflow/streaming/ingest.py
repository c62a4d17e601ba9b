"""Continuous ingest: messages in, event table out.

The micro-batch size is set at the source. Nothing is dropped under load: messages wait in the source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from plantflow import schema
from plantflow.operators import orders as order_log
from plantflow.params import WatchdogConfig
from plantflow.sources import eventtable, wire
from plantflow.streaming import watchdog

TRIGGER = {"processingTime": "10 seconds"}


def read_json(
    spark: SparkSession,
    path: str,
    fields: StructType = schema.MESSAGE,
    max_bytes: int = 1 << 30,
    max_files: int | None = None,
) -> DataFrame:
    """JSON files arriving in a directory, with a given schema; a micro-batch takes so many bytes or files."""
    limit = ("maxBytesPerTrigger", max_bytes) if max_files is None else ("maxFilesPerTrigger", max_files)
    return spark.readStream.schema(fields).option(*limit).json(path)


def read_samples(spark: SparkSession, path: str, items: str | None = None, **limits) -> DataFrame:
    """Bare samples, one JSON record per change, of all variables or of the `|`-separated ones."""
    samples = read_json(spark, path, schema.PAYLOAD, **limits)
    return samples if items is None else wire.select_items(samples, items)


def received(messages: DataFrame) -> DataFrame:
    """Messages with the time and number that order them, and whether both came with the message.

    Samples carry their own time; for them the micro-batch's time, kept in the checkpoint, and a hash of the message
    stand in. Validity messages without the real ones go to the quarantine (`wire.check`).
    """
    return messages.select(
        "topic",
        "payload",
        F.coalesce(F.col("received_at"), F.current_timestamp()).alias("ingest_ts"),
        F.coalesce(F.col("message_id"), F.xxhash64("topic", "payload")).alias("event_id"),
        (F.col("received_at").isNull() | F.col("message_id").isNull()).alias(wire.UNORDERED),
    )


def checked(messages: DataFrame, root: str, lifecycle_event_type: str = schema.RAW, strict: bool = False) -> DataFrame:
    """Messages below a topic root as table rows, with the reasons against taking them."""
    parsed = wire.parse_payload(wire.filter_topic(received(messages), root))
    return wire.check(wire.normalise_time(parsed, F.col("ingest_ts")), lifecycle_event_type, strict)


def append_to_table(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    orders: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """Append a stream to the event table; every row arrives once, also after a restart from the checkpoint.

    A micro-batch is written like any other batch, in a place named by the stream and the batch's number, which a
    repetition overwrites. `orders` reads the order schedule; it is asked anew for each micro-batch, and the order
    running on its machine is stored with each event.
    """
    return _each_batch(events, checkpoint, trigger, name, lambda rows, label: _store(rows, path, label, orders))


def _store(events: DataFrame, path: str, label: str, orders: Callable[[], DataFrame] | None) -> None:
    rows = events if orders is None else order_log.enrich(events, orders())
    eventtable.append(rows, path, label)


def _each_batch(
    df: DataFrame, checkpoint: str, trigger: dict | None, name: str | None, write: Callable[[DataFrame, str], None]
) -> StreamingQuery:
    """`write` gets each micro-batch with a label that is the same if the batch is repeated."""
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    writer = (
        df.writeStream.foreachBatch(lambda rows, number: write(rows, f"{stream}-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
    )
    return (writer.queryName(name) if name else writer).start()


def quarantine(rejected: DataFrame, path: str, label: str) -> None:
    """Keep rejected messages with their reasons, by date of receipt and batch."""
    (
        rejected.withColumns({"ingest_date": F.to_date("ingest_ts"), eventtable.BATCH: F.lit(label)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", eventtable.BATCH)
        .parquet(path)
    )


def publish(events: DataFrame, root: str, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Publish events as JSON messages below a topic root."""
    return (
        wire.publish(events, root)
        .writeStream.format("json")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start(path)
    )


def start(
    spark: SparkSession,
    landing: str,
    table: str,
    quarantined: str,
    checkpoints: str,
    root: str,
    cfg: WatchdogConfig | None = None,
    trigger: dict | None = None,
    strict: bool = False,
    orders: Callable[[], DataFrame] | None = None,
    **limits,
) -> list[StreamingQuery]:
    """The whole ingest: messages landing as files go to the event table, and those the table does not take to the
    quarantine, both from one parse. If `cfg` is given, a second query derives anomalies from the counters and appends
    them to the same table. Each query has its own checkpoint."""
    found = checked(read_json(spark, landing, **limits), root, strict=strict)

    def write(rows: DataFrame, label: str) -> None:
        parsed = rows.persist()
        try:
            _store(wire.accepted(parsed), table, label, orders)
            quarantine(wire.quarantined(parsed), quarantined, label)
        finally:
            parsed.unpersist()

    queries = [_each_batch(found, f"{checkpoints}/table", trigger, "events", write)]
    if cfg is not None:
        derived = watchdog.stream(wire.accepted(found), cfg)
        queries.append(append_to_table(derived, table, f"{checkpoints}/anomalies", trigger, "anomalies", orders))
    return queries
