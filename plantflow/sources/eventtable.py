"""The stored event table: Parquet, kept by date, variable and batch.

Loads, streams, retention and compaction share it. Every batch writes into places of its own, named by its label, and a
batch that is repeated after a failure overwrites them. What is there is what is read, but for batches that compaction
has replaced (`labels`).

A report over a range opens only the dates and variables it needs; in particular the state before the range comes
from the few validity and anomaly files, not from the counters. Within a file rows are sorted by machine, so a single
machine's report skips most row groups.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow import schema
from plantflow.functions import timecols
from plantflow.params import instant, to_micros
from plantflow.sources import labels

PARTITIONS = ("event_date", "variable")
BATCH = "batch"
ORDER = "order_id"
CHUNK_DAYS = 7
RETENTION_MONTHS = 13

STORED = T.StructType(
    [f for f in schema.MACHINE_EVENTS.fields if f.name not in PARTITIONS]
    + [T.StructField("event_date", T.DateType()), T.StructField("variable", T.StringType())]
)


def with_date(events: DataFrame) -> DataFrame:
    """UTC date of the event, whatever the session's time zone."""
    day = timecols.DAY_US
    return events.withColumn(
        "event_date", F.date_from_unix_date(F.floor(F.unix_micros("timestamp") / F.lit(day)).cast("int"))
    )


def append(events: DataFrame, path: str, label: str | None = None) -> None:
    """Append a batch, with the order of each event if it has one; a batch of the same label replaces the earlier one.

    Rebalancing splits a large date or variable over several files and merges small ones.
    """
    dated = with_date(events.select(*schema.MODEL_COLUMNS, *([ORDER] if ORDER in events.columns else [])))
    if label is not None:  # a repeated batch: dates that were compacted have its rows already
        done = labels.read(events.sparkSession, path).parts_without(label)
        if done:
            dated = dated.filter(~F.col("event_date").isin([_as_date(d) for d in done]))
    _write(dated, path, label or f"load-{uuid.uuid4().hex}")


def _write(dated: DataFrame, path: str, label: str) -> None:
    (
        dated.withColumn(BATCH, F.lit(label))
        .hint("rebalance", *[F.col(c) for c in PARTITIONS])
        .sortWithinPartitions(*PARTITIONS, "machine_id", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS, BATCH)
        .parquet(path)
    )


def compact(spark: SparkSession, path: str, before: str) -> list[str]:
    """Rewrite the dates before an ISO date, which nothing writes to any more, with one batch each; returns the dates.

    Streams leave a file per date, variable and micro-batch. The new batch is written beside the old ones and counts from
    the moment the table's log says so (`labels`); the old ones stay for readers that have begun, until `clean`. It may
    end after any step and be run again. Dates with a single batch are left as they are.
    """
    seen, known = labels.current(spark, path)
    store = labels._Store(spark, path)
    batches: dict[str, set[str]] = {}
    for date, label, _ in _folders(store):
        if date < before and not known.is_replaced(date, label) and (not label.startswith(labels.MERGED) or known.merged.get(date) == label):
            batches.setdefault(date, set()).add(label)
    dates = sorted(date for date, own in batches.items() if len(own) > 1)
    if not dates:
        return []
    label = labels.new_label()
    day = spark.read.schema(T.StructType([*STORED.fields, T.StructField(BATCH, T.StringType()), T.StructField(ORDER, T.LongType())])).parquet(path)
    taken = labels.in_batches(F.col("event_date").cast("string"), F.col(BATCH), {d: batches[d] for d in dates})
    _write(day.filter(F.col("event_date").isin([_as_date(d) for d in dates]) & taken).drop(BATCH), path, label)
    replaced = known.replaced | {d: sorted({*known.replaced.get(d, ()), *batches[d]}) for d in dates}
    labels.publish(spark, path, seen, labels.Labels(known.merged | dict.fromkeys(dates, label), replaced))
    return [f"event_date={d}" for d in dates]


def _as_date(text: str):
    return datetime.fromisoformat(text).date()


def _folders(store: labels._Store) -> Iterator[tuple[str, str, str]]:
    """(date, label, folder) of every batch. Only names reach the driver."""
    for status in store.files.globStatus(store.at(f"event_date=*/variable=*/{BATCH}=*")) or ():
        folder = status.getPath()
        date = folder.getParent().getParent().getName().removeprefix("event_date=")
        label = folder.getName().removeprefix(f"{BATCH}=")
        yield date, label, f"event_date={date}/{folder.getParent().getName()}/{folder.getName()}"


def clean(spark: SparkSession, path: str) -> list[str]:
    """Delete the batches that compaction has replaced, and what an unfinished compaction left. Run it when nobody still
    reads the table as it was before the last compaction, and none is under way."""
    return labels.clean(spark, path, _folders)


def read(
    spark: SparkSession,
    path: str,
    as_of: datetime | str | None = None,
    months: int = RETENTION_MONTHS,
    with_orders: bool = False,
) -> DataFrame:
    """The table; with `as_of`, only the dates retention has not yet removed by then; with the stored order if asked."""
    fields = [*STORED.fields, T.StructField(BATCH, T.StringType()), *([T.StructField(ORDER, T.LongType())] if with_orders else [])]
    stored = spark.read.schema(T.StructType(fields)).parquet(path)
    stored = stored.filter(labels.read(spark, path).counting(F.col("event_date").cast("string"), F.col(BATCH))).drop(BATCH)
    if as_of is not None:
        # Dates of chunks that ended by the cutoff. A literal date, so their directories are not even listed.
        stored = stored.filter(F.col("event_date") >= F.lit(first_kept_date(as_of, months)))
    return stored


def _months_before(moment: datetime, months: int) -> datetime:
    serial = moment.year * 12 + moment.month - 1 - months
    year, month = divmod(serial, 12)
    for day in range(moment.day, 27, -1):
        try:
            return moment.replace(year=year, month=month + 1, day=day)
        except ValueError:
            continue
    return moment.replace(year=year, month=month + 1)


def first_kept_date(as_of: datetime | str, months: int = RETENTION_MONTHS, chunk_days: int = CHUNK_DAYS):
    """First date of the oldest chunk that retention keeps: one that ends after the cutoff."""
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    now = epoch + timedelta(microseconds=to_micros(as_of))
    cutoff = to_micros(_months_before(now, months))
    width = chunk_days * timecols.DAY_US
    return (epoch + timedelta(microseconds=cutoff - cutoff % width)).date()


def retain(
    events: DataFrame, as_of: datetime | str, months: int = RETENTION_MONTHS, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Rows whose chunk ends after `as_of` less the retention time."""
    first = first_kept_date(as_of, months, chunk_days)
    # The oldest chunk kept begins at midnight UTC of its first date: a plain condition, which the scan takes.
    start = datetime(first.year, first.month, first.day, tzinfo=timezone.utc)
    kept = events.filter(F.col("timestamp") >= instant(to_micros(start)))
    if "event_date" in events.columns:
        kept = kept.filter(F.col("event_date") >= F.lit(first))
    return kept


def drop_expired(
    spark: SparkSession, path: str, as_of: datetime | str, months: int = RETENTION_MONTHS
) -> list[str]:
    """Delete the date directories of expired chunks; returns their names. Only directory names reach the driver."""
    limit = first_kept_date(as_of, months).isoformat()
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("event_date=") and name.removeprefix("event_date=") < limit:
            files.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)


def chunks(events: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Storage chunks with their bounds, number of rows and first and last event."""
    start = timecols.chunk_start(F.col("timestamp"), chunk_days)
    return (
        events.groupBy(start.alias("chunk_start"))
        .agg(F.count("*").alias("rows"), F.min("timestamp").alias("first_event"), F.max("timestamp").alias("last_event"))
        .withColumn("chunk_end", timecols.chunk_end(F.col("chunk_start"), chunk_days))
    )


def chunk_sizes(stored: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Files and bytes per chunk of a stored table, from file metadata; a file lies in one chunk since it has one date."""
    micros = F.unix_date("event_date").cast("bigint") * F.lit(timecols.DAY_US)
    start = timecols.chunk_start(F.timestamp_micros(micros), chunk_days)
    files = stored.select(
        start.alias("chunk_start"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    )
    per_file = files.groupBy("chunk_start", "file").agg(F.max("bytes").alias("bytes"), F.count("*").alias("rows"))
    return per_file.groupBy("chunk_start").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )


def table_size(stored: DataFrame) -> DataFrame:
    """Files, bytes and rows of the whole stored table, as one row."""
    return chunk_sizes(stored).agg(
        F.count("*").alias("chunks"),
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("rows").alias("rows"),
    )


def dimensions(stored: DataFrame) -> DataFrame:
    """Columns the table is kept by, with the number of values and the first and last of them."""
    parts = stored.select(*PARTITIONS).distinct()
    column = F.inline(
        F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in PARTITIONS])
    )
    return (
        parts.select(column)
        .groupBy("dimension")
        .agg(
            F.count_distinct("value").alias("partitions"), F.min("value").alias("first"), F.max("value").alias("last")
        )
    )
