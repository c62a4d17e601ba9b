"""Roll-ups over streams that lose no late record.

Each micro-batch adds the partial roll-up of its own rows; reading merges them. So a micro-batch costs what its rows cost,
a record counts whenever it comes, whatever its time, and the roll-up is always that of a batch over all records
received. A repeated micro-batch overwrites what it left before. `fold` replaces the many small parts of a day by one, at
any time, beside the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from plantflow.plans import observability
from plantflow.sources.summaries import BATCH, PART, Summaries
from plantflow.streaming import ingest

#: What roll-ups count; all other columns are keys.
COUNTED = ("records", "size", "spans", "lines")


def _table(path: str, columns: list[str]) -> Summaries:
    return Summaries(path, {c: "sum" for c in COUNTED if c in columns}, by="window_start")


def _kept(
    records: DataFrame, report: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    def write(rows: DataFrame, label: str) -> None:
        partial = report(rows)
        _table(path, partial.columns).add(partial, label)

    return ingest._each_batch(records, checkpoint, trigger, None, write)


def _fields(spark: SparkSession, path: str) -> StructType:
    return StructType([f for f in spark.read.parquet(path).schema if f.name not in (PART, BATCH)])


def read(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """The roll-up as it stands, of the days from `since` to `until` (ISO dates) if asked."""
    fields = _fields(spark, path)
    return _table(path, fields.names).read(spark, fields, since, until)


def fold(spark: SparkSession, path: str, least: int = 2) -> list[str]:
    """Merges the parts of each day that has `least` or more; returns the days."""
    fields = _fields(spark, path)
    return _table(path, fields.names).fold(spark, fields, least)


def clean(spark: SparkSession, path: str) -> list[str]:
    """Deletes what folding has replaced; see `sources.labels.clean`."""
    return _table(path, []).clean(spark)


def meter_usage(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return _kept(records, observability.meter_usage, path, checkpoint, trigger)


def latency_histogram(spans: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return _kept(spans, observability.latency_histogram, path, checkpoint, trigger)


def exponential_histogram(
    spans: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, scale: int = 3
) -> StreamingQuery:
    return _kept(spans, lambda rows: observability.exponential_histogram(rows, scale), path, checkpoint, trigger)


def roll_up_logs(parsed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return _kept(parsed, observability.roll_up_logs, path, checkpoint, trigger)
