"""Roll-ups of logs, spans and metrics. streaming.observability keeps them up to date on streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow.functions import histograms

# Log severities from low to high, component prefixes and the text that announces a reconnect.
SEVERITIES = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
COMPONENTS = ("MQTT", "OPC UA", "MESAPI")
RECONNECT_TEXT = "New connection attempt"

# Upper limits of the latency buckets in milliseconds.
LATENCY_BOUNDS_MS = (0.1, 1, 2, 6, 10, 50, 100, 250, 500, 1000, 1400, 2000, 5000, 10000, 20000, 40000, 60000)

# Span dimensions and what stands in for a missing one (None: stays empty). The collector's id keeps series
# of several collectors apart.
SPAN_DIMENSIONS = {
    "service.name": None,
    "service.namespace": "default",
    "deployment.environment": "default",
    "collector.id": None,
    "service.version": None,
    "browser.platform": None,
    "browser.mobile": None,
    "k8s.cluster.name": None,
    "k8s.node.name": None,
    "k8s.namespace.name": None,
    "host.name": None,
    "host.type": None,
    "container.name": None,
}
METER_DIMENSIONS = ("service.name", "deployment.environment", "host.name")


def dimension(attributes: Column, name: str, default: str | None = None) -> Column:
    found = attributes[name]
    return found if default is None else F.coalesce(found, F.lit(default))


def column_name(dimension_name: str) -> str:
    return dimension_name.replace(".", "_")


def _dimensions(attributes: Column, dimensions: Mapping[str, str | None]) -> list[Column]:
    return [dimension(attributes, name, default).alias(column_name(name)) for name, default in dimensions.items()]


def parse_logs(
    logs: DataFrame, application: str, min_severity: str = "INFO", components: Sequence[str] = COMPONENTS
) -> DataFrame:
    """Log lines `<application> | <host> | [<component> |] <text>` taken apart; other lines are not this application's."""
    kept = SEVERITIES[SEVERITIES.index(min_severity) :]
    bar = " | "
    after_bar = len(bar) + 1
    prefix = application + bar
    body = F.col("body")
    rest = F.substr(body, F.lit(len(prefix) + 1))
    host = F.substring_index(rest, bar, 1)
    message = F.substr(rest, F.length(host) + after_bar)
    lead = F.substring_index(message, bar, 1)
    has_component = lead.isin(list(components)) & message.contains(bar)
    parts = F.struct(
        F.nullif(host, F.lit("")).alias("host"),
        F.when(has_component, lead).alias("component"),
        F.when(has_component, F.substr(message, F.length(lead) + after_bar)).otherwise(message).alias("text"),
    )
    # As a generator, so that later filters see finished columns instead of taking the line apart once more.
    return logs.filter(F.col("severity").isin(*kept) & body.startswith(prefix) & rest.contains(bar)).select(
        *[c for c in logs.columns if c != "body"], F.inline(F.array(parts))
    )


def roll_up_logs(parsed: DataFrame, every: str = "1 hour") -> DataFrame:
    """Lines per host, component, severity and time window."""
    grouped = parsed.groupBy(F.window("ts", every).alias("w"), "host", "component", "severity")
    return grouped.agg(F.count("*").alias("lines")).select(
        F.col("w.start").alias("window_start"), "host", "component", "severity", "lines"
    )


def reconnects(parsed: DataFrame) -> DataFrame:
    """How often each host announced a new connection attempt."""
    return (
        parsed.filter(F.col("text").contains(RECONNECT_TEXT)).groupBy("host").agg(F.count("*").alias("reconnects"))
    )


def meter_records(
    logs: DataFrame | None = None, spans: DataFrame | None = None, metrics: DataFrame | None = None
) -> DataFrame:
    """What the meter counts: signal, time, attributes and size of every record.

    The size is the bytes of the whole record as JSON: all its columns under their names, without those that are null,
    times as ISO 8601 in UTC.
    """
    parts = []
    if logs is not None:
        parts.append(_meter_part(logs, "logs", "resource"))
    if spans is not None:
        parts.append(_meter_part(spans, "traces", "attributes"))
    if metrics is not None:
        parts.append(_meter_part(metrics, "metrics", "attributes"))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def _meter_part(df: DataFrame, signal: str, attributes: str) -> DataFrame:
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"timeZone": "UTC"})
    return df.select(
        F.lit(signal).alias("signal"), "ts", F.col(attributes).alias("attributes"), F.octet_length(record).cast("bigint").alias("size")
    )


def meter_usage(
    records: DataFrame, every: str = "1 hour", dimensions: Sequence[str] = METER_DIMENSIONS
) -> DataFrame:
    """Records and their size per signal, dimensions and time window."""
    plain = records.select("signal", "ts", "size", *_dimensions(F.col("attributes"), dict.fromkeys(dimensions)))
    names = [column_name(d) for d in dimensions]
    return (
        plain.groupBy(F.window("ts", every).alias("w"), "signal", *names)
        .agg(F.count("*").alias("records"), F.sum("size").alias("size"))
        .select(F.col("w.start").alias("window_start"), "signal", *names, "records", "size")
    )


def latency_histogram(
    spans: DataFrame,
    every: str = "60 seconds",
    bounds: Sequence[float] = LATENCY_BOUNDS_MS,
    dimensions: Mapping[str, str | None] = SPAN_DIMENSIONS,
) -> DataFrame:
    """Spans per time window, dimensions and latency bucket; each window counts only its own spans."""
    names = [column_name(d) for d in dimensions]
    return (
        spans.select(
            "ts",
            *_dimensions(F.col("attributes"), dimensions),
            histograms.bucket_of(F.col("duration_ms"), bounds).alias("bucket"),
        )
        .groupBy(F.window("ts", every).alias("w"), *names, "bucket")
        .agg(F.count("*").alias("spans"))
        .select(F.col("w.start").alias("window_start"), *names, "bucket", "spans")
    )


def latency_quantiles(
    histogram: DataFrame,
    quantiles: Sequence[float],
    by: Sequence[str] = ("service_name",),
    bounds: Sequence[float] = LATENCY_BOUNDS_MS,
) -> DataFrame:
    """Latency quantiles per group, from bucket counts alone."""
    limits = F.array(*[F.lit(float(b)) for b in bounds])
    counted = histogram.groupBy(*by).agg(
        histograms.bucket_counts(F.col("bucket"), F.col("spans"), len(bounds) + 1).alias("counts")
    )
    return counted.select(
        *by, *[histograms.histogram_quantile(limits, F.col("counts"), q).alias(quantile_name(q)) for q in quantiles]
    )


def quantile_name(q: float) -> str:
    return "p" + f"{q * 100:g}".replace(".", "_")


def exponential_histogram(
    spans: DataFrame,
    scale: int = 3,
    every: str = "60 seconds",
    dimensions: Mapping[str, str | None] = SPAN_DIMENSIONS,
) -> DataFrame:
    """Spans per time window, dimensions and exponential bucket; durations that are not positive have no bucket."""
    names = [column_name(d) for d in dimensions]
    return (
        spans.select(
            "ts",
            *_dimensions(F.col("attributes"), dimensions),
            histograms.exponential_bucket(F.col("duration_ms"), scale).alias("bucket"),
        )
        .groupBy(F.window("ts", every).alias("w"), *names, "bucket")
        .agg(F.count("*").alias("spans"))
        .select(F.col("w.start").alias("window_start"), *names, "bucket", "spans")
    )


def attribute_catalogue(records: DataFrame) -> DataFrame:
    """Attribute keys per signal: records carrying them and number of distinct values."""
    return (
        records.select("signal", F.explode("attributes").alias("attribute", "value"))
        .groupBy("signal", "attribute")
        .agg(F.count("*").alias("records"), F.count_distinct("value").alias("distinct_values"))
    )
