"""The figures as SQL table functions whose arguments reach the scan.

    sqlfunctions.register(spark, eventtable.read(spark, table), register.read(spark))
    spark.sql("SELECT * FROM pieces_total(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-12', 7)")
    spark.sql("SELECT * FROM kpi_summary(:from, :to, NULL)", args={"from": ..., "to": ...})

A function takes the range's start (inclusive) and end (exclusive) and a machine, or NULL for all; for one machine it
returns one row, also if that never reported. Spark puts the function's query in place of the call, so dates, variables
and the machine are conditions of the scan like any others. On events from `snapshots.StateSnapshots.events` no history
is read. These are plain windows per machine; for hot machines the functions in `kpis` take a plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantflow import schema
from plantflow.plans import kpis
from plantflow.sources import eventlog

EVENTS, MACHINES = "plantflow_events", "plantflow_machines"

_TYPES = {kpis.PIECES: "BIGINT", kpis.REJECTED: "BIGINT", kpis.REJECTED_SHARE: "DOUBLE", kpis.ANOMALIES: "BIGINT", kpis.ANOMALY_SECONDS: "DOUBLE"}
_SHOWN = {
    kpis.PIECES: "COALESCE(pieces, 0)",
    kpis.REJECTED: "COALESCE(rejects, 0)",
    kpis.REJECTED_SHARE: "COALESCE(CAST(COALESCE(rejects, 0) AS DOUBLE) * 100.0D / NULLIF(CAST(COALESCE(pieces, 0) AS DOUBLE), 0.0D), 0.0D)",
    kpis.ANOMALIES: "COALESCE(starts, 0)",
    kpis.ANOMALY_SECONDS: "COALESCE(stood, 0) / 1000000.0D",
}
#: Function to its columns and the variables it reads: samples, and states whose value before the range counts.
FUNCTIONS = {
    "pieces_total": ([kpis.PIECES], [schema.PIECE_COUNTER], []),
    "rejected_total": ([kpis.REJECTED], [schema.REJECT_COUNTER], []),
    "rejected_percentage": ([kpis.REJECTED_SHARE], [schema.PIECE_COUNTER, schema.REJECT_COUNTER], []),
    "anomaly_starts": ([kpis.ANOMALIES], [schema.MACHINE_ANOMALY], []),
    "anomaly_seconds": ([kpis.ANOMALY_SECONDS], [], [schema.MACHINE_ANOMALY]),
    "kpi_summary": (list(_TYPES), [schema.PIECE_COUNTER, schema.REJECT_COUNTER], [schema.MACHINE_ANOMALY]),
}


def _day(moment: str) -> str:
    return f"date_from_unix_date(CAST(floor(unix_micros({moment}) / 86400000000) AS INT))"


def _query(columns: list[str], samples: list[str], states: list[str], dated: bool) -> str:
    """Written over from_ts, to_ts and machine, the function's parameters."""
    states = [schema.DATA_VALID, *states]
    one = "(machine IS NULL OR machine_id = machine)"
    inside = "timestamp >= from_ts AND timestamp < to_ts" + (f" AND event_date BETWEEN {_day('from_ts')} AND {_day('to_ts')}" if dated else "")
    before = "timestamp < from_ts" + (f" AND event_date <= {_day('from_ts')}" if dated else "")

    def named(names: list[str]) -> str:
        return " OR ".join(f"variable = '{v}'" for v in names)

    order = f"PARTITION BY machine_id ORDER BY timestamp, variable <> '{schema.DATA_VALID}', event_id"

    def carried(value: str, variable: str, name: str, rows: str = "") -> str:
        return f"last_value(CASE WHEN variable = '{variable}' THEN {value} END, true) OVER ({order} {rows}) AS {name}"

    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    running = [carried("timestamp", schema.DATA_VALID, "since"), carried("value", schema.DATA_VALID, "valid")]
    for name, variable in (("pieces", schema.PIECE_COUNTER), ("rejects", schema.REJECT_COUNTER)):
        running += [carried("timestamp", variable, f"{name}_ts", earlier), carried("value", variable, f"{name}_value", earlier)]
    running += [carried("value", schema.MACHINE_ANOMALY, "anomaly"), f"lead(timestamp) OVER ({order}) AS until"]

    def advance(name: str, variable: str) -> str:
        previous = f"CASE WHEN {name}_ts >= greatest(since, first) THEN {name}_value END"
        return f"""sum(CASE WHEN valid = 1 AND variable = '{variable}' THEN
            CASE WHEN ({previous}) IS NULL THEN 0 WHEN value < ({previous}) THEN value ELSE value - ({previous}) END END) AS {name}"""

    lasted = "unix_micros(COALESCE(until, last)) - unix_micros(greatest(timestamp, first))"
    figures = [advance("pieces", schema.PIECE_COUNTER), advance("rejects", schema.REJECT_COUNTER)]
    figures.append(f"count_if(valid = 1 AND variable = '{schema.MACHINE_ANOMALY}' AND value = 1 AND timestamp >= first) AS starts")
    figures.append(f"sum(CASE WHEN valid = 1 AND anomaly = 1 AND {lasted} > 0 THEN {lasted} END) AS stood")
    return f"""
    WITH log AS (
      SELECT machine_id, timestamp, event_id, variable, value, from_ts AS first, to_ts AS last FROM {EVENTS}
      WHERE ({named([*samples, *states])}) AND {one} AND {inside}
      UNION ALL
      SELECT machine_id, latest.timestamp, latest.event_id, variable, latest.value, from_ts, to_ts
      FROM (SELECT machine_id, variable, max(struct(timestamp, event_id, value)) AS latest FROM {EVENTS}
            WHERE ({named(states)}) AND {one} AND {before} GROUP BY machine_id, variable)),
    carried AS (SELECT *, {", ".join(running)} FROM log),
    figures AS (SELECT machine_id, {", ".join(figures)} FROM carried GROUP BY machine_id),
    wanted AS (
      SELECT machine AS machine_id WHERE machine IS NOT NULL
      UNION ALL
      SELECT machine_id FROM {MACHINES} WHERE machine IS NULL)
    SELECT w.machine_id, {", ".join(f"{_SHOWN[c]} AS {c}" for c in columns)}
    FROM wanted w LEFT JOIN figures f ON w.machine_id = f.machine_id"""


def register(spark: SparkSession, events: DataFrame, machines: DataFrame | None = None) -> list[str]:
    """Creates or replaces the functions, temporary to the session, over the events; returns their names."""
    events.createOrReplaceTempView(EVENTS)
    everyone = kpis.machines_of(events) if machines is None else machines.select("machine_id").distinct()
    everyone.createOrReplaceTempView(MACHINES)
    dated = eventlog.EVENT_DATE in events.columns
    for name, (columns, samples, states) in FUNCTIONS.items():
        fields = ", ".join(f"{c} {_TYPES[c]}" for c in columns)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(from_ts TIMESTAMP, to_ts TIMESTAMP, machine INT) "
            f"RETURNS TABLE (machine_id INT, {fields}) RETURN {_query(columns, samples, states, dated)}"
        )
    return list(FUNCTIONS)
