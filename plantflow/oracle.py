"""The registered queries once more, as plain SQL for a single-node database.

Written independently of the Spark jobs: samples look up what held at their moment with as-of joins, and intervals come
from a sweep over edges, where the jobs carry state along the log. Used to check results only.
"""

from __future__ import annotations

from plantflow.plans.observability import LATENCY_BOUNDS_MS

_FROM = "TIMESTAMP '2024-01-05 00:00:00'"
_TO = "TIMESTAMP '2024-01-25 00:00:00'"
_TIMEOUT = "INTERVAL 43200 SECOND"
_MIN_PIECES = 30
# What a reading adds: the difference to the one before, all of it after a restart, `opening` without one before.
_STEP = "CASE WHEN previous_value IS NULL THEN opening WHEN value < previous_value THEN value ELSE value - previous_value END"

_CTES = {
    "ev": """
        SELECT event_id, ts, CAST(user_id AS INTEGER) AS machine_id, event_type AS kind, value AS reading,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, CAST(floor(value) AS BIGINT) AS iv
        FROM events""",
    "me": """
        SELECT event_id, ts AS "timestamp", machine_id,
               CASE kind WHEN 'signup' THEN 'DataValid' WHEN 'view' THEN 'MachinePieceCounter'
                         WHEN 'click' THEN 'LinePieceCounter' WHEN 'purchase' THEN 'MachineRejectedPieces'
                         ELSE 'MachineAnomaly' END AS variable,
               CASE WHEN kind IN ('signup', 'error') THEN 'Boolean' ELSE 'Int32' END AS type,
               CAST(CASE kind WHEN 'signup' THEN CASE WHEN k % 4 = 0 THEN 0 ELSE 1 END
                              WHEN 'error' THEN k % 2
                              WHEN 'purchase' THEN counted % 97
                              ELSE counted % 503 END AS INTEGER) AS value,
               CASE kind WHEN 'error' THEN 'D' ELSE 'R' END AS event_type, k
        FROM (SELECT *, SUM(iv) OVER (PARTITION BY machine_id, kind ORDER BY ts, event_id) AS counted FROM ev)""",
    "machines": "SELECT DISTINCT machine_id FROM me",
    # What holds at a moment is the last event at or before it; of events at one moment the last one counts.
    "valid_at": """
        SELECT machine_id, "timestamp" AS at, arg_max(value, event_id) AS flag
        FROM me WHERE variable = 'DataValid' GROUP BY ALL""",
    "alarm_at": """
        SELECT machine_id, "timestamp" AS at, arg_max(value, event_id) AS flag
        FROM me WHERE variable = 'MachineAnomaly' GROUP BY ALL""",
    "inside": f"""
        SELECT me.*, GREATEST(v.at, {_FROM}) AS interval_start,
               ROW_NUMBER() OVER (ORDER BY me."timestamp", me.event_id) AS place
        FROM me ASOF JOIN valid_at v ON me.machine_id = v.machine_id AND me."timestamp" >= v.at
        WHERE v.flag = 1 AND me.variable <> 'DataValid' AND me."timestamp" >= {_FROM} AND me."timestamp" < {_TO}""",
    "readings": "SELECT * FROM inside WHERE variable IN ('MachinePieceCounter', 'MachineRejectedPieces')",
    "compared": """
        SELECT a.*, b.value AS previous_value
        FROM readings a ASOF LEFT JOIN readings b
          ON a.machine_id = b.machine_id AND a.variable = b.variable AND a.interval_start = b.interval_start
             AND a.place > b.place""",
    "made": f"""
        SELECT machine_id, SUM(n) FILTER (variable = 'MachinePieceCounter') AS pieces,
               SUM(n) FILTER (variable = 'MachineRejectedPieces') AS rejects
        FROM (SELECT machine_id, variable, {_STEP} AS n FROM (SELECT *, 0 AS opening FROM compared)) GROUP BY machine_id""",
    "started": """
        SELECT machine_id, COUNT(*) AS n FROM inside WHERE variable = 'MachineAnomaly' AND value = 1 GROUP BY machine_id""",
    # Every change of validity or anomaly is an edge; between two edges both stay as they are.
    "edges": f"""
        SELECT DISTINCT machine_id, GREATEST("timestamp", {_FROM}) AS t
        FROM me WHERE variable IN ('DataValid', 'MachineAnomaly') AND "timestamp" < {_TO}""",
    "valid_alarms": f"""
        SELECT e.machine_id, e.t AS interval_start, COALESCE(n.t, {_TO}) AS interval_end
        FROM edges e
             ASOF JOIN valid_at v ON e.machine_id = v.machine_id AND e.t >= v.at
             ASOF JOIN alarm_at a ON e.machine_id = a.machine_id AND e.t >= a.at
             ASOF LEFT JOIN edges n ON e.machine_id = n.machine_id AND e.t < n.t
        WHERE v.flag = 1 AND a.flag = 1""",
    "stood": """
        SELECT machine_id, CAST(SUM(date_diff('microsecond', interval_start, interval_end)) AS BIGINT) AS us
        FROM valid_alarms GROUP BY machine_id""",
    "figures": """
        SELECT machine_id,
               CAST(COALESCE(pieces, 0) AS BIGINT) AS total_pieces_counted,
               CAST(COALESCE(rejects, 0) AS BIGINT) AS total_rejected_pieces,
               COALESCE(CAST(rejects AS DOUBLE) * 100.0 / NULLIF(CAST(pieces AS DOUBLE), 0), 0) AS rejected_percentage,
               CAST(COALESCE(n, 0) AS BIGINT) AS total_anomalies,
               COALESCE(us, 0) / CAST(1000000 AS DOUBLE) AS total_anomaly_seconds
        FROM machines LEFT JOIN made USING (machine_id) LEFT JOIN started USING (machine_id)
             LEFT JOIN stood USING (machine_id)""",
    # Machine states.
    "st": """
        SELECT event_id, ts AS "timestamp", machine_id,
               CASE k % 4 WHEN 0 THEN 'InAlarm' WHEN 1 THEN 'InBypass' WHEN 2 THEN 'InCycle' ELSE 'InWarning' END
                 AS variable,
               CAST(iv % 2 AS INTEGER) AS value
        FROM ev""",
    "line": f"""
        SELECT machine_id, variable, value, GREATEST(since, {_FROM}) AS interval_start,
               LEAST(COALESCE(till, {_TO}), {_TO}) AS interval_end
        FROM (SELECT machine_id, variable, "timestamp" AS since, value,
                     LEAD("timestamp") OVER (PARTITION BY machine_id, variable ORDER BY "timestamp", event_id) AS till
              FROM st WHERE "timestamp" <= {_TO})
        WHERE since < {_TO} AND (till IS NULL OR till > {_FROM})""",
    # Watchdog: samples numbered by the machine samples before them, then grouped by that number.
    "watched": """
        SELECT event_id, "timestamp", machine_id, variable, value,
               COUNT(*) FILTER (WHERE variable = 'MachinePieceCounter') OVER w AS epoch,
               COALESCE(MAX("timestamp") FILTER (WHERE variable = 'MachinePieceCounter') OVER w,
                        MIN("timestamp") OVER (PARTITION BY machine_id)) AS last_machine_ts
        FROM me WHERE variable IN ('MachinePieceCounter', 'LinePieceCounter')
        WINDOW w AS (PARTITION BY machine_id ORDER BY "timestamp", event_id)""",
    "stepped": """
        SELECT *, CAST(CASE WHEN value < before THEN value ELSE value - before END AS BIGINT) AS delta
        FROM (SELECT *, LAG(value, 1, 0) OVER (PARTITION BY machine_id ORDER BY "timestamp", event_id) AS before
              FROM watched WHERE variable = 'LinePieceCounter')""",
    "pieced": """
        SELECT *, CAST(SUM(delta) OVER (PARTITION BY machine_id, epoch ORDER BY "timestamp", event_id) AS BIGINT)
                    AS pieces
        FROM stepped""",
    "raised": f"""
        SELECT event_id, "timestamp", machine_id, epoch, last_machine_ts, pieces
        FROM pieced WHERE "timestamp" > last_machine_ts + {_TIMEOUT} AND pieces >= {_MIN_PIECES}
        QUALIFY ROW_NUMBER() OVER (PARTITION BY machine_id, epoch ORDER BY "timestamp", event_id) = 1""",
    "derived": """
        SELECT event_id, "timestamp", machine_id, 'MachineAnomaly' AS variable, 'Boolean' AS type, value,
               'D' AS event_type
        FROM (SELECT event_id, "timestamp", machine_id, 1 AS value FROM raised
              UNION ALL
              SELECT w.event_id, w."timestamp", w.machine_id, 0 AS value
              FROM raised r JOIN watched w ON w.machine_id = r.machine_id AND w.epoch = r.epoch + 1
                                          AND w.variable = 'MachinePieceCounter')""",
    # Messages as published.
    "sent": """
        SELECT event_id, k,
               CASE WHEN k % 10 = 0 THEN 'test/plant/' ELSE 'prod/plant/' END || machine_id || '/' AS topic,
               "timestamp" AS received,
               CASE WHEN variable = 'DataValid' THEN CAST(0 AS DOUBLE)
                    ELSE epoch_us("timestamp") / CAST(1000000 AS DOUBLE) END AS "timestamp",
               machine_id, variable, type, value,
               CASE WHEN variable <> 'DataValid' THEN event_type END AS event_type
        FROM me""",
    # Orders.
    "placed": """
        SELECT o_orderkey AS order_id, o_orderkey % 200 AS article_id,
               CAST(floor(o_custkey / 10.0) AS INTEGER) AS machine_id, 50 + o_orderkey % 100 AS target_qty,
               TIMESTAMP '2024-01-01' + to_minutes(18 * date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)))
                 AS start_date
        FROM orders""",
    "scheduled": """
        SELECT *, LEAD(start_date) OVER (PARTITION BY machine_id ORDER BY start_date, order_id) AS end_date
        FROM placed""",
    "stated": """
        SELECT l_orderkey AS order_id, l_shipdate AS "timestamp", l_linenumber, l_partkey, l_suppkey, l_discount,
               CAST(l_quantity AS INTEGER) AS produced_qty,
               CAST(floor(l_quantity * l_discount) AS INTEGER) AS discarded_qty
        FROM lineitem""",
    "progressed": """
        SELECT order_id, "timestamp", produced_qty, discarded_qty,
               CAST(SUM(produced_qty) OVER w AS BIGINT) AS produced_total,
               CAST(SUM(discarded_qty) OVER w AS BIGINT) AS discarded_total,
               CAST(SUM(produced_qty - discarded_qty) OVER w AS BIGINT) AS good_total
        FROM stated
        WINDOW w AS (PARTITION BY order_id ORDER BY "timestamp", l_linenumber, l_partkey, l_suppkey, produced_qty,
                     l_discount ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    # Observability.
    "tel": """
        SELECT event_id, ts, kind, k, reading, 'GW-' || machine_id AS host,
               CASE k % 3 WHEN 1 THEN 'development' WHEN 2 THEN 'production' END AS environment,
               CASE k % 3 WHEN 0 THEN 'MQTT' WHEN 1 THEN 'OPC UA' ELSE 'MESAPI' END AS component,
               CASE kind WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'purchase' THEN 'DEBUG'
                         ELSE 'INFO' END AS severity,
               CASE WHEN kind = 'error' AND k % 3 < 2 THEN 'Connection lost. New connection attempt in 3s...'
                    ELSE kind END AS text
        FROM ev""",
    "logged": "SELECT * FROM tel WHERE severity <> 'DEBUG'",
    "shown": """
        SELECT *, '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '"' AS head,
               '"host.name":"' || host || '"' || COALESCE(',"deployment.environment":"' || environment || '"', '') || '}}' AS tail
        FROM tel""",
    "metered": """
        SELECT 'logs' AS signal, ts, CAST(NULL AS VARCHAR) AS service, environment, host,
               strlen(head || ',"severity":"' || severity || '","body":"PLANT | ' || host || ' | ' || component || ' | '
                      || text || '","resource":{' || tail) AS size FROM shown
        UNION ALL
        SELECT 'traces', ts, kind, environment, host,
               strlen(head || ',"duration_ms":' || reading || ',"attributes":{"service.name":"' || kind || '",' || tail)
        FROM shown
        UNION ALL
        SELECT 'metrics', ts, NULL, environment, host, strlen(head || ',"name":"pieces","attributes":{' || tail)
        FROM shown WHERE kind = 'view'""",
    "bucketed": "SELECT *, "
    + " + ".join(f"CAST(reading > {bound} AS INTEGER)" for bound in LATENCY_BOUNDS_MS)
    + " AS bucket FROM tel",
    "limits": "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, CAST({bound} AS DOUBLE))" for i, bound in enumerate(LATENCY_BOUNDS_MS))
    + ") AS v(bucket, upper)",
    "accumulated": """
        SELECT kind, bucket, n, CAST(SUM(n) OVER (PARTITION BY kind ORDER BY bucket) AS DOUBLE) AS seen,
               CAST(SUM(n) OVER (PARTITION BY kind) AS DOUBLE) AS whole,
               COALESCE((SELECT upper FROM limits WHERE limits.bucket = c.bucket - 1), 0) AS lower,
               (SELECT upper FROM limits WHERE limits.bucket = c.bucket) AS upper
        FROM (SELECT kind, bucket, CAST(COUNT(*) AS DOUBLE) AS n FROM bucketed GROUP BY kind, bucket) c""",
}

_NEEDS = {
    "me": ["ev"],
    "machines": ["me"],
    "valid_at": ["me"],
    "alarm_at": ["me"],
    "inside": ["valid_at"],
    "readings": ["inside"],
    "compared": ["readings"],
    "made": ["compared"],
    "started": ["inside"],
    "edges": ["me"],
    "valid_alarms": ["edges", "valid_at", "alarm_at"],
    "stood": ["valid_alarms"],
    "figures": ["machines", "made", "started", "stood"],
    "st": ["ev"],
    "line": ["st"],
    "watched": ["me"],
    "stepped": ["watched"],
    "pieced": ["stepped"],
    "raised": ["pieced"],
    "derived": ["raised"],
    "sent": ["me"],
    "scheduled": ["placed"],
    "progressed": ["stated"],
    "tel": ["ev"],
    "logged": ["tel"],
    "shown": ["tel"],
    "metered": ["shown"],
    "bucketed": ["tel"],
    "accumulated": ["bucketed", "limits"],
}


def _on(*names: str) -> str:
    """WITH clause that defines the named tables and what they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in ordered) + "\n"


_DELTAS = """SELECT event_id, "timestamp", machine_id, variable, type, value, event_type, interval_start,
                    CAST(previous_value AS DOUBLE) AS previous_value, """
_CHUNK = 'make_timestamp(epoch_us("timestamp") - epoch_us("timestamp") % 604800000000)'
_CHUNKS = f"""
    SELECT chunk_start, chunk_start + INTERVAL 7 DAY AS chunk_end, COUNT(*) AS rows, MIN("timestamp") AS first_event,
           MAX("timestamp") AS last_event
    FROM (SELECT {_CHUNK} AS chunk_start, "timestamp" FROM me)
    GROUP BY chunk_start"""
_MODEL = 'event_id, "timestamp", machine_id, variable, type, value, event_type'
_SPAN_KEYS = (
    "date_trunc('minute', ts) AS window_start, kind AS service_name, 'default' AS service_namespace, "
    "COALESCE(environment, 'default') AS deployment_environment, host AS host_name, "
    + ", ".join(
        f"CAST(NULL AS VARCHAR) AS {name}"
        for name in (
            "collector_id service_version browser_platform browser_mobile k8s_cluster_name k8s_node_name "
            "k8s_namespace_name host_type container_name"
        ).split()
    )
)


def _quantile(q: float) -> str:
    return f"""
        (SELECT CASE WHEN upper IS NULL THEN lower
                     ELSE lower + (upper - lower) * (({q} * whole - (seen - n)) / n) END
         FROM accumulated a WHERE a.kind = g.kind AND a.seen >= {q} * a.whole ORDER BY a.bucket LIMIT 1)"""


def _share(where: str, whole: str) -> str:
    return f"""
    SELECT machine_id, variable, on_us,
           COALESCE(CAST(on_us AS DOUBLE) * 100.0 / NULLIF(CAST({whole} AS DOUBLE), 0), 0) AS share_percent
    FROM (SELECT machine_id, variable,
                 CAST(SUM(CASE WHEN value = 1 THEN epoch_us(interval_end) - epoch_us(interval_start) ELSE 0 END)
                      AS BIGINT) AS on_us,
                 CAST(SUM(epoch_us(interval_end) - epoch_us(interval_start)) AS BIGINT) AS known_us
          FROM line {where} GROUP BY machine_id, variable)"""


def oracle_sql() -> dict[str, str]:
    range_us = "(epoch_us(" + _TO + ") - epoch_us(" + _FROM + "))"
    return {
        "pieces_total": _on("figures") + "SELECT machine_id, total_pieces_counted FROM figures",
        "rejected_total": _on("figures") + "SELECT machine_id, total_rejected_pieces FROM figures",
        "rejected_percentage": _on("figures") + "SELECT machine_id, rejected_percentage FROM figures",
        "anomaly_starts": _on("figures") + "SELECT machine_id, total_anomalies FROM figures",
        "anomaly_seconds": _on("figures") + "SELECT machine_id, total_anomaly_seconds FROM figures",
        "kpi_summary": _on("figures") + "SELECT * FROM figures",
        "kpi_summary_from_days": (_on("figures") + "SELECT * FROM figures")
        .replace(_FROM, "TIMESTAMP '2024-01-05 07:30:00'")
        .replace(_TO, "TIMESTAMP '2024-01-24 15:45:00'"),
        **dict.fromkeys(("kpi_summary_stored", "kpi_summary_sql"), _on("figures") + "SELECT * FROM figures"),
        "machine_register": _on("me")
        + 'SELECT machine_id, MIN("timestamp") AS first_seen, MAX("timestamp") AS last_seen FROM me GROUP BY machine_id',
        "pieces_total_one_machine": _on("figures")
        + "SELECT machine_id, total_pieces_counted FROM figures WHERE machine_id = 7",
        "ingest_topic_filter": _on("sent")
        + "SELECT event_id, topic FROM sent WHERE topic = 'prod/plant' OR topic LIKE 'prod/plant/%'",
        "ingest_payload_projection": _on("sent")
        + f"SELECT {_MODEL} FROM sent WHERE topic LIKE 'prod/plant/%'",
        "ingest_timestamp": _on("sent")
        + "SELECT event_id, variable, received AS \"timestamp\" FROM sent WHERE topic LIKE 'prod/plant/%'",
        "ingest_valid_rows": _on("me") + f"SELECT {_MODEL} FROM me WHERE k % 17 NOT IN (3, 5, 7) AND NOT (k % 17 = 9 AND variable = 'DataValid')",
        "ingest_quarantine": _on("sent")
        + """SELECT event_id, topic, CASE k % 17 WHEN 3 THEN 'no type' WHEN 9 THEN 'no order of receipt'
                                                 ELSE 'unreadable payload' END AS reject_reasons
             FROM sent WHERE k % 17 IN (3, 5, 7) OR (k % 17 = 9 AND variable = 'DataValid')""",
        "monitored_items_filter": _on("me")
        + f"SELECT {_MODEL} FROM me WHERE variable = 'LinePieceCounter' OR variable = 'MachinePieceCounter'",
        "node_metadata_lookup": _on("ev")
        + """SELECT event_id, machine_id, 'ns=2;s=Channel1.Device1.' || kind AS node_id, iv AS value,
                    CASE kind WHEN 'view' THEN 'View' WHEN 'click' THEN 'Click' WHEN 'purchase' THEN 'Purchase'
                              ELSE 'ns=2;s=Channel1.Device1.' || kind END AS variable,
                    CASE WHEN kind IN ('view', 'click', 'purchase') THEN 'Int32' ELSE 'Unknown' END AS type
             FROM ev""",
        "value_to_int": _on("ev")
        + """SELECT event_id, machine_id, CAST(CASE k % 3 WHEN 0 THEN iv % 2 WHEN 1 THEN trunc(reading)
                                                      ELSE trunc(-reading) END AS INTEGER) AS value FROM ev""",
        "static_enrichment": _on("me")
        + """SELECT event_id, "timestamp", machine_id, variable, 'Tag' AS type, value, event_type, 'north' AS site
             FROM me""",
        "payload_roundtrip": _on("me") + f"SELECT {_MODEL} FROM me",
        "merged_event_log": _on("derived")
        + f"SELECT {_MODEL} FROM me WHERE event_type = 'R' UNION ALL SELECT {_MODEL} FROM derived",
        "chunk_inventory": _on("me") + _CHUNKS,
        "retention_surviving_chunks": _on("me")
        + f"SELECT * FROM ({_CHUNKS}) WHERE chunk_end > TIMESTAMP '2025-02-15' - INTERVAL 13 MONTH",
        "state_intervals": _on("line")
        + "SELECT machine_id, variable, interval_start, interval_end FROM line WHERE value = 1",
        "state_timeline": _on("line") + "SELECT * FROM line",
        "state_time_share": _on("line") + _share("", range_us),
        "state_known_share": _on("line") + _share("WHERE variable IN ('InAlarm', 'InCycle')", "known_us"),
        "overlaps_predicate": _on("ev")
        + """SELECT event_id, a0 = b0 OR (a0 < b0 AND b0 < a1) OR (b0 < a0 AND a0 < b1) AS "overlaps"
             FROM (SELECT event_id, LEAST(s, t) AS a0, GREATEST(s, t) AS a1, LEAST(u, v) AS b0, GREATEST(u, v) AS b1
                   FROM (SELECT event_id, ts AS s, ts + to_minutes(iv % 60 - 30) AS t, ts + to_minutes(k - 50) AS u,
                                ts + to_minutes(k - 50 + (k % 7 - 3) * 10) AS v FROM ev))""",
        "events_in_valid_intervals": _on("inside") + f"SELECT {_MODEL}, interval_start FROM inside",
        "counter_deltas": _on("compared")
        + f"{_DELTAS} CAST({_STEP} AS BIGINT) AS delta FROM (SELECT *, 0 AS opening FROM compared)",
        "counter_deltas_from_zero": _on("compared")
        + f"{_DELTAS} CAST({_STEP} AS BIGINT) AS delta FROM (SELECT *, value AS opening FROM compared)",
        "anomaly_valid_overlap": _on("valid_alarms") + "SELECT * FROM valid_alarms",
        "interval_intersection": _on("line")
        + """SELECT a.machine_id, GREATEST(a.interval_start, c.interval_start) AS interval_start,
                    LEAST(a.interval_end, c.interval_end) AS interval_end
             FROM line a JOIN line c ON a.machine_id = c.machine_id AND a.interval_start < c.interval_end
                                    AND c.interval_start < a.interval_end
             WHERE a.variable = 'InAlarm' AND a.value = 1 AND c.variable = 'InCycle' AND c.value = 1""",
        "watchdog_epochs": _on("watched")
        + 'SELECT event_id, "timestamp", machine_id, variable, value, epoch, last_machine_ts FROM watched',
        "line_pieces_since_machine": _on("pieced")
        + 'SELECT event_id, "timestamp", machine_id, variable, value, epoch, delta, pieces FROM pieced',
        "watchdog_raised": _on("raised") + "SELECT * FROM raised",
        "watchdog_events": _on("derived") + "SELECT * FROM derived",
        "order_enrichment": _on("me", "scheduled")
        + """SELECT me.event_id, me.machine_id, me."timestamp", me.variable, CAST(o.order_id AS DOUBLE) AS order_id
             FROM me LEFT JOIN scheduled o ON me.machine_id = o.machine_id AND me."timestamp" >= o.start_date
                                          AND me."timestamp" < COALESCE(o.end_date, TIMESTAMP '9999-01-01')""",
        "order_enrichment_overlapping": _on("me", "scheduled")
        + """SELECT me.event_id, me.machine_id, me."timestamp", me.variable,
                    CAST(arg_max(o.order_id, (o.start_date, o.order_id)) AS DOUBLE) AS order_id
             FROM me LEFT JOIN (SELECT order_id, machine_id, start_date,
                                       CASE order_id % 7 WHEN 0 THEN TIMESTAMP '9999-01-01'
                                                         WHEN 3 THEN end_date + INTERVAL 20 DAY ELSE end_date END AS until
                                FROM scheduled) o
                    ON me.machine_id = o.machine_id AND me."timestamp" >= o.start_date
                       AND me."timestamp" < COALESCE(o.until, TIMESTAMP '9999-01-01')
             GROUP BY ALL""",
        "active_order_at": _on("scheduled")
        + """SELECT machine_id, order_id FROM scheduled
             WHERE start_date <= TIMESTAMP '2024-01-12 06:00:00'
               AND (end_date IS NULL OR end_date > TIMESTAMP '2024-01-12 06:00:00')""",
        "order_dates": _on("stated")
        + 'SELECT order_id, MIN("timestamp") AS start_date, MAX("timestamp") AS end_date FROM stated GROUP BY order_id',
        "order_completion": _on("progressed", "placed")
        + """SELECT order_id, target_qty, CAST(SUM(produced_qty - discarded_qty) AS BIGINT) AS good_qty,
                    MIN(CASE WHEN good_total >= target_qty THEN "timestamp" END) AS completed_at,
                    MAX("timestamp") AS last_statement_at
             FROM progressed JOIN placed USING (order_id) GROUP BY order_id, target_qty""",
        "order_summary": _on("scheduled")
        + f"""SELECT order_id, machine_id, article_id, p_name AS description, target_qty, start_date, end_date
              FROM scheduled JOIN part ON p_partkey = article_id
              WHERE CASE WHEN start_date = {_FROM} THEN TRUE
                         WHEN start_date > {_FROM} THEN start_date < {_TO}
                         ELSE end_date IS NULL OR end_date > {_FROM} END""",
        "order_progress": _on("progressed") + "SELECT * FROM progressed",
        "log_parse": _on("logged")
        + """SELECT event_id, ts, severity, host, component, text, host AS resource_host,
                    COALESCE(environment, 'default') AS environment FROM logged""",
        "log_rollup": _on("logged")
        + """SELECT date_trunc('hour', ts) AS window_start, host, component, severity, COUNT(*) AS lines
             FROM logged GROUP BY ALL""",
        "reconnects_per_host": _on("logged")
        + """SELECT host, COUNT(*) AS reconnects FROM logged WHERE text LIKE '%New connection attempt%'
             GROUP BY host""",
        **dict.fromkeys(
            ("usage_meter_hourly", "usage_meter_merged"),
            _on("metered")
            + """SELECT date_trunc('hour', ts) AS window_start, signal, service AS service_name,
                        environment AS deployment_environment, host AS host_name, COUNT(*) AS records,
                        CAST(SUM(size) AS BIGINT) AS size
                 FROM metered GROUP BY ALL""",
        ),
        "span_latency_histogram": _on("bucketed")
        + f"SELECT {_SPAN_KEYS}, bucket, COUNT(*) AS spans FROM bucketed GROUP BY ALL",
        "span_exp_histogram": _on("tel")
        + f"""SELECT {_SPAN_KEYS}, CASE WHEN reading > 0 THEN CAST(ceil(log2(reading) * 8) - 1 AS INTEGER) END AS bucket,
                    COUNT(*) AS spans FROM tel GROUP BY ALL""",
        "latency_quantiles": _on("accumulated")
        + f"""SELECT kind AS service_name, {_quantile(0.5)} AS p50, {_quantile(0.95)} AS p95, {_quantile(0.99)} AS p99
              FROM (SELECT DISTINCT kind FROM accumulated) g""",
        "attribute_catalogue": _on("metered")
        + """SELECT signal, attribute, COUNT(*) AS records, COUNT(DISTINCT value) AS distinct_values
             FROM (SELECT signal, 'service.name' AS attribute, service AS value FROM metered
                   UNION ALL SELECT signal, 'deployment.environment', environment FROM metered
                   UNION ALL SELECT signal, 'host.name', host FROM metered)
             WHERE value IS NOT NULL GROUP BY signal, attribute""",
    }
