"""The registered queries once more, as plain SQL for a second engine."""

from __future__ import annotations

LOGS = """
events_k AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        CASE event_type WHEN 'click' THEN 'catalog' WHEN 'view' THEN 'reviews'
            WHEN 'purchase' THEN 'checkout' WHEN 'signup' THEN 'details'
            WHEN 'error' THEN 'cart' END AS base_route
    FROM events
),
raw_logs AS (
    SELECT event_id,
        make_timestamp((1704067200000000 + (epoch_us(ts) - 1704067200000000) // 720) // 1000 * 1000) AS event_time,
        CASE WHEN event_id % 50 <> 0 THEN base_route END AS http_route,
        ['store.routelens.test', 'search.routelens.test', 'media.routelens.test'][user_id % 3 + 1] AS hostname,
        ['GET', 'HEAD', 'PATCH', 'OPTIONS'][event_id % 4 + 1] AS method,
        '/api/v1/' || base_route || '/' || (k % 7) AS path,
        CAST(CASE WHEN event_type = 'view' AND event_id % 40 <> 0 THEN 200
            ELSE [200, 206, 504, 200, 429, 304, 200, 409, 202, 200, 501, 302, 410, 200, 422][k % 15 + 1] END AS INTEGER)
            AS status_code,
        CAST(floor(value * 4) AS BIGINT) AS response_time_ms,
        CAST(100 + event_id * 37 % 10000 AS BIGINT) AS bytes_sent,
        CAST(50 + event_id * 17 % 5000 AS BIGINT) AS bytes_received,
        base_route || '-cluster' AS upstream_cluster,
        '10.42.0.' || (user_id % 15) AS client_ip
    FROM events_k
),
logs AS (SELECT * REPLACE (coalesce(http_route, 'unknown') AS http_route) FROM raw_logs)
"""

CLOSED = "(SELECT max(event_time) FROM logs) - INTERVAL 5 SECOND"


def _pct(level: float) -> str:
    return f"percentile_cont({level}) WITHIN GROUP (ORDER BY response_time_ms)"


ERRORS = "count(*) FILTER (WHERE status_code >= 400)"
COUNTS = """
    http_route, window_start, window_end,
    count(*) AS request_count,
    count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS success_count,
    count(*) FILTER (WHERE status_code BETWEEN 400 AND 499) AS client_error_count,
    count(*) FILTER (WHERE status_code >= 500) AS server_error_count,
    avg(response_time_ms) AS avg_latency_ms
"""
TOTALS = f"""
    CAST(sum(bytes_sent) AS BIGINT) AS total_bytes_sent,
    CAST(sum(bytes_received) AS BIGINT) AS total_bytes_received,
    min(response_time_ms) AS min_latency_ms,
    max(response_time_ms) AS max_latency_ms,
    {ERRORS} / count(*) * 100 AS error_rate_pct
"""
PERCENTILES = f"""
    {_pct(0.5)} AS p50_latency_ms,
    {_pct(0.95)} AS p95_latency_ms,
    {_pct(0.99)} AS p99_latency_ms
"""
METRIC_COLUMNS = f"{COUNTS}, {TOTALS}, {PERCENTILES}"
BY_WINDOW = "GROUP BY http_route, window_start, window_end"


def _tumbling(source: str, minutes: int) -> str:
    return f"""(SELECT *, w AS window_start, w + INTERVAL {minutes} MINUTE AS window_end
        FROM (SELECT *, time_bucket(INTERVAL {minutes} MINUTE, event_time) AS w FROM {source}))"""


def _rolling(source: str) -> str:
    return f"""(SELECT *, w AS window_start, w + INTERVAL 5 MINUTE AS window_end
        FROM (SELECT s.*, date_trunc('minute', event_time) - o * INTERVAL 1 MINUTE AS w
              FROM {source} s CROSS JOIN range(5) AS offsets(o)))"""


def _metrics(windows: str) -> str:
    return f"SELECT {METRIC_COLUMNS} FROM {windows} {BY_WINDOW}"


METRICS_1M = f"m1 AS ({_metrics(_tumbling('logs', 1))})"
METRICS_5M = f"m5 AS ({_metrics(_rolling('logs'))})"

ALERTS = f"""
alerts AS (
    SELECT http_route, window_start, window_end, p99_latency_ms, p95_latency_ms, avg_latency_ms,
        CAST(500 AS BIGINT) AS threshold_ms, request_count, error_rate_pct,
        CASE WHEN p99_latency_ms / 500 >= 3 THEN 'CRITICAL' WHEN p99_latency_ms / 500 >= 2 THEN 'HIGH'
            WHEN p99_latency_ms / 500 >= 1.5 THEN 'MEDIUM' ELSE 'LOW' END AS severity
    FROM m1 WHERE p99_latency_ms > 500
)
"""

ERROR_EVENTS = """
SELECT event_time, http_route, hostname, method, path, status_code,
    CASE WHEN status_code >= 500 THEN 'SERVER_ERROR' ELSE 'CLIENT_ERROR' END AS error_category,
    response_time_ms, upstream_cluster, client_ip
FROM logs WHERE status_code >= 400
"""

MV_METRICS_1M = f"SELECT {COUNTS}, {TOTALS} FROM {_tumbling('raw_logs', 1)} {BY_WINDOW}"

MV_METRICS_1M_PCT = f"SELECT {COUNTS}, {PERCENTILES} FROM {_tumbling('raw_logs', 1)} {BY_WINDOW}"

MV_METRICS_5M = f"""
SELECT http_route, window_start, window_end, request_count, avg_latency_ms, p50_latency_ms, p90_latency_ms,
    p95_latency_ms, p99_latency_ms, error_rate_pct, request_count / 300 AS requests_per_second
FROM (SELECT {METRIC_COLUMNS}, {_pct(0.9)} AS p90_latency_ms FROM {_rolling('raw_logs')} {BY_WINDOW})
"""

MV_ERROR_EVENTS = """
SELECT event_time AS timestamp, http_route, hostname, method, path, status_code, response_time_ms,
    client_ip, upstream_cluster,
    CASE WHEN status_code >= 500 THEN 'server_error' WHEN status_code >= 400 THEN 'client_error'
        ELSE 'unknown' END AS error_type
FROM raw_logs WHERE status_code >= 400
"""

MV_LATENCY_ALERTS = f"""
SELECT http_route, window_start, window_end, {_pct(0.99)} AS p99_latency_ms,
    count(*) AS sample_count, window_end AS alerted_at
FROM {_tumbling('raw_logs', 1)} GROUP BY http_route, window_start, window_end
HAVING percentile_cont(0.99) WITHIN GROUP (ORDER BY response_time_ms) > 500
"""

MV_ROUTE_SUMMARY = """
SELECT http_route, count(*) AS total_requests,
    count(*) FILTER (WHERE status_code >= 200 AND status_code < 300) AS total_success,
    count(*) FILTER (WHERE status_code >= 400) AS total_errors,
    avg(response_time_ms) AS overall_avg_latency_ms, max(event_time) AS last_seen
FROM raw_logs GROUP BY http_route
"""

MV_HOSTNAME_TRAFFIC = f"""
SELECT hostname, window_start, window_end, count(*) AS request_count,
    count(DISTINCT http_route) AS unique_routes, avg(response_time_ms) AS avg_latency_ms
FROM {_tumbling('raw_logs', 5)} GROUP BY hostname, window_start, window_end
"""

MV_CLIENT_ACTIVITY = f"""
SELECT client_ip, window_start, window_end, count(*) AS request_count,
    count(DISTINCT http_route) AS routes_accessed, {ERRORS} AS error_count
FROM {_tumbling('raw_logs', 1)} GROUP BY client_ip, window_start, window_end HAVING count(*) > 10
"""

SESSIONS = """
sessions AS (
    SELECT client_ip, count(*) AS request_count, min(event_time) AS session_start,
        max(event_time) AS session_end,
        epoch_ms(max(event_time)) - epoch_ms(min(event_time)) AS session_duration_ms,
        CAST(count(DISTINCT coalesce(path, '<null>')) AS INTEGER) AS unique_path_count,
        CAST(count(DISTINCT coalesce(http_route, '<null>')) AS INTEGER) AS unique_route_count,
        avg(response_time_ms) AS avg_response_time_ms,
        CAST(sum(bytes_sent) AS BIGINT) AS total_bytes_sent,
        count(*) FILTER (WHERE status_code >= 400) AS error_count,
        count(*) FILTER (WHERE status_code >= 400) / count(*) * 100 AS error_rate
    FROM (
        SELECT *, sum(opens) OVER (PARTITION BY client_ip ORDER BY event_time, event_id) AS session_no
        FROM (
            SELECT *, CASE WHEN event_time - lag(event_time) OVER (
                PARTITION BY client_ip ORDER BY event_time, event_id) <= INTERVAL 20 SECOND
                THEN 0 ELSE 1 END AS opens
            FROM logs))
    GROUP BY client_ip, session_no
)
"""

MESSAGES = """
messages AS (
    SELECT 'access.logs.' || hostname AS subject, event_id + 1 AS seq,
        CAST(to_json({'timestamp': strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ'), 'http_route': http_route,
            'hostname': hostname, 'method': method, 'path': path, 'status_code': status_code,
            'response_time_ms': response_time_ms, 'bytes_sent': bytes_sent, 'bytes_received': bytes_received,
            'upstream_cluster': upstream_cluster, 'client_ip': client_ip}) AS VARCHAR) AS value
    FROM raw_logs
),
damaged AS (
    SELECT subject, seq, CASE (seq - 1) % 97
        WHEN 1 THEN '' WHEN 2 THEN 'not valid json' WHEN 3 THEN 'null' WHEN 4 THEN '[]'
        WHEN 5 THEN '{"unknown_field":"ignored",' || substr(value, 2)
        WHEN 6 THEN regexp_replace(value, '"status_code":([0-9]+)', '"status_code":"\\1"')
        WHEN 7 THEN regexp_replace(value, '"response_time_ms":[0-9]+,', '')
        WHEN 8 THEN '{''http_route'':''q''}'
        WHEN 9 THEN '{"http_route":["x"],"status_code":200}'
        WHEN 10 THEN '{"http_route":"x","path":{"a":1}}'
        WHEN 11 THEN '{"timestamp":"2024-01-01T00:00:00.000Z","http_route":"[x]","path":"{}"}'
        ELSE value END AS value
    FROM messages
)
"""


_TEXTS = "timestamp http_route hostname method path upstream_cluster client_ip".split()
# An object with no object or array where text is expected.
READABLE = f"""CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' AND {
    ' AND '.join(f"coalesce(json_type(value, '$.{name}') NOT IN ('OBJECT', 'ARRAY'), true)" for name in _TEXTS)
} ELSE false END"""


def _decoded(source: str) -> str:
    def text(name: str) -> str:
        return f"json_extract_string(j, '$.{name}')"

    def number(name: str, kind: str = "BIGINT") -> str:
        return f"coalesce(CAST({text(name)} AS {kind}), 0) AS {name}"

    return f"""
    SELECT subject, seq, strptime({text('timestamp')}, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_time,
        coalesce(nullif({text('http_route')}, ''), 'unknown') AS http_route,
        {text('hostname')} AS hostname, {text('method')} AS method, {text('path')} AS path,
        {number('status_code', 'INTEGER')}, {number('response_time_ms')}, {number('bytes_sent')},
        {number('bytes_received')}, {text('upstream_cluster')} AS upstream_cluster,
        {text('client_ip')} AS client_ip
    FROM (SELECT *, CASE WHEN {READABLE} THEN CAST(value AS JSON) END AS j FROM {source})
    WHERE j IS NOT NULL
    """


# Columns of type DOUBLE; they are rounded in the final SELECT only.
METRIC_DOUBLES = "avg_latency_ms p50_latency_ms p95_latency_ms p99_latency_ms error_rate_pct"
ALERT_DOUBLES = "p99_latency_ms p95_latency_ms avg_latency_ms error_rate_pct"
SESSION_DOUBLES = "avg_response_time_ms error_rate"
VIEW_DOUBLES = {
    "mv_route_metrics_1m": "avg_latency_ms error_rate_pct",
    "mv_route_metrics_1m_pct": "avg_latency_ms p50_latency_ms p95_latency_ms p99_latency_ms",
    "mv_route_metrics_5m": f"{METRIC_DOUBLES} p90_latency_ms requests_per_second",
    "mv_latency_alerts": "p99_latency_ms",
    "mv_route_summary": "overall_avg_latency_ms",
    "mv_hostname_traffic": "avg_latency_ms",
}


def _with(*parts: str, select: str, doubles: str = "") -> str:
    columns = "*"
    if doubles:
        columns = f"* REPLACE ({', '.join(f'round({d}, 6) AS {d}' for d in doubles.split())})"
    return f"WITH {', '.join((LOGS, *parts))}, result AS ({select}) SELECT {columns} FROM result"


AS_OF = "TIMESTAMP '2024-01-01 01:30:00'"


def _within_bound(windows: str) -> str:
    bounds = ", ".join(f"max(response_time_ms) IS NOT NULL OR NULL AS p{p}_within_bound" for p in (50, 95, 99))
    return f"SELECT {COUNTS}, {TOTALS}, {bounds} FROM {windows} {BY_WINDOW}"


def oracle_queries() -> dict[str, str]:
    decoded = f"decoded AS ({_decoded('messages')})"
    views = {
        "mv_route_metrics_1m": MV_METRICS_1M,
        "mv_route_metrics_1m_pct": MV_METRICS_1M_PCT,
        "mv_route_metrics_5m": MV_METRICS_5M,
        "mv_error_events": MV_ERROR_EVENTS,
        "mv_latency_alerts": MV_LATENCY_ALERTS,
        "mv_route_summary": MV_ROUTE_SUMMARY,
        "mv_hostname_traffic": MV_HOSTNAME_TRAFFIC,
        "mv_client_activity": MV_CLIENT_ACTIVITY,
    }
    found = {name: _with(select=sql, doubles=VIEW_DOUBLES.get(name, "")) for name, sql in views.items()}
    found |= {
        "route_metrics_1m": _with(METRICS_1M, select="SELECT * FROM m1", doubles=METRIC_DOUBLES),
        "route_metrics_5m": _with(METRICS_5M, select="SELECT * FROM m5", doubles=METRIC_DOUBLES),
        "error_events": _with(select=ERROR_EVENTS),
        "latency_alerts": _with(METRICS_1M, ALERTS, select="SELECT * FROM alerts", doubles=ALERT_DOUBLES),
        "alert_exceedance": _with(
            METRICS_1M,
            ALERTS,
            select="""SELECT http_route, window_start, p99_latency_ms, threshold_ms,
                CASE WHEN threshold_ms = 0 THEN 0 ELSE p99_latency_ms / threshold_ms END
                    AS exceedance_multiple FROM alerts""", doubles="p99_latency_ms exceedance_multiple"),
        "route_throughput": _with(
            METRICS_1M,
            select="""SELECT http_route, window_start, window_end, CAST(60 AS BIGINT) AS window_seconds,
                request_count / 60 AS requests_per_second,
                total_bytes_sent / 60 AS bytes_sent_per_second,
                total_bytes_received / 60 AS bytes_received_per_second FROM m1""", doubles="requests_per_second bytes_sent_per_second bytes_received_per_second"),
        "status_category": _with(
            select="""SELECT http_route, (status_code // 100) || 'xx' AS status_category,
                count(*) AS request_count FROM logs GROUP BY ALL""",
        ),
        "session_metrics": _with(SESSIONS, select="SELECT * FROM sessions", doubles=SESSION_DOUBLES),
        "error_trend_hourly": _with(
            METRICS_1M,
            select="""SELECT date_trunc('hour', window_end) AS hour, http_route,
                CAST(sum(client_error_count + server_error_count) AS BIGINT) AS total_errors
                FROM m1 GROUP BY 1, 2""",
        ),
        "route_rate_last_hour": _with(
            METRICS_1M,
            select="""SELECT http_route, CAST(sum(request_count) AS BIGINT) AS total_requests,
                avg(avg_latency_ms) AS avg_latency, max(p99_latency_ms) AS max_p99 FROM m1
                WHERE window_end > TIMESTAMP '2024-01-01 01:30:00' - INTERVAL 1 HOUR GROUP BY http_route""", doubles="avg_latency max_p99"),
        "recent_alerts": _with(
            select=f"""SELECT * FROM ({MV_LATENCY_ALERTS})
                WHERE alerted_at > TIMESTAMP '2024-01-01 01:30:00' - INTERVAL 1 HOUR""", doubles="p99_latency_ms"),
        "error_rate_trend": _with(
            METRICS_5M,
            select="SELECT http_route, window_end, error_rate_pct FROM m5 WHERE error_rate_pct > 5", doubles="error_rate_pct"),
        "latest_metrics": _with(
            select=f"""SELECT * FROM ({MV_METRICS_1M})
                ORDER BY window_end DESC, http_route ASC NULLS FIRST LIMIT 20""", doubles="avg_latency_ms error_rate_pct"),
        "latest_errors": _with(
            select=f"""SELECT * FROM ({MV_ERROR_EVENTS}) ORDER BY timestamp DESC,
                http_route NULLS FIRST, hostname, method, path NULLS FIRST, status_code,
                response_time_ms, client_ip, upstream_cluster NULLS FIRST, error_type LIMIT 20""",
        ),
        "ingest_clean": _with(MESSAGES, select=_decoded("damaged")),
        "ingest_rejects": _with(
            MESSAGES,
            select=f"SELECT * FROM damaged WHERE NOT coalesce({READABLE}, false)",
        ),
        "replay_all": _with(MESSAGES, select=_decoded("messages")),
        "replay_last": _with(
            MESSAGES, decoded, select="SELECT * FROM decoded WHERE seq = (SELECT max(seq) FROM decoded)"
        ),
        "replay_last_per_subject": _with(
            MESSAGES,
            decoded,
            select="""SELECT * FROM decoded
                QUALIFY row_number() OVER (PARTITION BY subject ORDER BY seq DESC) = 1""",
        ),
        "replay_new": _with(MESSAGES, decoded, select="SELECT * FROM decoded WHERE seq > 900"),
        "replay_from_sequence": _with(MESSAGES, decoded, select="SELECT * FROM decoded WHERE seq > 250"),
        "replay_from_time": _with(
            MESSAGES,
            decoded,
            select="SELECT * FROM decoded WHERE event_time >= TIMESTAMP '2024-01-01 00:20:00'",
        ),
        "upsert_route_metrics": _with(METRICS_1M, select="SELECT * FROM m1", doubles=METRIC_DOUBLES),
        "folded_route_metrics_1m": _with(
            METRICS_1M,
            select="""SELECT * FROM m1 UNION ALL SELECT * REPLACE (http_route || ' (late)' AS http_route) FROM m1
                WHERE minute(window_start) % 3 = 1""",
            doubles=METRIC_DOUBLES,
        ),
        "table_route_rate_last_hour": _with(
            METRICS_1M,
            select=f"""SELECT http_route, CAST(sum(request_count) AS BIGINT) AS total_requests,
                avg(avg_latency_ms) AS avg_latency, max(p99_latency_ms) AS max_p99 FROM m1
                WHERE window_end > {AS_OF} - INTERVAL 1 HOUR GROUP BY http_route""",
            doubles="avg_latency max_p99",
        ),
        "table_recent_alerts": _with(
            METRICS_1M, ALERTS, select=f"SELECT * FROM alerts WHERE window_end > {AS_OF} - INTERVAL 1 HOUR", doubles=ALERT_DOUBLES),
        "table_error_trend_hourly": _with(
            METRICS_1M,
            select=f"""SELECT date_trunc('hour', window_end) AS hour, http_route,
                CAST(sum(client_error_count + server_error_count) AS BIGINT) AS total_errors
                FROM m1 WHERE window_end <= {AS_OF} GROUP BY 1, 2""",
        ),
        "table_error_rate_trend": _with(
            METRICS_5M,
            select=f"""SELECT http_route, window_end, error_rate_pct FROM m5
                WHERE error_rate_pct > 5 AND window_end > {AS_OF} - INTERVAL 45 MINUTE""",
            doubles="error_rate_pct",
        ),
        "table_latest_metrics": _with(
            METRICS_1M,
            select="SELECT * FROM m1 ORDER BY window_end DESC, http_route ASC NULLS FIRST LIMIT 20",
            doubles=METRIC_DOUBLES,
        ),
        "table_latest_errors": _with(
            select=f"""SELECT * FROM ({ERROR_EVENTS}) ORDER BY event_time DESC, http_route NULLS FIRST, hostname NULLS FIRST,
                method NULLS FIRST, path NULLS FIRST, status_code, error_category, response_time_ms NULLS FIRST,
                upstream_cluster NULLS FIRST, client_ip NULLS FIRST LIMIT 20""",
        ),
        "sketch_route_metrics_5m": _with(select=_within_bound(_rolling("logs")), doubles="avg_latency_ms error_rate_pct"),
        "sketch_route_metrics_1h": _with(
            select=_within_bound(_tumbling("logs", 60)), doubles="avg_latency_ms error_rate_pct"),
        "stream_route_metrics_1m": _with(
            METRICS_1M, select=f"SELECT * FROM m1 WHERE window_end <= {CLOSED}", doubles=METRIC_DOUBLES),
        "stream_landed_route_metrics_1m": _with(
            METRICS_1M, select=f"SELECT * FROM m1 WHERE window_end <= {CLOSED}", doubles=METRIC_DOUBLES),
        "stream_route_metrics_5m": _with(
            METRICS_5M, select=f"SELECT * FROM m5 WHERE window_end <= {CLOSED}", doubles=METRIC_DOUBLES),
        "stream_error_events": _with(select=ERROR_EVENTS),
        "stream_latency_alerts": _with(
            METRICS_1M, ALERTS, select=f"SELECT * FROM alerts WHERE window_end <= {CLOSED}", doubles=ALERT_DOUBLES),
        "stream_session_metrics": _with(
            SESSIONS, select=f"SELECT * FROM sessions WHERE session_end + INTERVAL 20 SECOND <= {CLOSED}", doubles=SESSION_DOUBLES),
        "stream_hostname_traffic": found["mv_hostname_traffic"],
        "stream_client_activity": found["mv_client_activity"],
        "stream_route_summary": found["mv_route_summary"],
        "stream_mv_route_metrics_1m": found["mv_route_metrics_1m"],
        "stream_mv_route_metrics_1m_pct": found["mv_route_metrics_1m_pct"],
        "stream_mv_route_metrics_5m": found["mv_route_metrics_5m"],
        "stream_mv_error_events": found["mv_error_events"],
        "stream_mv_latency_alerts": found["mv_latency_alerts"],
        "sql_route_metrics_1m_view": found["mv_route_metrics_1m"],
    }
    return found
