"""Fixed schemas of the input and of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "BINARY": T.BinaryType(),
    # Sums of bytes before their last cast.
    "WIDE": T.DecimalType(38, 0),
}


def struct(columns: str) -> T.StructType:
    """Schema from ``name TYPE, …``; unlike a DDL string it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The input record as it arrives in JSON.
MESSAGE_FIELDS = (
    "timestamp",
    "http_route",
    "hostname",
    "method",
    "path",
    "status_code",
    "response_time_ms",
    "bytes_sent",
    "bytes_received",
    "upstream_cluster",
    "client_ip",
)

# The decoded record every operator takes.
ACCESS_LOG = struct(
    "event_time TIMESTAMP, http_route STRING, hostname STRING, method STRING, path STRING, "
    "status_code INT, response_time_ms BIGINT, bytes_sent BIGINT, bytes_received BIGINT, "
    "upstream_cluster STRING, client_ip STRING"
)

ROUTE_METRICS = struct(
    "http_route STRING, window_start TIMESTAMP, window_end TIMESTAMP, request_count BIGINT, "
    "success_count BIGINT, client_error_count BIGINT, server_error_count BIGINT, "
    "total_bytes_sent BIGINT, total_bytes_received BIGINT, min_latency_ms BIGINT, "
    "max_latency_ms BIGINT, avg_latency_ms DOUBLE, p50_latency_ms DOUBLE, p95_latency_ms DOUBLE, "
    "p99_latency_ms DOUBLE, error_rate_pct DOUBLE, processing_time TIMESTAMP"
)

ROUTE_SKETCHES = struct(
    "http_route STRING, window_start TIMESTAMP, window_end TIMESTAMP, request_count BIGINT, "
    "success_count BIGINT, client_error_count BIGINT, server_error_count BIGINT, "
    "total_bytes_sent WIDE, total_bytes_received WIDE, min_latency_ms BIGINT, max_latency_ms BIGINT, "
    "latency_total DOUBLE, timed BIGINT, latency_sketch BINARY"
)

ERROR_EVENTS = struct(
    "event_time TIMESTAMP, http_route STRING, hostname STRING, method STRING, path STRING, "
    "status_code INT, error_category STRING, response_time_ms BIGINT, upstream_cluster STRING, "
    "client_ip STRING, processing_time TIMESTAMP"
)

LATENCY_ALERTS = struct(
    "alert_time TIMESTAMP, http_route STRING, window_start TIMESTAMP, window_end TIMESTAMP, "
    "p99_latency_ms DOUBLE, p95_latency_ms DOUBLE, avg_latency_ms DOUBLE, threshold_ms BIGINT, "
    "request_count BIGINT, error_rate_pct DOUBLE, severity STRING"
)

SESSION_METRICS = struct(
    "client_ip STRING, request_count BIGINT, session_start TIMESTAMP, session_end TIMESTAMP, "
    "session_duration_ms BIGINT, unique_path_count INT, unique_route_count INT, "
    "avg_response_time_ms DOUBLE, total_bytes_sent BIGINT, error_count BIGINT, error_rate DOUBLE"
)
