"""Running route totals, host traffic and client activity.

On batch input ``count_distinct`` shuffles by key *and* value first, so no task holds the
values of a hot key. Streams reject it; there the distinct values live in the state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelens.functions.status import is_error, is_success

# Fixed value: a client counts as active above this many requests a minute.
ACTIVE_CLIENT_REQUESTS = 10


def distinct_values(frame: DataFrame, column: str) -> Column:
    """Number of distinct non-null values."""
    if frame.isStreaming:
        return F.size(F.collect_set(column)).cast("long")
    return F.count_distinct(column)


def route_summary(logs: DataFrame) -> DataFrame:
    """Totals per route since the beginning."""
    status = F.col("status_code")
    return logs.groupBy("http_route").agg(
        F.count("*").alias("total_requests"),
        F.count_if(is_success(status)).alias("total_success"),
        F.count_if(is_error(status)).alias("total_errors"),
        F.avg("response_time_ms").alias("overall_avg_latency_ms"),
        F.max("event_time").alias("last_seen"),
    )


def route_cells(logs: DataFrame, key: str, span: str) -> DataFrame:
    """One row per key, window and route, for tables that are summarised when they are read."""
    return (
        logs.groupBy(key, F.window("event_time", span).alias("window"), "http_route")
        .agg(
            F.count("*").alias("requests"),
            F.count_if(is_error(F.col("status_code"))).alias("errors"),
            F.count("response_time_ms").alias("timed"),
            F.sum(F.col("response_time_ms").cast("double")).alias("latency_total"),
        )
        .select(
            key,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "http_route",
            "requests",
            "errors",
            "timed",
            "latency_total",
        )
    )


def hostname_traffic(logs: DataFrame) -> DataFrame:
    """Requests, distinct routes and mean latency per host and five minutes."""
    return (
        logs.groupBy("hostname", F.window("event_time", "5 minutes").alias("window"))
        .agg(
            F.count("*").alias("request_count"),
            distinct_values(logs, "http_route").alias("unique_routes"),
            F.avg("response_time_ms").alias("avg_latency_ms"),
        )
        .select(
            "hostname",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "request_count",
            "unique_routes",
            "avg_latency_ms",
        )
    )


def client_minutes(logs: DataFrame) -> DataFrame:
    """Every client and minute, before the HAVING filter of the view."""
    return (
        logs.groupBy("client_ip", F.window("event_time", "1 minute").alias("window"))
        .agg(
            F.count("*").alias("request_count"),
            distinct_values(logs, "http_route").alias("routes_accessed"),
            F.count_if(is_error(F.col("status_code"))).alias("error_count"),
        )
        .select(
            "client_ip",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "request_count",
            "routes_accessed",
            "error_count",
        )
    )


def client_activity(logs: DataFrame, min_requests: int = ACTIVE_CLIENT_REQUESTS) -> DataFrame:
    """Clients with more than ``min_requests`` requests in a minute."""
    return client_minutes(logs).where(F.col("request_count") > min_requests)
