"""Error events: a stateless filter and projection, so a stream keeps late rows too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.functions.status import error_category, error_type, is_error


def error_events(logs: DataFrame) -> DataFrame:
    """Requests that failed, with their category."""
    status = F.col("status_code")
    return logs.where(is_error(status)).select(
        "event_time",
        "http_route",
        "hostname",
        "method",
        "path",
        "status_code",
        error_category(status).alias("error_category"),
        "response_time_ms",
        "upstream_cluster",
        "client_ip",
    )


def sql_error_events(logs: DataFrame) -> DataFrame:
    """The SQL error view."""
    status = F.col("status_code")
    return logs.where(is_error(status)).select(
        F.col("event_time").alias("timestamp"),
        "http_route",
        "hostname",
        "method",
        "path",
        "status_code",
        "response_time_ms",
        "client_ip",
        "upstream_cluster",
        error_type(status).alias("error_type"),
    )
