"""Latency alerts: windows whose p99 is above a threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.functions.severity import exceedance_multiple, severity
from routelens.operators.metrics import ONE_MINUTE, windowed_summary

# Fixed value: default threshold of the job and of the SQL view.
DEFAULT_THRESHOLD_MS = 500


def latency_alerts(metrics: DataFrame, threshold_ms: int = DEFAULT_THRESHOLD_MS) -> DataFrame:
    """Alerts from metric rows; a p99 equal to the threshold raises none."""
    threshold = F.lit(threshold_ms).cast("long")
    above = (F.col("request_count") != 0) & (F.col("p99_latency_ms") > threshold)
    return metrics.where(above).select(
        "http_route",
        "window_start",
        "window_end",
        "p99_latency_ms",
        "p95_latency_ms",
        "avg_latency_ms",
        threshold.alias("threshold_ms"),
        "request_count",
        "error_rate_pct",
        severity(F.col("p99_latency_ms"), threshold).alias("severity"),
    )


def alert_exceedance(alerts: DataFrame) -> DataFrame:
    """How many times each alert's p99 exceeds its threshold."""
    return alerts.select(
        "http_route",
        "window_start",
        "p99_latency_ms",
        "threshold_ms",
        exceedance_multiple(F.col("p99_latency_ms"), F.col("threshold_ms")).alias("exceedance_multiple"),
    )


def sql_window_p99(logs: DataFrame, one_step: bool = False) -> DataFrame:
    """The SQL alert view before its HAVING filter."""
    return windowed_summary(logs, ONE_MINUTE, percentiles=(0.99,), one_step=one_step).select(
        "http_route",
        "window_start",
        "window_end",
        F.col("latency_pct")[0].alias("p99_latency_ms"),
        F.col("request_count").alias("sample_count"),
        F.col("window_end").alias("alerted_at"),
    )


def sql_latency_alerts(logs: DataFrame, threshold_ms: int = DEFAULT_THRESHOLD_MS) -> DataFrame:
    """The SQL alert view."""
    return sql_window_p99(logs).where(F.col("p99_latency_ms") > threshold_ms)
