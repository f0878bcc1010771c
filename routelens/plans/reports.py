"""Reports over the metric, error and alert tables. All are batch queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_hour_before(as_of: Column | None) -> Column:
    moment = F.current_timestamp() if as_of is None else as_of
    return moment - F.expr("INTERVAL 1 HOUR")


def route_rate_last_hour(metrics_1m: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Requests, mean of the minute means, and highest p99 per route."""
    return (
        metrics_1m.where(F.col("window_end") > _one_hour_before(as_of))
        .groupBy("http_route")
        .agg(
            F.sum("request_count").alias("total_requests"),
            F.avg("avg_latency_ms").alias("avg_latency"),
            F.max("p99_latency_ms").alias("max_p99"),
        )
        .orderBy(F.desc("total_requests"), "http_route")
    )


def error_rate_trend(metrics_5m: DataFrame, above_pct: float = 5.0) -> DataFrame:
    """Windows with an error rate above ``above_pct``, newest first."""
    return (
        metrics_5m.where(F.col("error_rate_pct") > above_pct)
        .select("http_route", "window_end", "error_rate_pct")
        .orderBy(F.desc("window_end"), "http_route")
    )


def error_trend_hourly(metrics_1m: DataFrame) -> DataFrame:
    """Errors per hour and route."""
    return (
        metrics_1m.groupBy(F.date_trunc("hour", "window_end").alias("hour"), "http_route")
        .agg(F.sum(F.col("client_error_count") + F.col("server_error_count")).alias("total_errors"))
        .orderBy(F.desc("hour"), F.desc("total_errors"), "http_route")
    )


def latest_metrics(metrics: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest metric rows; ties are settled by route."""
    return metrics.orderBy(F.desc("window_end"), "http_route").limit(n)


def latest_errors(errors: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest errors; ties are settled by the other columns."""
    rest = [c for c in errors.columns if c != "timestamp"]
    return errors.orderBy(F.desc("timestamp"), *rest).limit(n)


def recent_alerts(alerts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Alerts raised within the last hour."""
    return alerts.where(F.col("alerted_at") > _one_hour_before(as_of))
