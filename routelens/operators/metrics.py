"""Route metrics over event-time windows.

Exact percentiles need every distinct latency of a window, and a busy route can hold a
large share of all requests. The work is therefore done in two steps:

1. *Cells*: one row per key, window and distinct latency, with counters. Long sums only,
   so each task folds its own rows before the shuffle, and the latency in the shuffle key
   spreads one hot route over many tasks.
2. *Summary*: cells grouped by key and window. A group holds at most one row per distinct
   millisecond value, however many requests it stands for, and ``percentile`` takes the
   cell's count as a frequency, so the result equals the percentile of the single rows.

Sliding windows on batch input are built from one-slide panes: requests are folded once
into cells of one slide, and only the cells are copied into the windows that overlap them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelens.functions.instants import whole_seconds_between
from routelens.functions.status import (
    is_client_error,
    is_error,
    is_server_error,
    is_success,
    rate_pct,
    status_category,
    wide_sum,
)

LATENCY = "response_time_ms"
ONE_MINUTE = ("1 minute",)
FIVE_MINUTES_ROLLING = ("5 minutes", "1 minute")
FIVE_MINUTES_SECONDS = 300
PERCENTILES = (0.5, 0.95, 0.99)


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def single_request_cells(logs: DataFrame, key: str, span: Sequence[str]) -> DataFrame:
    """Every request as a cell of its own, once per window it belongs to."""
    status = F.col("status_code")
    return logs.select(
        key,
        F.window("event_time", *span).alias("window"),
        LATENCY,
        F.lit(1).cast("long").alias("requests"),
        _flag(is_success(status)).alias("successes"),
        _flag(is_client_error(status)).alias("client_errors"),
        _flag(is_server_error(status)).alias("server_errors"),
        "bytes_sent",
        "bytes_received",
    )


def latency_cells(logs: DataFrame, key: str, span: Sequence[str]) -> DataFrame:
    """One cell per key, window and distinct latency.

    A late row may still belong to an open sliding window after its pane has closed, so a
    stream keeps cells per window and only batch input goes through panes.
    """
    if len(span) == 1 or logs.isStreaming:
        return _fold(single_request_cells(logs, key, span), key)
    slide = span[1]
    panes = _fold(single_request_cells(logs, key, (slide,)), key)
    return panes.withColumn("window", F.window(F.col("window.start"), *span))


def _fold(cells: DataFrame, key: str) -> DataFrame:
    counters = ("requests", "successes", "client_errors", "server_errors")
    return cells.groupBy(key, "window", LATENCY).agg(
        *[F.sum(c).alias(c) for c in counters],
        *[wide_sum(c).alias(c) for c in ("bytes_sent", "bytes_received")],
    )


def window_cells(logs: DataFrame, span: Sequence[str], key: str = "http_route") -> DataFrame:
    """Cells with their window's bounds as columns, for tables that are summarised when they are read."""
    return latency_cells(logs, key, span).select(
        key,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        LATENCY,
        "requests",
        "successes",
        "client_errors",
        "server_errors",
    )


def summarise_cells(
    cells: DataFrame, key: str, percentiles: Sequence[float] = PERCENTILES, approx: bool = False
) -> DataFrame:
    """All window measures of each key; percentiles come as ``latency_pct[i]``.

    ``approx`` swaps the exact percentile for a sketch of fixed size and needs
    single-request cells.
    """
    levels = F.array(*[F.lit(p) for p in percentiles])
    if approx:
        pct = F.percentile_approx(LATENCY, levels).cast("array<double>")
    else:
        pct = F.percentile(LATENCY, levels, F.col("requests"))
    timed = F.sum(F.when(F.col(LATENCY).isNotNull(), F.col("requests")))
    errors = F.sum(F.col("client_errors") + F.col("server_errors"))
    return (
        cells.groupBy(key, "window")
        .agg(
            F.sum("requests").alias("request_count"),
            F.sum("successes").alias("success_count"),
            F.sum("client_errors").alias("client_error_count"),
            F.sum("server_errors").alias("server_error_count"),
            wide_sum("bytes_sent").try_cast("bigint").alias("total_bytes_sent"),
            wide_sum("bytes_received").try_cast("bigint").alias("total_bytes_received"),
            F.min(LATENCY).alias("min_latency_ms"),
            F.max(LATENCY).alias("max_latency_ms"),
            (F.sum(F.col(LATENCY).cast("double") * F.col("requests")) / timed).alias("avg_latency_ms"),
            pct.alias("latency_pct"),
            rate_pct(errors, F.sum("requests")).alias("error_rate_pct"),
        )
        .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
    )


def windowed_summary(
    logs: DataFrame,
    span: Sequence[str],
    percentiles: Sequence[float] = PERCENTILES,
    key: str = "http_route",
    approx: bool = False,
    one_step: bool = False,
) -> DataFrame:
    """Cells and summary of ``logs``.

    ``one_step`` skips the cells. A streaming query in update or complete mode needs it,
    because Spark allows only one stateful aggregation there.
    """
    if approx or one_step:
        cells = single_request_cells(logs, key, span)
    else:
        cells = latency_cells(logs, key, span)
    return summarise_cells(cells, key, percentiles, approx)


def route_metrics(
    logs: DataFrame, span: Sequence[str], approx: bool = False, one_step: bool = False
) -> DataFrame:
    """The 16 deterministic columns of the metric tables."""
    pct = F.col("latency_pct")
    return windowed_summary(logs, span, approx=approx, one_step=one_step).select(
        "http_route",
        "window_start",
        "window_end",
        "request_count",
        "success_count",
        "client_error_count",
        "server_error_count",
        "total_bytes_sent",
        "total_bytes_received",
        "min_latency_ms",
        "max_latency_ms",
        "avg_latency_ms",
        pct[0].alias("p50_latency_ms"),
        pct[1].alias("p95_latency_ms"),
        pct[2].alias("p99_latency_ms"),
        "error_rate_pct",
    )


def route_metrics_1m(logs: DataFrame, approx: bool = False, one_step: bool = False) -> DataFrame:
    """Metrics per route and tumbling minute."""
    return route_metrics(logs, ONE_MINUTE, approx, one_step)


def route_metrics_5m(logs: DataFrame, approx: bool = False, one_step: bool = False) -> DataFrame:
    """Metrics per route over five minutes, every minute."""
    return route_metrics(logs, FIVE_MINUTES_ROLLING, approx, one_step)


def _plain_counts(logs: DataFrame, key: str, span: Sequence[str]) -> DataFrame:
    """Window measures that need no percentile: one hash aggregation with long buffers."""
    status = F.col("status_code")
    return (
        logs.groupBy(key, F.window("event_time", *span).alias("window"))
        .agg(
            F.count("*").alias("request_count"),
            F.count_if(is_success(status)).alias("success_count"),
            F.count_if(is_client_error(status)).alias("client_error_count"),
            F.count_if(is_server_error(status)).alias("server_error_count"),
            F.avg(LATENCY).alias("avg_latency_ms"),
            F.min(LATENCY).alias("min_latency_ms"),
            F.max(LATENCY).alias("max_latency_ms"),
            wide_sum("bytes_sent").try_cast("bigint").alias("total_bytes_sent"),
            wide_sum("bytes_received").try_cast("bigint").alias("total_bytes_received"),
            F.count_if(is_error(status)).alias("error_count"),
        )
        .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
    )


def sql_route_metrics_1m(logs: DataFrame) -> DataFrame:
    """The SQL view of one minute: 13 columns, no percentiles, NULL route kept."""
    error_rate = F.col("error_count").cast("double") / F.nullif("request_count", F.lit(0)) * 100
    return _plain_counts(logs, "http_route", ONE_MINUTE).select(
        "http_route",
        "window_start",
        "window_end",
        "request_count",
        "success_count",
        "client_error_count",
        "server_error_count",
        "avg_latency_ms",
        "min_latency_ms",
        "max_latency_ms",
        "total_bytes_sent",
        "total_bytes_received",
        error_rate.alias("error_rate_pct"),
    )


def sql_route_metrics_1m_pct(logs: DataFrame, one_step: bool = False) -> DataFrame:
    """The SQL view of one minute with percentiles: 11 columns."""
    pct = F.col("latency_pct")
    return windowed_summary(logs, ONE_MINUTE, one_step=one_step).select(
        "http_route",
        "window_start",
        "window_end",
        "request_count",
        "success_count",
        "client_error_count",
        "server_error_count",
        "avg_latency_ms",
        pct[0].alias("p50_latency_ms"),
        pct[1].alias("p95_latency_ms"),
        pct[2].alias("p99_latency_ms"),
    )


def sql_route_metrics_5m(logs: DataFrame, one_step: bool = False) -> DataFrame:
    """The SQL view of five minutes: adds p90 and requests per second."""
    pct = F.col("latency_pct")
    summary = windowed_summary(
        logs, FIVE_MINUTES_ROLLING, percentiles=(0.5, 0.9, 0.95, 0.99), one_step=one_step
    )
    return summary.select(
        "http_route",
        "window_start",
        "window_end",
        "request_count",
        "avg_latency_ms",
        pct[0].alias("p50_latency_ms"),
        pct[1].alias("p90_latency_ms"),
        pct[2].alias("p95_latency_ms"),
        pct[3].alias("p99_latency_ms"),
        "error_rate_pct",
        (F.col("request_count") / FIVE_MINUTES_SECONDS).alias("requests_per_second"),
    )


def route_throughput(metrics: DataFrame) -> DataFrame:
    """Requests and bytes per second of each metric row, 0.0 for an empty duration."""
    seconds = whole_seconds_between(F.col("window_start"), F.col("window_end"))

    def per_second(name: str) -> Column:
        return F.when(F.col("window_seconds") == 0, F.lit(0.0)).otherwise(F.col(name) / F.col("window_seconds"))

    return metrics.withColumn("window_seconds", seconds).select(
        "http_route",
        "window_start",
        "window_end",
        "window_seconds",
        per_second("request_count").alias("requests_per_second"),
        per_second("total_bytes_sent").alias("bytes_sent_per_second"),
        per_second("total_bytes_received").alias("bytes_received_per_second"),
    )


def status_categories(logs: DataFrame) -> DataFrame:
    """Requests per route and status category."""
    category = status_category(F.col("status_code")).alias("status_category")
    return logs.groupBy("http_route", category).agg(F.count("*").alias("request_count"))
