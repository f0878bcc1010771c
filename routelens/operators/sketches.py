"""Route metrics of any longer window from minute rows alone.

A minute row holds counters and a KLL sketch of the minute's latencies. Sketches merge, so the rows of a table
of minutes give the metrics of five minutes, an hour or a day without the requests. A sketch has a bounded
size (about 3 KB at the default, whatever the traffic), is built inside each task before the shuffle, and is the
whole state of a group in a stream. Percentiles are values that occur; their rank is off by about 0.7 % of the requests
at the default size (99 % of sketches). Counters, extremes and averages are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelens.functions.status import is_client_error, is_server_error, is_success, rate_pct, wide_sum
from routelens.operators.metrics import LATENCY, ONE_MINUTE, PERCENTILES, latency_cells

SKETCH_SIZE = 400
COUNTERS = ("request_count", "success_count", "client_error_count", "server_error_count")
BYTES = ("total_bytes_sent", "total_bytes_received")


def minute_sketches(logs: DataFrame, key: str = "http_route", size: int = SKETCH_SIZE) -> DataFrame:
    """One row per key and minute: counters and the sketch of its latencies (of none where no latency is known)."""
    status = F.col("status_code")
    return (
        logs.groupBy(key, F.window("event_time", *ONE_MINUTE).alias("window"))
        .agg(
            F.count("*").alias("request_count"),
            F.count_if(is_success(status)).alias("success_count"),
            F.count_if(is_client_error(status)).alias("client_error_count"),
            F.count_if(is_server_error(status)).alias("server_error_count"),
            wide_sum("bytes_sent").alias("total_bytes_sent"),
            wide_sum("bytes_received").alias("total_bytes_received"),
            F.min(LATENCY).alias("min_latency_ms"),
            F.max(LATENCY).alias("max_latency_ms"),
            F.sum(F.col(LATENCY).cast("double")).alias("latency_total"),
            F.count(LATENCY).alias("timed"),
            F.kll_sketch_agg_bigint(LATENCY, F.lit(size)).alias("latency_sketch"),
        )
        .select(
            key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            *COUNTERS, *BYTES, "min_latency_ms", "max_latency_ms", "latency_total", "timed", "latency_sketch",
        )
    )


def _quantile(level: float) -> Column:
    """NULL for a sketch of no values, which has no quantiles."""
    found = F.kll_sketch_get_quantile_bigint("latency_sketch", F.lit(level))
    return F.when(F.col("timed") > 0, found.cast("double"))


def metrics_from_sketches(
    minutes: DataFrame, span: Sequence[str], key: str = "http_route", size: int = SKETCH_SIZE
) -> DataFrame:
    """The columns of ``route_metrics`` for windows of whole minutes. ``span`` is a length, or a length and a slide.

    ``minutes`` may hold several rows for one key and minute, as parts of a table do; they add up.
    """
    totals = minutes.groupBy(key, F.window("window_start", *span).alias("window")).agg(
        *[F.sum(c).alias(c) for c in COUNTERS],
        *[wide_sum(c).try_cast("bigint").alias(c) for c in BYTES],
        F.min("min_latency_ms").alias("min_latency_ms"),
        F.max("max_latency_ms").alias("max_latency_ms"),
        F.sum("latency_total").alias("latency_total"),
        F.sum("timed").alias("timed"),
        F.kll_merge_agg_bigint("latency_sketch", F.lit(size)).alias("latency_sketch"),
    )
    errors = F.col("client_error_count") + F.col("server_error_count")
    return totals.select(
        key,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *COUNTERS,
        *BYTES,
        "min_latency_ms",
        "max_latency_ms",
        F.when(F.col("timed") > 0, F.col("latency_total") / F.col("timed")).alias("avg_latency_ms"),
        *[_quantile(level).alias(f"p{round(level * 100)}_latency_ms") for level in PERCENTILES],
        rate_pct(errors, F.col("request_count")).alias("error_rate_pct"),
    )


def rank_errors(
    estimates: DataFrame, logs: DataFrame, span: Sequence[str], key: str = "http_route"
) -> DataFrame:
    """``estimates`` with how far the rank of each percentile is from the one asked for, as a share of the window's requests.

    A value that occurs often covers a range of ranks; the error is 0 when the rank asked for lies in it. NULL without a percentile.
    """
    cells = latency_cells(logs, key, span).where(F.col(LATENCY).isNotNull()).select(
        F.col(key).alias("c_key"), F.col("window.start").alias("c_start"), LATENCY, "requests"
    )
    same = F.col(key).eqNullSafe(F.col("c_key")) & (F.col("window_start") == F.col("c_start"))
    joined = estimates.join(cells, same, "left")
    errors = []
    for level in PERCENTILES:
        name = f"p{round(level * 100)}"
        estimate = F.col(f"{name}_latency_ms")
        share = F.sum("requests")
        below = F.sum(F.when(F.col(LATENCY) < estimate, F.col("requests")).otherwise(0)) / share
        up_to = F.sum(F.when(F.col(LATENCY) <= estimate, F.col("requests")).otherwise(0)) / share
        miss = F.greatest(below - F.lit(level), F.lit(level) - up_to, F.lit(0.0))
        errors.append(F.when(F.first(estimate).isNotNull(), miss).alias(f"{name}_rank_error"))
    return joined.groupBy(*estimates.columns).agg(*errors)
