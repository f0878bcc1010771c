"""Longer windows from minute sketches against the exact metrics of the requests."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from routelens.operators.metrics import FIVE_MINUTES_ROLLING, route_metrics
from routelens.operators.sketches import metrics_from_sketches, minute_sketches, rank_errors
from routelens.schemas import ACCESS_LOG
from routelens.streaming import job, tables
from tests.conftest import NOON, collect, log

PERCENTILES = ["p50_latency_ms", "p95_latency_ms", "p99_latency_ms"]


def rounded(row):
    return {k: round(v, 6) if isinstance(v, float) else v for k, v in row.items()}


@pytest.fixture(scope="module")
def busy(spark):
    """300,000 requests of two hours, nearly all of one route, with few and with many distinct latencies."""
    rows = spark.range(300_000).select(
        (F.lit(NOON).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 7200)).alias("event_time"),
        F.when(F.col("id") % 50 == 0, "few").otherwise("busy").alias("http_route"),
        F.when(F.col("id") % 10 == 1, 404).otherwise(200).alias("status_code"),
        F.when(F.col("id") % 50 == 0, F.col("id") % 3).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003))).alias("response_time_ms"),
        F.lit(10).cast("bigint").alias("bytes_sent"),
        F.lit(None).cast("bigint").alias("bytes_received"),
    )
    return rows.cache()


@pytest.mark.parametrize("span", [FIVE_MINUTES_ROLLING, ("1 hour",), ("1 day",)])
def test_counters_are_exact_and_ranks_within_the_bound(busy, span):
    found = metrics_from_sketches(minute_sketches(busy), span)
    exact = route_metrics(busy, span)
    measured = rank_errors(found, busy, span)
    worst = measured.agg(*[F.max(c).alias(c) for c in measured.columns if c.endswith("error")]).first()
    assert all(0 <= e <= 0.02 for e in worst), worst
    left, right = (
        {(r["http_route"], r["window_start"]): {k: v for k, v in r.items() if k not in PERCENTILES} for r in collect(f)} for f in (found, exact)
    )
    assert left.keys() == right.keys()
    for key, row in right.items():
        assert rounded(left[key]) == rounded(row)


def test_a_sketch_does_not_grow_with_traffic(busy):
    def longest(frame):
        return minute_sketches(frame).agg(F.max(F.length("latency_sketch"))).first()[0]

    hour = busy.withColumn("event_time", F.lit(NOON).cast("timestamp"))
    assert longest(hour) < 3 * longest(busy) and longest(hour) < 16_000


def test_small_windows_are_exact_and_nulls_have_no_percentile(logs_of):
    logs = logs_of(
        *[log(i, latency=v) for i, v in enumerate((5, 1, 9, 7, 3))], log(61, latency=100),
        log(0, "quiet", latency=None), log(0, None, latency=4, bytes_sent=2**62), log(1, None, latency=4, bytes_sent=2**62),
    )
    rows = {r["http_route"]: r for r in collect(metrics_from_sketches(minute_sketches(logs), ("5 minutes",)))}
    assert [rows["catalog"][c] for c in ("request_count", "min_latency_ms", "max_latency_ms", "p50_latency_ms", "p99_latency_ms")] == [6, 1, 100, 5, 100]
    assert [rows["quiet"][c] for c in (*PERCENTILES, "avg_latency_ms", "request_count")] == [None] * 4 + [1]
    assert rows[None]["total_bytes_sent"] is None and rows[None]["p50_latency_ms"] == 4
    assert metrics_from_sketches(minute_sketches(logs.limit(0)), ("1 hour",)).collect() == []


def test_streamed_minutes_give_an_hour(spark, tmp_path, database):
    table = tables.ROUTE_SKETCHES_1M
    tables.ensure_tables(spark, database, wanted=[table])
    folder = f"{tmp_path}/input"
    for run in range(2):
        rows = [log(run * 1200 + 20 * i, ("a", "b")[i % 2], (200, 503)[i % 2], i * 7 % 31) for i in range(60)]
        spark.createDataFrame([*rows, log(run * 1200 + 1260, "late")], ACCESS_LOG).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(ACCESS_LOG).option("maxFilesPerTrigger", 1).parquet(folder)
        logs = job.with_event_time_limit(source, "5 seconds")
        job.write_minute_sketches(logs, database, f"{tmp_path}/c", {"availableNow": True}).awaitTermination()
    found = collect(metrics_from_sketches(tables.read_table(spark, database, table), ("1 hour",)).where("http_route <> 'late'"))
    closed = spark.read.schema(ACCESS_LOG).parquet(folder).where("http_route <> 'late'")
    exact = collect(route_metrics(closed, ("1 hour",)))
    assert sorted((r["http_route"], r["request_count"], r["error_rate_pct"], r["max_latency_ms"]) for r in found) == sorted(
        (r["http_route"], r["request_count"], r["error_rate_pct"], r["max_latency_ms"]) for r in exact
    )
    assert all(r["window_end"] - r["window_start"] == timedelta(hours=1) for r in found)
