import random
from collections import defaultdict
from datetime import timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from routelens.operators import metrics
from routelens.operators.sessions import session_metrics
from tests.conftest import NOON, collect, log

MINUTE = timedelta(minutes=1)


def only(frame):
    (row,) = collect(frame)
    return row


def test_status_counts(logs_of):
    row = only(metrics.route_metrics_1m(logs_of(*[log(status=s) for s in (200, 201, 400, 404, 500)])))
    assert row["request_count"] == 5
    assert (row["success_count"], row["client_error_count"], row["server_error_count"]) == (2, 2, 1)
    assert row["error_rate_pct"] == pytest.approx(60.0)


def test_other_statuses_count_as_requests_only(logs_of):
    row = only(metrics.route_metrics_1m(logs_of(*[log(status=s) for s in (0, 100, 199, 301, 399, 600)])))
    assert row["request_count"] == 6
    assert (row["success_count"], row["client_error_count"], row["server_error_count"]) == (0, 0, 1)


def test_latency_stats(logs_of):
    row = only(metrics.route_metrics_1m(logs_of(*[log(latency=v) for v in (10, 50, 100)])))
    assert (row["min_latency_ms"], row["max_latency_ms"]) == (10, 100)
    assert row["avg_latency_ms"] == pytest.approx(53.33, abs=0.01)


def test_percentiles(logs_of):
    row = only(metrics.route_metrics_1m(logs_of(*[log(latency=v) for v in range(1, 101)])))
    found = [row[f"p{p}_latency_ms"] for p in (50, 95, 99)]
    assert found == pytest.approx([50.5, 95.05, 99.01])


def test_partial_results_merge(logs_of):
    rows = [(200, 10), (200, 20), (500, 30), (404, 40)]
    frame = logs_of(*[log(status=s, latency=v) for s, v in rows]).repartition(4)
    row = only(metrics.route_metrics_1m(frame))
    counts = [row[c] for c in ("request_count", "success_count", "client_error_count", "server_error_count")]
    assert counts == [4, 2, 1, 1]
    assert (row["min_latency_ms"], row["max_latency_ms"]) == (10, 40)


def test_bytes(logs_of):
    frame = logs_of(log(bytes_sent=1000, bytes_received=500), log(bytes_sent=2000, bytes_received=1000))
    row = only(metrics.route_metrics_1m(frame))
    assert (row["total_bytes_sent"], row["total_bytes_received"]) == (3000, 1500)


def test_absurd_numbers_do_not_fail_the_job(logs_of):
    huge = 2**63 - 1
    frame = logs_of(log(latency=huge, bytes_sent=huge), log(latency=huge, bytes_sent=huge))
    row = only(metrics.route_metrics_1m(frame))
    assert row["request_count"] == 2 and row["total_bytes_sent"] is None
    assert row["avg_latency_ms"] == pytest.approx(float(huge))


def test_windows_per_route_and_minute(logs_of):
    frame = logs_of(log(0), log(59.999), log(60), log(0, route="checkout"), log(None))
    found = collect(metrics.route_metrics_1m(frame), "http_route", "window_start")
    assert [(r["http_route"], r["window_start"] - NOON, r["request_count"]) for r in found] == [
        ("catalog", timedelta(0), 2),
        ("catalog", MINUTE, 1),
        ("checkout", timedelta(0), 1),
    ]
    assert all(r["window_end"] - r["window_start"] == MINUTE for r in found)


def test_each_request_is_in_five_rolling_windows(logs_of):
    found = collect(metrics.route_metrics_5m(logs_of(log(30))), "window_start")
    assert [r["window_start"] - NOON for r in found] == [i * MINUTE for i in range(-4, 1)]
    assert all(r["window_end"] - r["window_start"] == 5 * MINUTE for r in found)
    assert all(r["request_count"] == 1 for r in found)


def test_pipeline_fixture(logs_of):
    product = [log(i, status=200 if i < 8 else 500, latency=50 + 10 * i) for i in range(10)]
    checkout = [log(2 * i, route="checkout", latency=100 + 20 * i) for i in range(5)]
    found = {r["http_route"]: r for r in collect(metrics.route_metrics_1m(logs_of(*product, *checkout)))}
    row = found["catalog"]
    assert (row["request_count"], row["success_count"], row["server_error_count"]) == (10, 8, 2)
    assert (row["error_rate_pct"], row["avg_latency_ms"], row["p50_latency_ms"]) == pytest.approx((20, 95, 95))
    assert (found["checkout"]["request_count"], found["checkout"]["avg_latency_ms"]) == (5, pytest.approx(140))


def random_logs(seed, n=3000):
    """A third of all requests on one route, some of them with the same latency."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        route = "hot" if rng.random() < 1 / 3 else rng.choice(["a", "b", None])
        latency = rng.choice([5, 5, rng.randrange(2000), None])
        rows.append(log(rng.uniform(0, 900), route, rng.choice([200, 301, 404, 503, None]), latency))
    return rows


def brute_force(rows, width, slide):
    groups = defaultdict(list)
    for r in rows:
        offset = (r["event_time"] - NOON).total_seconds()
        start = int(offset // slide) * slide
        while start > offset - width:
            groups[r["http_route"], start].append(r)
            start -= slide
    return groups


def check_against_brute_force(found, rows, width, slide):
    expected = brute_force(rows, width, slide)
    assert len(found) == len(expected)
    for row in found:
        group = expected[row["http_route"], int((row["window_start"] - NOON).total_seconds())]
        timed = [r["response_time_ms"] for r in group if r["response_time_ms"] is not None]
        failed = [r for r in group if r["status_code"] is not None and r["status_code"] >= 400]
        assert row["request_count"] == len(group)
        assert row["error_rate_pct"] == pytest.approx(len(failed) / len(group) * 100)
        if timed:
            assert row["avg_latency_ms"] == pytest.approx(np.mean(timed))
            assert (row["min_latency_ms"], row["max_latency_ms"]) == (min(timed), max(timed))
            for p in (50, 95, 99):
                assert row[f"p{p}_latency_ms"] == pytest.approx(np.percentile(timed, p))
        else:
            assert row["avg_latency_ms"] is None and row["p99_latency_ms"] is None


@pytest.mark.parametrize("one_step", [False, True])
def test_minute_metrics_equal_brute_force(logs_of, one_step):
    rows = random_logs(1)
    found = collect(metrics.route_metrics_1m(logs_of(*rows), one_step=one_step))
    check_against_brute_force(found, rows, 60, 60)


@pytest.mark.parametrize("one_step", [False, True])
def test_rolling_metrics_equal_brute_force(logs_of, one_step):
    rows = random_logs(2)
    found = collect(metrics.route_metrics_5m(logs_of(*rows), one_step=one_step))
    check_against_brute_force(found, rows, 300, 60)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60))
def test_percentiles_equal_linear_interpolation(logs_of, latencies):
    row = only(metrics.route_metrics_1m(logs_of(*[log(latency=v) for v in latencies])))
    for p in (50, 95, 99):
        assert row[f"p{p}_latency_ms"] == pytest.approx(np.percentile(latencies, p))


def test_approximate_percentiles(logs_of):
    frame = logs_of(*[log(latency=v) for v in range(1, 1001)])
    row = only(metrics.route_metrics_1m(frame, approx=True))
    assert row["p95_latency_ms"] == pytest.approx(950, abs=2)
    assert row["request_count"] == 1000


def test_sql_views_keep_null_routes(logs_of):
    frame = logs_of(log(route=None, status=500), log(route=None, latency=None))
    row = only(metrics.sql_route_metrics_1m(frame))
    assert row["http_route"] is None and row["request_count"] == 2
    assert row["avg_latency_ms"] == 10 and row["error_rate_pct"] == 50
    assert len(row) == 13
    assert len(only(metrics.sql_route_metrics_1m_pct(frame))) == 11


def test_sql_rolling_view(logs_of):
    rows = [log(latency=v) for v in range(1, 101)]
    found = collect(metrics.sql_route_metrics_5m(logs_of(*rows)))
    assert len(found) == 5
    for row in found:
        assert row["p90_latency_ms"] == pytest.approx(90.1)
        assert row["requests_per_second"] == pytest.approx(100 / 300)


def metric_row(spark, seconds, requests=120, sent=60000, received=30000):
    return spark.createDataFrame(
        [("r", NOON, NOON + timedelta(seconds=seconds), requests, sent, received)],
        "http_route STRING, window_start TIMESTAMP, window_end TIMESTAMP, request_count BIGINT, "
        "total_bytes_sent BIGINT, total_bytes_received BIGINT",
    )


def test_throughput(spark):
    row = only(metrics.route_throughput(metric_row(spark, 60)))
    assert row["requests_per_second"] == 2.0
    assert (row["bytes_sent_per_second"], row["bytes_received_per_second"]) == (1000.0, 500.0)
    assert only(metrics.route_throughput(metric_row(spark, 300)))["window_seconds"] == 300


def test_throughput_of_an_empty_duration(spark):
    row = only(metrics.route_throughput(metric_row(spark, 0)))
    assert (row["requests_per_second"], row["bytes_sent_per_second"]) == (0.0, 0.0)


def test_status_categories(logs_of):
    frame = logs_of(*[log(status=s) for s in (201, 404, 503, 599, 99)])
    found = {r["status_category"]: r["request_count"] for r in collect(metrics.status_categories(frame))}
    assert found == {"2xx": 1, "4xx": 1, "5xx": 2, "0xx": 1}


def test_cells_hold_one_row_per_distinct_latency(logs_of):
    frame = logs_of(*[log(latency=i % 7) for i in range(500)])
    cells = metrics.latency_cells(frame, "http_route", metrics.ONE_MINUTE)
    assert cells.count() == 7
    assert cells.agg(F.sum("requests")).first()[0] == 500


def test_byte_totals_beyond_the_range_are_null(spark, logs_of):
    top = 2**63 - 1
    frame = logs_of(*[log(1, latency=5, bytes_sent=top), log(2, latency=5, bytes_sent=top), log(3, latency=9, bytes_sent=1)])
    for built in (metrics.route_metrics_1m(frame), metrics.route_metrics_5m(frame), session_metrics(frame, timedelta(seconds=20))):
        assert {r["total_bytes_sent"] for r in collect(built)} == {None}
