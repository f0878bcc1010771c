from datetime import timedelta

from routelens.operators.activity import client_activity, hostname_traffic, route_summary
from routelens.operators.errors import error_events, sql_error_events
from routelens.schemas import ERROR_EVENTS
from tests.conftest import NOON, collect, log


def test_error_events(logs_of):
    frame = logs_of(*[log(i, status=s) for i, s in enumerate((200, 399, 400, 499, 500, 600, None))])
    found = collect(error_events(frame), "event_time")
    assert [(r["status_code"], r["error_category"]) for r in found] == [
        (400, "CLIENT_ERROR"), (499, "CLIENT_ERROR"), (500, "SERVER_ERROR"), (600, "SERVER_ERROR"),
    ]
    assert list(found[0]) == [c for c in ERROR_EVENTS.fieldNames() if c != "processing_time"]
    expected = {**log(2, status=400), "error_category": "CLIENT_ERROR"}
    assert found[0] == {c: expected[c] for c in found[0]}


def test_sql_error_events(logs_of):
    found = collect(sql_error_events(logs_of(log(status=404, route=None), log(1, status=503), log(2))), "timestamp")
    assert [(r["http_route"], r["error_type"]) for r in found] == [
        (None, "client_error"), ("catalog", "server_error"),
    ]


def test_route_summary(logs_of):
    frame = logs_of(log(0, latency=10), log(4000, status=404, latency=30), log(5, route=None, status=301))
    found = {r["http_route"]: r for r in collect(route_summary(frame))}
    row = found["catalog"]
    assert (row["total_requests"], row["total_success"], row["total_errors"]) == (2, 1, 1)
    assert row["overall_avg_latency_ms"] == 20 and row["last_seen"] == NOON + timedelta(seconds=4000)
    assert (found[None]["total_success"], found[None]["total_errors"]) == (0, 0)


def test_hostname_traffic(logs_of):
    frame = logs_of(
        log(0, route="a"), log(299, route="a"), log(10, route="b"), log(20, route=None), log(300, route="c"),
        log(0, hostname="other"),
    )
    found = collect(hostname_traffic(frame), "hostname", "window_start")
    assert [(r["hostname"], r["request_count"], r["unique_routes"]) for r in found] == [
        ("media.routelens.test", 4, 2), ("media.routelens.test", 1, 1), ("other", 1, 1),
    ]


def test_client_activity(logs_of):
    eleven = [log(i, route=f"r{i % 3}", status=500 if i == 0 else 200, client_ip="busy") for i in range(11)]
    ten = [log(i, client_ip="calm") for i in range(10)]
    spread = [log(50 + i, client_ip="spread") for i in range(12)]
    (row,) = collect(client_activity(logs_of(*eleven, *ten, *spread)))
    assert (row["client_ip"], row["request_count"], row["routes_accessed"], row["error_count"]) == ("busy", 11, 3, 1)
