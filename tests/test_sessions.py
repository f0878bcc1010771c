import random
import re
from collections import defaultdict
from datetime import timedelta

import pytest

from routelens.operators import sessions
from routelens.operators.sessions import session_metrics
from routelens.schemas import SESSION_METRICS
from tests.conftest import NOON, collect, log

GAP = timedelta(seconds=20)


def test_gap_edges(logs_of):
    frame = logs_of(log(0), log(20), log(40.001), log(0, client_ip="other"))
    found = collect(session_metrics(frame, GAP), "client_ip", "session_start")
    assert [(r["client_ip"], r["request_count"], r["session_duration_ms"]) for r in found] == [
        ("10.42.1.1", 2, 20000), ("10.42.1.1", 1, 0), ("other", 1, 0),
    ]
    assert (found[0]["session_start"], found[0]["session_end"]) == (NOON, NOON + GAP)


def test_measures(logs_of):
    frame = logs_of(
        log(0, latency=10, bytes_sent=5), log(1, latency=20, path="/b", status=500, bytes_sent=6),
        log(2, latency=60, path="/b", route="x", status=404, bytes_sent=7), log(3, latency=10, path=None, route=None),
    )
    (row,) = collect(session_metrics(frame, GAP))
    assert (row["unique_path_count"], row["unique_route_count"]) == (3, 3)
    assert row["avg_response_time_ms"] == 25 and row["total_bytes_sent"] == 5 + 6 + 7 + 1024
    assert (row["error_count"], row["error_rate"]) == (2, 50.0)


def test_schema(logs_of):
    frame = session_metrics(logs_of(log(0)), GAP)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in SESSION_METRICS]


def test_gap_must_be_positive(logs_of):
    with pytest.raises(ValueError):
        session_metrics(logs_of(log(0)), timedelta(0))


@pytest.mark.parametrize("gap_ms", [1, 700, 20_000])
def test_equals_brute_force(logs_of, gap_ms):
    rng = random.Random(gap_ms)
    rows = []
    for _ in range(1500):
        client = "hot" if rng.random() < 1 / 3 else rng.choice(["a", "b", "c", None])
        at = round(rng.uniform(-400, 400) * gap_ms / 2000, 3)
        rows.append(log(at, rng.choice(["x", "y", None]), rng.choice([200, 500]), rng.randrange(100),
                        client_ip=client, path=rng.choice(["/1", "/2", "/3", None])))
    by_client = defaultdict(list)
    for r in rows:
        by_client[r["client_ip"]].append(r)
    expected = set()
    gap = timedelta(milliseconds=gap_ms)
    for client, events in by_client.items():
        events.sort(key=lambda r: r["event_time"])
        groups = [[events[0]]]
        for before, after in zip(events, events[1:]):
            if after["event_time"] - before["event_time"] > gap:
                groups.append([])
            groups[-1].append(after)
        for g in groups:
            expected.add((
                client, len(g), g[0]["event_time"], g[-1]["event_time"], len({r["path"] for r in g}),
                len({r["http_route"] for r in g}), sum(r["status_code"] >= 400 for r in g),
                round(sum(r["response_time_ms"] for r in g) / len(g), 6),
            ))
    found = {
        (r["client_ip"], r["request_count"], r["session_start"], r["session_end"], r["unique_path_count"],
         r["unique_route_count"], r["error_count"], round(r["avg_response_time_ms"], 6))
        for r in collect(session_metrics(logs_of(*rows), gap))
    }
    assert found == expected


def test_before_1970(logs_of):
    epoch = NOON.replace(year=1970, month=1, day=1, hour=0)
    offsets = (-45, -19, -1, 0, 15, 50)
    frame = logs_of(*[log(event_time=epoch + timedelta(seconds=s)) for s in offsets])
    found = collect(session_metrics(frame, GAP), "session_start")
    assert [r["request_count"] for r in found] == [1, 4, 1]


@pytest.mark.parametrize("bits", [(1, 1), (2, 1), (1, 3), (3, 60)])
@pytest.mark.parametrize("gap_ms", [1, 20_000])
def test_blocks_of_any_size_give_the_same_sessions(logs_of, monkeypatch, gap_ms, bits):
    rng = random.Random(gap_ms)
    rows, at = [], -300.0
    for _ in range(600):  # long chains without silence, and silences of less and more than a block
        at += rng.choice([0, 0.4, 1, 1, 1.001, 3, 9, 40]) if rng.random() < 0.3 else rng.choice([0, 0.5, 0.9, 1])
        rows.append(log(round(at * gap_ms / 1000, 3), client_ip=rng.choice(["hot", "hot", "hot", None]), path=f"/{rng.randrange(3)}"))
    frame, gap = logs_of(*rows), timedelta(milliseconds=gap_ms)
    expected = collect(session_metrics(frame, gap), "client_ip", "session_start")
    if bits == (3, 60):
        monkeypatch.setattr(sessions, "SLICE_BITS", 3)
    else:
        monkeypatch.setattr(sessions, "SLICE_BITS", bits[0])
        monkeypatch.setattr(sessions, "BLOCK_BITS", 60 if gap_ms == 1 else 20 + bits[1])
    assert collect(session_metrics(frame, gap), "client_ip", "session_start") == expected
    assert len(expected) > 20 and sum(r["request_count"] for r in expected) == 600


def test_the_source_is_read_once_and_no_window_spans_a_client(spark, logs_of, tmp_path):
    logs_of(*[log(i * 7, client_ip=f"c{i % 3}") for i in range(200)]).write.parquet(str(tmp_path / "logs"))
    found = session_metrics(spark.read.parquet(str(tmp_path / "logs")), GAP)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    windows = [line.split("windowspecdefinition(")[1] for line in plan.splitlines() if " Window " in line]
    assert windows and all(re.match(r"client_ip#\d+, block#\d+L", spec) for spec in windows)  # by block, or one row a block in order
