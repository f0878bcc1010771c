"""Streamed sessions from bounds and visits against the batch operator."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from routelens.operators.sessions import session_metrics
from routelens.schemas import ACCESS_LOG
from routelens.streaming import client_sessions, job, tables
from tests.conftest import NOON, collect, log

GAP = timedelta(seconds=20)


@pytest.fixture
def feed(spark, tmp_path, database):
    tables.ensure_tables(spark, database, wanted=client_sessions.SESSION_TABLES)
    folder = f"{tmp_path}/input"

    def add(*rows):
        spark.createDataFrame(list(rows), ACCESS_LOG).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(ACCESS_LOG).option("maxFilesPerTrigger", 1).parquet(folder)
        logs = job.with_event_time_limit(source, "5 seconds")
        for query in client_sessions.write_sessions(logs, GAP, database, "parquet", f"{tmp_path}/c", {"availableNow": True}):
            query.awaitTermination()
        return client_sessions.read_sessions(spark, database, GAP)

    add.folder = folder
    return add


def comparable(rows):
    return sorted(str({k: round(v, 6) if isinstance(v, float) else v for k, v in r.items()}) for r in rows)


def test_sessions_equal_batch_over_several_runs(spark, feed):
    for part in range(3):
        found = feed(*[
            log(200 * part + 7 * i + (i % 5) * 9, ("a", "b", None)[i % 3], (200, 404, 500)[i % 3], None if i % 4 == 0 else i,
                client_ip=("10.42.0.1", "10.42.0.2", None)[i % 7 % 3], path=(None, "/x", "/y", "/z")[i % 4], bytes_sent=2**62)
            for i in range(25)
        ])
    found = collect(feed(log(5000)))
    batch = collect(session_metrics(spark.read.schema(ACCESS_LOG).parquet(feed.folder), GAP))
    assert len(batch) > 10 and any(r["total_bytes_sent"] is None for r in batch)
    assert comparable(found) == comparable(r for r in batch if r["session_start"] < NOON + timedelta(seconds=5000))


def test_a_session_over_midnight_and_many_slots_is_one_row(feed):
    before = 12 * 3600 - 300  # seconds from noon
    events = [log(before + 15 * i, ("a", "b")[i % 2]) for i in range(40)]
    feed(*events)
    (row,) = collect(feed(log(100_000, client_ip="10.42.0.9")))
    assert (row["request_count"], row["unique_route_count"], row["session_duration_ms"]) == (40, 2, 39 * 15_000)


def test_silence_of_a_gap_joins_and_more_does_not(feed):
    feed(log(0), log(20, path="/other"), log(40.001), log(60))
    rows = collect(feed(log(5000)), "session_start")
    assert [(r["request_count"], r["unique_path_count"]) for r in rows] == [(2, 2), (2, 1)]


def test_state_holds_no_lists_and_days_are_pruned(spark, feed, database, tmp_path):
    found = feed(log(0), log(100_000))
    source = spark.readStream.schema(ACCESS_LOG).parquet(feed.folder)
    for build in (client_sessions.session_bounds, client_sessions.session_visits):
        plan = build(job.with_event_time_limit(source, "5 seconds"), GAP)._jdf.queryExecution().analyzed().toString()
        assert "collect_set" not in plan
    bounded = client_sessions.read_sessions(spark, database, GAP, since=NOON, until=NOON + timedelta(hours=1))
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "visit_date" in plan
    assert bounded.count() == found.where(F.col("session_start") < F.lit(NOON + timedelta(hours=1))).count() == 1


def test_empty_tables_give_no_sessions_and_a_gap_must_be_positive(spark, database):
    tables.ensure_tables(spark, database, wanted=client_sessions.SESSION_TABLES)
    assert client_sessions.read_sessions(spark, database, GAP).collect() == []
    with pytest.raises(ValueError):
        client_sessions.session_bounds(spark.createDataFrame([], ACCESS_LOG), timedelta(0))
