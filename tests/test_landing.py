"""Payloads decoded once into a table that the other streams read."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from routelens.options import JobOptions
from routelens.streaming import job, tables
from tests.conftest import NOON


def payload(at, status=200, route="catalog"):
    fields = {"http_route": route, "status_code": status, "response_time_ms": 5}
    if at is not None:
        fields["timestamp"] = (NOON + timedelta(seconds=at)).isoformat().replace("+00:00", "Z")
    return json.dumps(fields)


@pytest.fixture
def run(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS landed LOCATION '{tmp_path}/tables'")
    before = spark.catalog.currentDatabase()
    batches = []

    def run_job(*payloads):
        folder = tmp_path / "input"
        folder.mkdir(exist_ok=True)
        (folder / f"part{len(batches)}.json").write_text("\n".join(payloads))
        batches.append(payloads)
        given = [
            "--source.path", str(folder), "--checkpoint.dir", f"{tmp_path}/c", "--database", "landed", "--available.now", "true", "--landing", "true",
        ]
        queries = job.start_job(spark, JobOptions.from_args(given))
        for query in queries:
            query.awaitTermination()
        return queries

    yield run_job
    spark.catalog.setCurrentDatabase(before)
    spark.sql("DROP DATABASE landed CASCADE")


def test_landed_once_with_one_time_for_a_missing_one_over_a_restart(spark, run):
    run(payload(0, 500), payload(None, 503), "no json", payload(1, 404))
    first = spark.table("landed.access_logs").where("status_code = 503").select("event_time").collect()
    queries = run(payload(2, 500, "b"), payload(70, 200, "b"))
    assert [q.name for q in queries] == ["access_logs", "route_metrics_1m", "route_metrics_5m", "error_events"]
    spark.catalog.refreshTable("landed.access_logs")
    landed = spark.table("landed.access_logs")
    assert landed.count() == 5
    errors = tables.read_table(spark, "landed", tables.ERROR_EVENTS_TABLE)
    times = {
        name: sorted((r.http_route, r.status_code, r.event_time) for r in rows.where("status_code >= 400").collect())
        for name, rows in (("landed", landed), ("errors", errors))
    }
    assert times["landed"] == times["errors"] and len(times["errors"]) == 4
    assert landed.where("status_code = 503").select("event_time").collect() == first


def test_only_the_landing_parses_payloads(spark, run):
    run(payload(0), payload(90))
    source = job.landed_logs(spark, "landed")
    assert source.isStreaming
    assert "from_json" not in source.where("status_code >= 400")._jdf.queryExecution().analyzed().toString()
    days = spark.table("landed.access_logs").where(F.col("event_date") == F.lit("2026-01-21")).inputFiles()
    assert days and all("event_date=2026-01-21" in f for f in days)


def test_minute_metrics_of_the_landing_equal_those_of_the_payloads(spark, run):
    run(*[payload(10 * i, (200, 404, 500)[i % 3], "ab"[i % 2]) for i in range(30)])
    run(payload(600))
    rows = tables.read_table(spark, "landed", tables.ROUTE_METRICS_1M)
    assert rows.agg(F.sum("request_count"), F.sum("server_error_count"), F.sum("client_error_count")).first() == (30, 10, 10)
    assert rows.select("http_route", "window_start").distinct().count() == rows.count() == 10
