"""Reports over the result tables: the same rows as over all of them, from few days."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from routelens.operators.alerts import latency_alerts
from routelens.operators.errors import error_events
from routelens.operators.metrics import route_metrics_1m, route_metrics_5m
from routelens.plans import reports, table_reports
from routelens.schemas import ACCESS_LOG
from routelens.streaming import tables
from routelens.streaming.folding import fold_day
from routelens.streaming.sinks import append_batch
from tests.conftest import NOON, collect, log

MIDNIGHT = NOON.replace(hour=0)
DAYS = 9


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """Nine days with windows around each midnight, two routes, some slow and some failing."""
    database = "reported"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path_factory.mktemp('tables')}'")
    tables.ensure_tables(spark, database)
    rows = [
        log(at - 12 * 3600 + 86400 * day, route=r, latency=900 if r == "slow" else 10, status=500 if at % 7 == 0 else 200)
        for day in range(DAYS) for at in (-301, -61, -30, 0, 70, 3599) for r in ("slow", "quick")
    ]
    logs = spark.createDataFrame(rows, ACCESS_LOG).persist()
    now = F.current_timestamp()
    minutes = route_metrics_1m(logs).withColumn("processing_time", now)
    for batch in (0, 1):
        part = minutes.where(F.pmod(F.hash("http_route", "window_start"), F.lit(2)) == batch)
        append_batch(part, database, tables.ROUTE_METRICS_1M, batch, "q")
        append_batch(latency_alerts(part, 500).withColumn("alert_time", now), database, tables.LATENCY_ALERTS_TABLE, batch, "q")
    append_batch(route_metrics_5m(logs).withColumn("processing_time", now), database, tables.ROUTE_METRICS_5M, 0, "q")
    errors = tables.ERROR_EVENTS_TABLE.rows(error_events(logs).withColumn("processing_time", now))
    errors.write.insertInto(f"{database}.error_events")
    fold_day(spark, database, tables.ROUTE_METRICS_1M, NOON.date())
    yield database, logs
    spark.sql(f"DROP DATABASE {database} CASCADE")


def days_read(frame):
    """Days of the files that a report opens, from the folders they are in."""
    rows = frame.select(F.regexp_extract(F.input_file_name(), "_date=([0-9-]+)", 1).alias("day"))
    return {r["day"] for r in rows.distinct().collect()}


def same(found, expected, *without):
    return collect(found.drop(*without)) == collect(expected.drop(*without))


@pytest.mark.parametrize("day, second", [(1, 30), (4, 3600), (8, 60), (0, 0), (3, 1800)])
def test_the_last_hour(spark, filled, day, second):
    database, logs = filled
    as_of = MIDNIGHT + timedelta(days=day, seconds=second)
    expected = reports.route_rate_last_hour(route_metrics_1m(logs), F.lit(as_of))
    found = table_reports.route_rate_last_hour(spark, database, as_of)
    assert same(found, expected)
    bounded = table_reports.ended_between(spark, database, tables.ROUTE_METRICS_1M, as_of - timedelta(hours=1), as_of)
    assert len(days_read(bounded)) <= 2
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "window_date" in plan[plan.index("PartitionFilters: [") : plan.index("PushedFilters")]
    alerts = table_reports.recent_alerts(spark, database, as_of).orderBy("window_start").drop("alert_time")
    whole = latency_alerts(route_metrics_1m(logs), 500).where(F.col("window_end") > F.lit(as_of - timedelta(hours=1)))
    assert collect(alerts) == collect(whole.orderBy("window_start").select(alerts.columns)) and alerts.count() > 0


def test_trends_of_some_days(spark, filled):
    database, logs = filled
    since, until = MIDNIGHT + timedelta(days=2), MIDNIGHT + timedelta(days=4)
    ended = (F.col("window_end") > F.lit(since)) & (F.col("window_end") <= F.lit(until))
    found = table_reports.error_trend_hourly(spark, database, since, until)
    assert same(found, reports.error_trend_hourly(route_metrics_1m(logs).where(ended)))
    found = table_reports.error_rate_trend(spark, database, 30.0, since, until)
    assert same(found, reports.error_rate_trend(route_metrics_5m(logs).where(ended), 30.0))
    rows = table_reports.ended_between(spark, database, tables.ROUTE_METRICS_5M, since, until)
    assert len(days_read(rows)) <= 4
    assert same(table_reports.error_trend_hourly(spark, database), reports.error_trend_hourly(route_metrics_1m(logs)))


@pytest.mark.parametrize("n, days", [(1, 1), (6, 1), (12, 2), (20, 4), (30, 4), (1000, DAYS + 1)])
def test_the_newest_rows_come_from_the_newest_days(spark, filled, n, days):
    database, logs = filled
    found = table_reports.latest_metrics(spark, database, n)
    assert same(found, reports.latest_metrics(route_metrics_1m(logs), n), "processing_time")
    assert len(days_read(table_reports.newest_days(spark, database, tables.ROUTE_METRICS_1M, n))) <= days
    rolling = table_reports.latest_metrics(spark, database, n, tables.ROUTE_METRICS_5M)
    assert same(rolling, reports.latest_metrics(route_metrics_5m(logs), n), "processing_time")
    errors = error_events(logs)
    order = [c for c in errors.columns if c != "event_time"]
    newest = errors.orderBy(F.desc("event_time"), *order).limit(n)
    assert same(table_reports.latest_errors(spark, database, n), newest, "processing_time")


def test_tables_without_rows(spark, database):
    tables.ensure_tables(spark, database)
    assert table_reports.latest_metrics(spark, database).count() == 0
    assert table_reports.latest_errors(spark, database).count() == 0
    assert table_reports.route_rate_last_hour(spark, database).count() == 0
    assert table_reports.recent_alerts(spark, database, datetime(2026, 1, 1, tzinfo=timezone.utc)).count() == 0
