"""The reports of ``plans.reports`` over the job's result tables, reading no more days than a report needs.

``as_of`` and time ranges become bounds on the day that a table is partitioned by. A report on the newest rows reads the
newest days first, twice as many each time, and stops when it has enough rows: every row of an older day is older.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelens.plans import reports
from routelens.streaming.folding import TableFolder
from routelens.streaming.tables import (
    ERROR_EVENTS_TABLE,
    LATENCY_ALERTS_TABLE,
    ROUTE_METRICS_1M,
    ROUTE_METRICS_5M,
    ResultTable,
    read_table,
)

HOUR = timedelta(hours=1)
#: How long after its window's start, by which it is dated, a row's window ends.
WINDOW = {ROUTE_METRICS_1M: timedelta(minutes=1), ROUTE_METRICS_5M: timedelta(minutes=5), LATENCY_ALERTS_TABLE: timedelta(minutes=1)}


def _moment(as_of: datetime | None) -> datetime:
    return datetime.now(timezone.utc) if as_of is None else as_of


def ended_between(
    spark: SparkSession, database: str, table: ResultTable, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Rows whose window ends after ``since`` and, if given, at or before ``until``."""
    length = WINDOW[table]
    started = None if since is None else since - length
    rows = read_table(spark, database, table, started, None if until is None else until)
    if since is not None:
        rows = rows.where(F.col("window_end") > F.lit(since))
    return rows if until is None else rows.where(F.col("window_end") <= F.lit(until))


def route_rate_last_hour(spark: SparkSession, database: str, as_of: datetime | None = None) -> DataFrame:
    """Requests, mean of the minute means and highest p99 per route of the hour before ``as_of``, or before now."""
    moment = _moment(as_of)
    return reports.route_rate_last_hour(ended_between(spark, database, ROUTE_METRICS_1M, moment - HOUR), F.lit(moment))


def recent_alerts(spark: SparkSession, database: str, as_of: datetime | None = None) -> DataFrame:
    """Alerts on windows that ended in the last hour before ``as_of``, or before now."""
    return ended_between(spark, database, LATENCY_ALERTS_TABLE, _moment(as_of) - HOUR)


def error_trend_hourly(
    spark: SparkSession, database: str, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Errors per hour and route of windows that end in the given time."""
    return reports.error_trend_hourly(ended_between(spark, database, ROUTE_METRICS_1M, since, until))


def error_rate_trend(
    spark: SparkSession, database: str, above_pct: float = 5.0, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Rolling windows that end in the given time with an error rate above ``above_pct``, newest first."""
    return reports.error_rate_trend(ended_between(spark, database, ROUTE_METRICS_5M, since, until), above_pct)


def newest_days(spark: SparkSession, database: str, table: ResultTable, n: int) -> DataFrame:
    """Rows of the newest days of a table, of so many days that there are ``n`` rows or that there is no other."""
    name = f"`{database}`.`{table.name}`"
    folder = TableFolder.of(spark, name, table.date_column)
    if folder is None:
        days = [r[0] for r in spark.table(name).select(table.date_column).distinct().collect() if r[0] is not None]
        days.sort(reverse=True)
    else:
        days = folder.days()
    take = 1
    while take < len(days):
        oldest = datetime(*days[take - 1].timetuple()[:3], tzinfo=timezone.utc)
        rows = read_table(spark, database, table, since=oldest)
        if rows.limit(n).count() >= n:
            return rows
        take *= 2
    return read_table(spark, database, table)


def latest_metrics(spark: SparkSession, database: str, n: int = 20, table: ResultTable = ROUTE_METRICS_1M) -> DataFrame:
    """The ``n`` newest metric rows of a table; ties are settled by route."""
    return reports.latest_metrics(newest_days(spark, database, table, n), n)


def latest_errors(spark: SparkSession, database: str, n: int = 20) -> DataFrame:
    """The ``n`` newest error events; ties are settled by the other columns."""
    rows = newest_days(spark, database, ERROR_EVENTS_TABLE, n)
    rest = [c for c in rows.columns if c not in ("event_time", "processing_time")]
    return rows.orderBy(F.desc("event_time"), *rest, "processing_time").limit(n)
