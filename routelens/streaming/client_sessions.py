"""Client sessions of a stream, kept in two tables and put together when they are read.

One aggregation per session would hold each client's distinct paths and routes in its state. Instead two
streams write rows of counters:

- *bounds*: first and last event of each closed session of a client;
- *visits*: the same session window by client, path and route. Events of one visit are never further apart than
  the gap, so a visit lies in one session of its client. The state is spread by path and route.

A reader joins a visit to the session in whose bounds it begins. Time is cut into slots of eight gaps, within days,
and the join goes by client, day and slot: a session of n events covers at most n / 8 + 2 slots for each day
it touches, and a slot holds at most nine sessions of a client, so neither side grows beyond its events.

The two streams commit on their own. While one is behind the other, a session may be read with a part of its visits;
once both have read the same input, the rows are those of ``session_metrics``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from routelens.functions.status import is_error, wide_sum
from routelens.operators.sessions import finish_sessions
from routelens.schemas import struct
from routelens.streaming.sinks import Trigger, append_stream
from routelens.streaming.tables import ResultTable, read_table

BOUNDS = ResultTable(
    "session_bounds",
    struct("client_ip STRING, session_start TIMESTAMP, session_end TIMESTAMP"),
    "session_start",
    "session_date",
    False,
)
VISITS = ResultTable(
    "session_visits",
    struct(
        "client_ip STRING, path STRING, http_route STRING, first_seen TIMESTAMP, requests BIGINT, "
        "errors BIGINT, response_time DOUBLE, bytes WIDE"
    ),
    "first_seen",
    "visit_date",
    False,
)
SESSION_TABLES = (BOUNDS, VISITS)

SLOT_GAPS = 8
DAY_MICROS = 86_400_000_000


def _window(gap: timedelta) -> Column:
    if gap <= timedelta(0):
        raise ValueError("the session gap must be positive")
    return F.session_window("event_time", f"{gap // timedelta(milliseconds=1)} milliseconds")


def session_bounds(logs: DataFrame, gap: timedelta) -> DataFrame:
    """First and last event of each session of a client."""
    return logs.groupBy("client_ip", _window(gap)).agg(
        F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end")
    )


def session_visits(logs: DataFrame, gap: timedelta) -> DataFrame:
    """Counters of each stay of a client on a path and route."""
    return logs.groupBy("client_ip", "path", "http_route", _window(gap)).agg(
        F.min("event_time").alias("first_seen"),
        F.count("*").alias("requests"),
        F.count_if(is_error(F.col("status_code"))).alias("errors"),
        F.sum(F.col("response_time_ms").cast("double")).alias("response_time"),
        wide_sum("bytes_sent").alias("bytes"),
    )


def write_sessions(
    logs: DataFrame, gap: timedelta, database: str, table_format: str, checkpoint: str, trigger: Trigger
) -> list[StreamingQuery]:
    """Start both streams; ``logs`` needs a watermark, which closes sessions. ``gap`` must stay the same for a checkpoint."""
    return [
        append_stream(build(logs, gap), database, table, table_format, f"{checkpoint}/{table.name}", trigger)
        for table, build in ((VISITS, session_visits), (BOUNDS, session_bounds))
    ]


def _slot(instant: Column, gap: timedelta) -> Column:
    """Number of the slot within the day of ``instant``."""
    of_day = F.pmod(F.unix_micros(instant), F.lit(DAY_MICROS))
    return F.call_function("div", of_day, F.lit(_slot_micros(gap)))


def _slot_micros(gap: timedelta) -> int:
    return min(DAY_MICROS, SLOT_GAPS * (gap // timedelta(microseconds=1)))


def _slots_covered(bounds: DataFrame, gap: timedelta) -> DataFrame:
    """One row per day and slot between the first and the last event of a session."""
    first_day, last_day = F.to_date("session_start"), F.to_date("session_end")
    last_of_day = (DAY_MICROS - 1) // _slot_micros(gap)
    days = bounds.withColumn("day", F.explode(F.sequence(first_day, last_day)))
    first = F.when(F.col("day") == first_day, _slot(F.col("session_start"), gap)).otherwise(F.lit(0).cast("bigint"))
    last = F.when(F.col("day") == last_day, _slot(F.col("session_end"), gap)).otherwise(F.lit(last_of_day).cast("bigint"))
    return days.withColumn("slot", F.explode(F.sequence(first, last)))


def join_sessions(bounds: DataFrame, visits: DataFrame, gap: timedelta) -> DataFrame:
    """Session metrics from the rows of both tables. ``visits`` needs its day as ``visit_date``; visits in no session are left out."""
    covered = _slots_covered(bounds, gap).withColumnRenamed("client_ip", "s_client_ip")
    same = F.col("client_ip").eqNullSafe(F.col("s_client_ip")) & (F.col("visit_date") == F.col("day"))
    inside = (_slot(F.col("first_seen"), gap) == F.col("slot")) & F.col("first_seen").between(
        F.col("session_start"), F.col("session_end")
    )
    totals = (
        visits.join(covered, same & inside)
        .groupBy("client_ip", "session_start", "session_end")
        .agg(
            F.sum("requests").alias("request_count"),
            F.count_distinct(F.struct("path")).alias("unique_paths"),
            F.count_distinct(F.struct("http_route")).alias("unique_routes"),
            F.sum("response_time").alias("total_response_time_ms"),
            wide_sum("bytes").try_cast("bigint").alias("total_bytes_sent"),
            F.sum("errors").alias("error_count"),
        )
    )
    return finish_sessions(totals)


def read_sessions(
    spark: SparkSession, database: str, gap: timedelta, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """Closed sessions that begin in the given time. Days of visits that no such session touches are pruned when the query runs."""
    bounds = read_table(spark, database, BOUNDS, since, until)
    name = f"`{database}`.`{VISITS.name}`"
    spark.catalog.refreshTable(name)
    visits = spark.table(name)
    if since is not None:
        visits = visits.where(F.col(VISITS.date_column) >= F.to_date(F.lit(since)))
    return join_sessions(bounds, visits, gap)
