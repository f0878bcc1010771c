"""The SQL views kept up to date from a stream.

A view with a HAVING filter must lose a row again when the row stops qualifying. An update
stream cannot say so if the filter runs before the sink, so each view is backed by a table
of unfiltered rows, keyed and upserted, and the filter is part of the view that reads it.

Percentiles and distinct counts would put a list of values into the state of each group, and
a busy route or client would have all of its values in one task. Those views are backed by
*cells* instead: one row per group and distinct latency or route, with counters. The state is
a few longs per cell, a hot group is spread by the cell's key, and the view sums the cells up
when it is read.

The source of the views has no watermark: results are revised for as long as rows arrive,
and the state grows with the number of groups. Pass a stream with a watermark to bound it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from routelens.operators.activity import ACTIVE_CLIENT_REQUESTS, route_cells, route_summary
from routelens.operators.alerts import DEFAULT_THRESHOLD_MS
from routelens.operators.errors import sql_error_events
from routelens.operators.metrics import (
    FIVE_MINUTES_ROLLING,
    FIVE_MINUTES_SECONDS,
    ONE_MINUTE,
    sql_route_metrics_1m,
    window_cells,
)
from routelens.streaming.sinks import Trigger, upsert_stream


@dataclass(frozen=True)
class StreamView:
    """How one view is maintained.

    ``keys`` empty means append-only. ``time`` places a row in a partition; a view without
    one holds a single row per key and lives in one partition. ``measures`` is the select list
    that sums the cells of each of ``groups`` up; without it the rows are the view's rows.
    """

    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...] = ()
    time: str | None = "window_start"
    having: str | None = None
    groups: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()

    def query(self, table: str, columns: list[str]) -> str:
        """The view's SQL over its backing table."""
        names = ", ".join(f"`{c}`" for c in (self.groups if self.measures else columns))
        if not self.measures:
            return f"SELECT {names} FROM {table}" + (f" WHERE {self.having}" if self.having else "")
        having = f" HAVING {self.having}" if self.having else ""
        return f"SELECT {', '.join((names, *self.measures))} FROM {table} GROUP BY {names}{having}"


ROUTE_WINDOW = ("http_route", "window_start", "window_end")
LATENCY_CELL = ("http_route", "window_start", "response_time_ms")
REQUESTS = "sum(requests) AS request_count"
AVG_LATENCY = (
    "sum(CAST(response_time_ms AS DOUBLE) * requests) / sum(requests) FILTER (WHERE response_time_ms IS NOT NULL)"
    " AS avg_latency_ms"
)


def _percentiles(*levels: float) -> tuple[str, ...]:
    """One column per level, from one buffer: the engine computes equal aggregates once."""
    listed = ", ".join(f"{level}D" for level in levels)
    return tuple(
        f"percentile(response_time_ms, array({listed}), requests)[{at}] AS p{round(level * 100)}_latency_ms"
        for at, level in enumerate(levels)
    )


STREAM_VIEWS = {
    "route_metrics_1m": StreamView(sql_route_metrics_1m, ("http_route", "window_start")),
    "route_metrics_1m_pct": StreamView(
        partial(window_cells, span=ONE_MINUTE),
        LATENCY_CELL,
        groups=ROUTE_WINDOW,
        measures=(
            REQUESTS,
            "sum(successes) AS success_count",
            "sum(client_errors) AS client_error_count",
            "sum(server_errors) AS server_error_count",
            AVG_LATENCY,
            *_percentiles(0.5, 0.95, 0.99),
        ),
    ),
    "route_metrics_5m": StreamView(
        partial(window_cells, span=FIVE_MINUTES_ROLLING),
        LATENCY_CELL,
        groups=ROUTE_WINDOW,
        measures=(
            REQUESTS,
            AVG_LATENCY,
            *_percentiles(0.5, 0.9, 0.95, 0.99),
            "sum(client_errors + server_errors) / sum(requests) * 100 AS error_rate_pct",
            f"sum(requests) / {FIVE_MINUTES_SECONDS} AS requests_per_second",
        ),
    ),
    "error_events": StreamView(sql_error_events, time="timestamp"),
    "latency_alerts": StreamView(
        partial(window_cells, span=ONE_MINUTE),
        LATENCY_CELL,
        groups=ROUTE_WINDOW,
        measures=(*_percentiles(0.99), "sum(requests) AS sample_count", "window_end AS alerted_at"),
        having=f"p99_latency_ms > {DEFAULT_THRESHOLD_MS}",
    ),
    "route_summary": StreamView(route_summary, ("http_route",), time=None),
    "hostname_traffic": StreamView(
        partial(route_cells, key="hostname", span="5 minutes"),
        ("hostname", "window_start", "http_route"),
        groups=("hostname", "window_start", "window_end"),
        measures=(
            REQUESTS,
            "count(DISTINCT http_route) AS unique_routes",
            "sum(latency_total) / nullif(sum(timed), 0) AS avg_latency_ms",
        ),
    ),
    "client_activity": StreamView(
        partial(route_cells, key="client_ip", span="1 minute"),
        ("client_ip", "window_start", "http_route"),
        groups=("client_ip", "window_start", "window_end"),
        measures=(
            REQUESTS,
            "count(DISTINCT http_route) AS routes_accessed",
            "sum(errors) AS error_count",
        ),
        having=f"request_count > {ACTIVE_CLIENT_REQUESTS}",
    ),
}

# A revision rewrites whole partitions of a plain-file table, so they are kept small.
PARTITION = "period"


def _period(time: str | None) -> Column:
    return F.date_format(time, "yyyy-MM-dd-HH") if time else F.lit("all")


def rows_table(database: str, name: str) -> str:
    return f"`{database}`.`{name}_{'cells' if STREAM_VIEWS[name].measures else 'rows'}`"


def read_view(spark: SparkSession, database: str, name: str) -> DataFrame:
    """The view as of now; file listings cached by this session are dropped first."""
    spark.catalog.refreshTable(rows_table(database, name))
    return spark.table(f"`{database}`.`{name}`")


def start_view(
    logs: DataFrame,
    database: str,
    name: str,
    table_format: str,
    checkpoint: str,
    trigger: Trigger,
) -> StreamingQuery:
    """Create the backing table and the view if missing, and start maintaining them."""
    view = STREAM_VIEWS[name]
    spark = logs.sparkSession
    rows = view.build(logs)
    columns = rows.columns
    rows = rows.withColumn(PARTITION, _period(view.time))
    table = rows_table(database, name)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {table_format} PARTITIONED BY ({PARTITION})"
    )
    spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {view.query(table, columns)}")
    if not view.keys:
        return (
            rows.writeStream.queryName(name)
            .outputMode("append")
            .format(table_format)
            .partitionBy(PARTITION)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .toTable(table)
        )
    return upsert_stream(rows, table, view.keys, PARTITION, table_format, checkpoint, trigger, name)

