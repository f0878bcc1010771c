"""The four result tables.

Besides the columns of their schema, the tables carry a date column to prune by. The
tables written micro-batch by micro-batch also carry the id of their query and the batch
number, which make a repeated batch replace itself and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routelens.schemas import ACCESS_LOG, ERROR_EVENTS, LATENCY_ALERTS, ROUTE_METRICS, ROUTE_SKETCHES
from routelens.streaming.folding import current_rows


@dataclass(frozen=True)
class ResultTable:
    name: str
    schema: T.StructType
    date_of: str
    date_column: str
    per_batch: bool

    @property
    def partition_columns(self) -> list[str]:
        return [self.date_column, "query_id", "batch_id"] if self.per_batch else [self.date_column]

    def rows(self, frame: DataFrame) -> DataFrame:
        """``frame`` in table order with the date column added."""
        return frame.select(*self.schema.fieldNames(), F.to_date(self.date_of).alias(self.date_column))


ROUTE_METRICS_1M = ResultTable("route_metrics_1m", ROUTE_METRICS, "window_start", "window_date", True)
ROUTE_METRICS_5M = ResultTable("route_metrics_5m", ROUTE_METRICS, "window_start", "window_date", True)
ERROR_EVENTS_TABLE = ResultTable("error_events", ERROR_EVENTS, "event_time", "event_date", False)
LATENCY_ALERTS_TABLE = ResultTable("latency_alerts", LATENCY_ALERTS, "window_start", "window_date", True)
#: Minute rows whose latencies are a sketch; windows of any length are read from them.
ROUTE_SKETCHES_1M = ResultTable("route_sketches_1m", ROUTE_SKETCHES, "window_start", "window_date", True)
#: Decoded input, written once for all streams that read it.
ACCESS_LOGS = ResultTable("access_logs", ACCESS_LOG, "event_time", "event_date", False)
RESULT_TABLES = (ROUTE_METRICS_1M, ROUTE_METRICS_5M, ERROR_EVENTS_TABLE, LATENCY_ALERTS_TABLE)


def ensure_database(
    spark: SparkSession, database: str, catalog: str | None = None, location: str | None = None
) -> None:
    """Create the database if it is missing and make it the current one."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    spark.catalog.setCurrentDatabase(database)


def ensure_tables(
    spark: SparkSession, database: str, table_format: str = "parquet", wanted: Sequence[ResultTable] = RESULT_TABLES
) -> None:
    """Create whichever of the tables is missing."""
    for table in wanted:
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields]
        columns.append(f"`{table.date_column}` date")
        if table.per_batch:
            columns += ["`query_id` string", "`batch_id` bigint"]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{table.name}` ({', '.join(columns)}) "
            f"USING {table_format} PARTITIONED BY ({', '.join(table.partition_columns)})"
        )


def read_table(
    spark: SparkSession, database: str, table: ResultTable, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    """A result table as of now, with its own columns only. Of folded days the newest generation is read.

    ``since`` (inclusive) and ``until`` (exclusive) bound the time that the table is dated by. Partitions of other days are not read.
    """
    name = f"`{database}`.`{table.name}`"
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    if since is not None:
        rows = rows.where((F.col(table.date_of) >= F.lit(since)) & (F.col(table.date_column) >= F.to_date(F.lit(since))))
    if until is not None:
        rows = rows.where((F.col(table.date_of) < F.lit(until)) & (F.col(table.date_column) <= F.to_date(F.lit(until))))
    if table.per_batch:
        days = [None if bound is None else bound.astimezone(timezone.utc).date() for bound in (since, until)]
        rows = current_rows(rows, name, table.date_column, *days)
    return rows.select(*table.schema.fieldNames())
