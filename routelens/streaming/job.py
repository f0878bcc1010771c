"""The streaming job: one source, three queries, four tables.

- minute metrics, one aggregation whose closed windows feed both the metric table and the
  alert table;
- rolling five-minute metrics;
- error events, stateless.

With ``landing`` one more query decodes the source into a table, and the three read that table.

Each query has its own checkpoint and restarts from it. The tables are not committed
together: after a failure one may be a batch ahead of another until the query catches up.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from routelens.operators.alerts import latency_alerts
from routelens.operators.errors import error_events
from routelens.operators.metrics import route_metrics_1m, route_metrics_5m
from routelens.operators.sketches import minute_sketches
from routelens.options import JobOptions
from routelens.session import build_session
from routelens.sources.reader import read_access_logs_stream
from routelens.streaming.folding import drop_folded, fold_closed_days
from routelens.streaming.late_rows import LateRowLog
from routelens.streaming.sinks import Trigger, append_batch, append_stream, query_of
from routelens.streaming.tables import (
    ACCESS_LOGS,
    ERROR_EVENTS_TABLE,
    LATENCY_ALERTS_TABLE,
    RESULT_TABLES,
    ROUTE_METRICS_1M,
    ROUTE_METRICS_5M,
    ROUTE_SKETCHES_1M,
    ensure_database,
    ensure_tables,
)


def checkpoint_root(spark: SparkSession, given: str | None = None) -> str:
    """Shared folder for checkpoints: the option, else the one the cluster names."""
    root = given or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set --checkpoint.dir or spark.checkpoint.dir to a shared folder")
    return root.rstrip("/")


def with_event_time_limit(logs: DataFrame, delay: str) -> DataFrame:
    """Rows up to ``delay`` behind the newest event are on time."""
    return logs.withWatermark("event_time", delay)


def with_event_time_limits(streams: Sequence[DataFrame], delay: str, wait_for_idle: bool) -> DataFrame:
    """Streams of several sources as one, with the limit to wait for the slowest source or not.

    With ``wait_for_idle`` each source has a limit of its own and the least one counts (the engine's default policy): no
    row of a slow source is late, but a source that has sent nothing keeps all windows open. Otherwise the
    newest event of any source sets the limit: an idle source holds nothing up, and a slow one may be late.
    """
    if wait_for_idle:
        return _union([with_event_time_limit(stream, delay) for stream in streams])
    return with_event_time_limit(_union(streams), delay)


def _union(streams: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, streams)


def _stamped(frame: DataFrame, column: str) -> DataFrame:
    return frame.withColumn(column, F.current_timestamp())


def write_minute_metrics_and_alerts(
    logs: DataFrame, database: str, threshold_ms: int, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Minute metrics to their table and, from the same rows, alerts to theirs."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            query_id = query_of(batch.sparkSession, checkpoint)
            append_batch(_stamped(batch, "processing_time"), database, ROUTE_METRICS_1M, batch_id, query_id)
            alerts = latency_alerts(batch, threshold_ms)
            append_batch(_stamped(alerts, "alert_time"), database, LATENCY_ALERTS_TABLE, batch_id, query_id)
        finally:
            batch.unpersist()

    return _write_batches(route_metrics_1m(logs), ROUTE_METRICS_1M.name, write, checkpoint, trigger)


def write_rolling_metrics(
    logs: DataFrame, database: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Rolling metrics to their table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = query_of(batch.sparkSession, checkpoint)
        append_batch(_stamped(batch, "processing_time"), database, ROUTE_METRICS_5M, batch_id, query_id)

    return _write_batches(route_metrics_5m(logs), ROUTE_METRICS_5M.name, write, checkpoint, trigger)


def write_minute_sketches(
    logs: DataFrame, database: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Minute rows with a latency sketch to their table, from which ``metrics_from_sketches`` gives longer windows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, database, ROUTE_SKETCHES_1M, batch_id, query_of(batch.sparkSession, checkpoint))

    return _write_batches(minute_sketches(logs), ROUTE_SKETCHES_1M.name, write, checkpoint, trigger)


def _write_batches(
    frame: DataFrame,
    name: str,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger,
) -> StreamingQuery:
    writer = frame.writeStream.queryName(name).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).trigger(**trigger)
    return writer.foreachBatch(write).start()


def write_error_events(
    logs: DataFrame, database: str, table_format: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Error events straight to their table; a shuffle to size files would cost more."""
    events = _stamped(error_events(logs), "processing_time")
    return append_stream(events, database, ERROR_EVENTS_TABLE, table_format, checkpoint, trigger)


def write_landing(
    logs: DataFrame, database: str, table_format: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Decoded logs to a table of their own. Every payload is parsed here and nowhere else."""
    return append_stream(logs, database, ACCESS_LOGS, table_format, checkpoint, trigger)


def landed_logs(spark: SparkSession, database: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The landing table as a stream. Only files of committed micro-batches are read, each once.

    A time that was missing in the payload is the time of landing, the same in every stream.
    """
    landed = spark.readStream.options(**(options or {})).table(f"`{database}`.`{ACCESS_LOGS.name}`")
    return landed.select(*ACCESS_LOGS.schema.fieldNames())


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows behind the watermark so far, as far back as progress is kept; ``late_rows`` has the counts of all runs.

    Rows are counted after a task has folded its part of them.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def fold_past_days(spark: SparkSession, database: str) -> None:
    """Fold the days before today of the result tables, and drop what earlier folds have replaced."""
    fold_closed_days(spark, database, RESULT_TABLES, before=datetime.now(timezone.utc).date())
    drop_folded(spark, database, RESULT_TABLES)


def _trigger(options: JobOptions) -> Trigger:
    return {"availableNow": True} if options.available_now else {"processingTime": options.trigger_interval}


def start_queries(spark: SparkSession, logs: DataFrame, options: JobOptions) -> list[StreamingQuery]:
    """Create what is missing and start the three queries on a stream of access logs."""
    root = checkpoint_root(spark, options.checkpoint_dir)
    ensure_database(spark, options.database, options.catalog)
    ensure_tables(spark, options.database, options.table_format)
    if options.fold_closed_days:
        fold_past_days(spark, options.database)
    trigger = _trigger(options)
    timed = with_event_time_limit(logs, options.watermark)
    db, fmt = options.database, options.table_format
    return [
        write_minute_metrics_and_alerts(
            timed, db, options.latency_threshold_ms, f"{root}/route_metrics_1m", trigger
        ),
        write_rolling_metrics(timed, db, f"{root}/route_metrics_5m", trigger),
        write_error_events(logs, db, fmt, f"{root}/error_events", trigger),
    ]


def start_job(spark: SparkSession, options: JobOptions) -> list[StreamingQuery]:
    """Start the job on its configured source.

    With ``landing`` a first stream decodes the source into a table and the others read that. A run that ends with its
    input waits for the landing before it starts them, so that they see all of it.
    """
    logs = read_access_logs_stream(
        spark, options.source_format, options.source_path, options.start_options()
    )
    if not options.landing:
        return start_queries(spark, logs, options)
    ensure_database(spark, options.database, options.catalog)
    ensure_tables(spark, options.database, options.table_format, [ACCESS_LOGS])
    checkpoint = f"{checkpoint_root(spark, options.checkpoint_dir)}/{ACCESS_LOGS.name}"
    landing = write_landing(logs, options.database, options.table_format, checkpoint, _trigger(options))
    if options.available_now:
        landing.awaitTermination()
    return [landing, *start_queries(spark, landed_logs(spark, options.database), options)]


def run_job(args: Sequence[str] | None = None) -> None:
    """Entry point: start the job and wait until a query ends or fails."""
    options = JobOptions.from_args(sys.argv[1:] if args is None else args)
    spark = build_session("route-analytics", options.confs)
    late = LateRowLog(spark, f"{checkpoint_root(spark, options.checkpoint_dir)}/late_rows")
    spark.streams.addListener(late)
    queries = start_job(spark, options)
    try:
        if options.available_now:
            for query in queries:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            late.finish(query)
        spark.streams.removeListener(late)
