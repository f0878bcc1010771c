"""

Every query reads the whole ``events`` table as access logs (see FIXTURES.md). Columns
that hold the wall clock are left out, timestamps leave as zone-less values, and doubles
are rounded to six places, so that two engines can be compared.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from oracle_queries import oracle_queries
from routelens.operators import activity, alerts, errors, metrics, sessions, sketches
from routelens.plans import reports, table_reports, views
from routelens.session import SESSION_CONFS
from routelens.sources import decode, fixture, reader, replay
from routelens.streaming import client_sessions, folding, job, sinks, tables
from routelens.streaming.views import read_view, start_view

try:  # the operators for training data may be left out of an installation
    import corpus_pipeline
    from routelens.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

SESSION_GAP = timedelta(seconds=20)
ONCE = {"availableNow": True}
WATERMARK = "5 seconds"
#: Share of a window's requests by which the rank of a sketch's percentile may be off.
RANK_ERROR = 0.02

Query = Callable[[SparkSession, str], DataFrame]


AS_OF = datetime(2024, 1, 1, 1, 30, tzinfo=timezone.utc)


def _as_of():
    return F.lit("2024-01-01 01:30:00").cast("timestamp")


def _comparable(frame: DataFrame) -> DataFrame:
    columns = []
    for f in frame.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            column = F.round(column, 6)
        columns.append(column.alias(f.name))
    return frame.select(*columns)


def _scratch(spark: SparkSession) -> str:
    """A new folder in the shared place the cluster names; only a local session may leave that out."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def _database(spark: SparkSession, folder: str) -> str:
    """A new database in ``folder``; the current database stays what it was."""
    current = spark.catalog.currentDatabase()
    name = f"check_{uuid.uuid4().hex}"
    tables.ensure_database(spark, name, location=f"{folder}/tables")
    spark.catalog.setCurrentDatabase(current)
    return name


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.access_logs(spark, sf_dir)


def _sql_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.access_logs(spark, sf_dir, default_route=False).drop("event_id")


def _streamed(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    start: Callable[[DataFrame], StreamingQuery],
    default_route: bool = True,
    in_time: bool = True,
) -> None:
    """The whole table through a stream, in two runs on one checkpoint.

    The second run resumes with the state and the tables of the first. With ``in_time`` it
    gets the later half of the time, so that no row is late; otherwise every other row, so
    that it revises what the first has written.
    """
    events = fixture.read_events(spark, sf_dir)
    first = fixture.first_half(events) if in_time else F.col("event_id") % 2 == 0
    first = F.coalesce(first, F.lit(True))
    for part in (first, ~first):
        events.where(part).write.mode("append").parquet(f"{folder}/input/events.parquet")
        start(fixture.access_logs_stream(spark, f"{folder}/input", default_route).drop("event_id")).awaitTermination()


def _from_logs(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_logs(spark, sf_dir))


def _from_sql_logs(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_sql_logs(spark, sf_dir))


def _alerts(logs: DataFrame) -> DataFrame:
    return alerts.latency_alerts(metrics.route_metrics_1m(logs))


def _decoded(start: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: decode.decode_messages(start(fixture.messages(spark, sf_dir)))


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute metrics through the keyed sink, older values of every other minute first: each key is there once, with its last values."""
    folder = _scratch(spark)
    table = f"`{_database(spark, folder)}`.`route_metrics_upsert`"
    rows = metrics.route_metrics_1m(_logs(spark, sf_dir))
    rows = rows.withColumn("period", F.date_format("window_start", "yyyy-MM-dd-HH"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet PARTITIONED BY (period)")
    older = rows.where(F.minute("window_start") % 2 == 0).withColumn("request_count", F.col("request_count") + 1000)
    for attempt, batch in enumerate((older, rows)):
        sinks.upsert_batch(
            batch, table, ("http_route", "window_start"), "period", "parquet", f"{folder}/staging/{attempt}"
        )
    return spark.table(table).drop("period")


def _from_sketches(*span: str) -> Query:
    """Metrics of longer windows from a table of minute rows, and whether each percentile's rank is within the bound."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = tables.ROUTE_SKETCHES_1M
        database = _database(spark, _scratch(spark))
        tables.ensure_tables(spark, database, wanted=[table])
        logs = _logs(spark, sf_dir).drop("event_id")
        sinks.append_batch(sketches.minute_sketches(logs), database, table, 0, "q")
        found = sketches.metrics_from_sketches(tables.read_table(spark, database, table), span)
        found = sketches.rank_errors(found, logs, span)
        names = [f"p{level}" for level in (50, 95, 99)]
        within = [(F.col(f"{n}_rank_error") <= RANK_ERROR).alias(f"{n}_within_bound") for n in names]
        exact = [c for c in found.columns if not c.startswith(tuple(names))]
        return found.select(*exact, *within)

    return run


def _minute_tables(spark: SparkSession, sf_dir: str) -> str:
    folder = _scratch(spark)
    database = _database(spark, folder)
    tables.ensure_tables(spark, database)

    def start(logs: DataFrame) -> StreamingQuery:
        logs = job.with_event_time_limit(logs, WATERMARK)
        return job.write_minute_metrics_and_alerts(logs, database, 500, f"{folder}/checkpoint", ONCE)

    _streamed(spark, sf_dir, folder, start)
    return database


def _stream_metrics_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _minute_tables(spark, sf_dir)
    return tables.read_table(spark, database, tables.ROUTE_METRICS_1M).drop("processing_time")


def _stream_landed_metrics_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute metrics from payloads that one stream decodes into the landing table and another one reads, in two runs."""
    folder = _scratch(spark)
    database = _database(spark, folder)
    tables.ensure_tables(spark, database)
    tables.ensure_tables(spark, database, wanted=[tables.ACCESS_LOGS])
    events = fixture.read_events(spark, sf_dir)
    first = F.coalesce(fixture.first_half(events), F.lit(True))
    for part in (first, ~first):
        payloads = fixture.logs_to_messages(fixture.events_to_logs(events.where(part), False))
        payloads.select("value").write.mode("append").text(f"{folder}/payloads")
        logs = reader.read_access_logs_stream(spark, "text", f"{folder}/payloads")
        job.write_landing(logs, database, "parquet", f"{folder}/landing", ONCE).awaitTermination()
        landed = job.with_event_time_limit(job.landed_logs(spark, database), WATERMARK)
        job.write_minute_metrics_and_alerts(landed, database, 500, f"{folder}/checkpoint", ONCE).awaitTermination()
    return tables.read_table(spark, database, tables.ROUTE_METRICS_1M).drop("processing_time")


def _stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _minute_tables(spark, sf_dir)
    return tables.read_table(spark, database, tables.LATENCY_ALERTS_TABLE).drop("alert_time")


def _stream_metrics_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark)
    database = _database(spark, folder)
    tables.ensure_tables(spark, database)

    def start(logs: DataFrame) -> StreamingQuery:
        return job.write_rolling_metrics(job.with_event_time_limit(logs, WATERMARK), database, f"{folder}/checkpoint", ONCE)

    _streamed(spark, sf_dir, folder, start)
    return tables.read_table(spark, database, tables.ROUTE_METRICS_5M).drop("processing_time")


def _stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark)
    database = _database(spark, folder)
    tables.ensure_tables(spark, database)
    _streamed(
        spark, sf_dir, folder, lambda logs: job.write_error_events(logs, database, "parquet", f"{folder}/checkpoint", ONCE)
    )
    return tables.read_table(spark, database, tables.ERROR_EVENTS_TABLE).drop("processing_time")


def _stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _scratch(spark)
    database = _database(spark, folder)
    tables.ensure_tables(spark, database, wanted=client_sessions.SESSION_TABLES)

    def start(logs: DataFrame) -> StreamingQuery:
        logs = job.with_event_time_limit(logs, WATERMARK)
        visits, bounds = client_sessions.write_sessions(logs, SESSION_GAP, database, "parquet", f"{folder}/checkpoint", ONCE)
        visits.awaitTermination()
        return bounds

    _streamed(spark, sf_dir, folder, start)
    return client_sessions.read_sessions(spark, database, SESSION_GAP)


def _result_tables(spark: SparkSession, sf_dir: str, *wanted: tables.ResultTable) -> str:
    """The wanted result tables from the whole table, the minute tables in three micro-batches."""
    database = _database(spark, _scratch(spark))
    tables.ensure_tables(spark, database)
    logs, now = _logs(spark, sf_dir).drop("event_id"), F.current_timestamp()
    if tables.ERROR_EVENTS_TABLE in wanted:
        rows = tables.ERROR_EVENTS_TABLE.rows(errors.error_events(logs).withColumn("processing_time", now))
        rows.write.insertInto(f"`{database}`.`{tables.ERROR_EVENTS_TABLE.name}`")
    if tables.ROUTE_METRICS_5M in wanted:
        rows = metrics.route_metrics_5m(logs).withColumn("processing_time", now)
        sinks.append_batch(rows, database, tables.ROUTE_METRICS_5M, 0, "q")
    minutes = metrics.route_metrics_1m(logs)
    for batch in range(3):
        part = minutes.where(F.minute("window_start") % 3 == batch)
        if tables.ROUTE_METRICS_1M in wanted:
            sinks.append_batch(part.withColumn("processing_time", now), database, tables.ROUTE_METRICS_1M, batch, "q")
        if tables.LATENCY_ALERTS_TABLE in wanted:
            alerted = alerts.latency_alerts(part, 500).withColumn("alert_time", now)
            sinks.append_batch(alerted, database, tables.LATENCY_ALERTS_TABLE, batch, "q")
    return database


def _folded_metrics_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute table with its days folded twice: a part is repeated and another one comes late in between."""
    table = tables.ROUTE_METRICS_1M
    database = _result_tables(spark, sf_dir, table)
    folding.fold_closed_days(spark, database, [table], before=date(2100, 1, 1))
    late = metrics.route_metrics_1m(_logs(spark, sf_dir).drop("event_id")).where(F.minute("window_start") % 3 == 1)
    late = late.withColumn("processing_time", F.current_timestamp())
    sinks.append_batch(late, database, table, 1, "q")
    sinks.append_batch(late.withColumn("http_route", F.concat("http_route", F.lit(" (late)"))), database, table, 7, "q")
    folding.fold_closed_days(spark, database, [table], before=date(2100, 1, 1))
    folding.drop_folded(spark, database, [table], now=datetime.now(timezone.utc) + timedelta(days=2))
    return tables.read_table(spark, database, table).drop("processing_time")


def _table_report(table: tables.ResultTable, report: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(spark, _result_tables(spark, sf_dir, table))


def _stream_view(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _scratch(spark)
        database = _database(spark, folder)

        def start(logs: DataFrame) -> StreamingQuery:
            return start_view(logs, database, name, "parquet", f"{folder}/checkpoint", ONCE)

        _streamed(spark, sf_dir, folder, start, default_route=False, in_time=False)
        return read_view(spark, database, name)

    return run


def _sql_over_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register_views(_sql_logs(spark, sf_dir), prefix="view_")
    return spark.sql("SELECT * FROM view_route_metrics_1m")


QUERIES: dict[str, Query] = {
    "route_metrics_1m": _from_logs(metrics.route_metrics_1m),
    "route_metrics_5m": _from_logs(metrics.route_metrics_5m),
    "error_events": _from_logs(errors.error_events),
    "latency_alerts": _from_logs(_alerts),
    "alert_exceedance": _from_logs(lambda logs: alerts.alert_exceedance(_alerts(logs))),
    "route_throughput": _from_logs(lambda logs: metrics.route_throughput(metrics.route_metrics_1m(logs))),
    "status_category": _from_logs(metrics.status_categories),
    "session_metrics": _from_logs(lambda logs: sessions.session_metrics(logs, SESSION_GAP)),
    "mv_route_metrics_1m": _from_sql_logs(metrics.sql_route_metrics_1m),
    "mv_route_metrics_1m_pct": _from_sql_logs(metrics.sql_route_metrics_1m_pct),
    "mv_route_metrics_5m": _from_sql_logs(metrics.sql_route_metrics_5m),
    "mv_error_events": _from_sql_logs(errors.sql_error_events),
    "mv_latency_alerts": _from_sql_logs(alerts.sql_latency_alerts),
    "mv_route_summary": _from_sql_logs(activity.route_summary),
    "mv_hostname_traffic": _from_sql_logs(activity.hostname_traffic),
    "mv_client_activity": _from_sql_logs(activity.client_activity),
    "sql_route_metrics_1m_view": _sql_over_view,
    "error_trend_hourly": _from_logs(lambda logs: reports.error_trend_hourly(metrics.route_metrics_1m(logs))),
    "route_rate_last_hour": _from_logs(
        lambda logs: reports.route_rate_last_hour(metrics.route_metrics_1m(logs), _as_of())
    ),
    "recent_alerts": _from_sql_logs(
        lambda logs: reports.recent_alerts(alerts.sql_latency_alerts(logs), _as_of())
    ),
    "error_rate_trend": _from_logs(lambda logs: reports.error_rate_trend(metrics.route_metrics_5m(logs))),
    "latest_metrics": _from_sql_logs(lambda logs: reports.latest_metrics(metrics.sql_route_metrics_1m(logs))),
    "latest_errors": _from_sql_logs(lambda logs: reports.latest_errors(errors.sql_error_events(logs))),
    "ingest_clean": lambda spark, sf_dir: decode.decode_messages(fixture.damaged_messages(spark, sf_dir)),
    "ingest_rejects": lambda spark, sf_dir: decode.rejected_messages(fixture.damaged_messages(spark, sf_dir)),
    "replay_all": _decoded(lambda m: replay.replay(m, "all")),
    "replay_last": _decoded(lambda m: replay.replay(m, "last")),
    "replay_last_per_subject": _decoded(lambda m: replay.replay(m, "last_per_subject")),
    "replay_new": _decoded(lambda m: replay.replay(m, "new", seq_at_start=900)),
    "replay_from_sequence": _decoded(lambda m: replay.replay(m, "all", last_processed=250)),
    "replay_from_time": lambda spark, sf_dir: replay.replay_from_time(
        decode.decode_messages(fixture.messages(spark, sf_dir)), F.lit("2024-01-01 00:20:00").cast("timestamp")
    ),
    "sketch_route_metrics_5m": _from_sketches("5 minutes", "1 minute"),
    "sketch_route_metrics_1h": _from_sketches("1 hour"),
    "upsert_route_metrics": _upserted,
    "folded_route_metrics_1m": _folded_metrics_1m,
    "table_route_rate_last_hour": _table_report(
        tables.ROUTE_METRICS_1M, lambda spark, database: table_reports.route_rate_last_hour(spark, database, AS_OF)
    ),
    "table_recent_alerts": _table_report(
        tables.LATENCY_ALERTS_TABLE,
        lambda spark, database: table_reports.recent_alerts(spark, database, AS_OF).drop("alert_time"),
    ),
    "table_error_trend_hourly": _table_report(
        tables.ROUTE_METRICS_1M, lambda spark, database: table_reports.error_trend_hourly(spark, database, until=AS_OF)
    ),
    "table_error_rate_trend": _table_report(
        tables.ROUTE_METRICS_5M, lambda spark, database: table_reports.error_rate_trend(spark, database, since=AS_OF - timedelta(minutes=45))
    ),
    "table_latest_metrics": _table_report(
        tables.ROUTE_METRICS_1M,
        lambda spark, database: table_reports.latest_metrics(spark, database).drop("processing_time"),
    ),
    "table_latest_errors": _table_report(
        tables.ERROR_EVENTS_TABLE,
        lambda spark, database: table_reports.latest_errors(spark, database).drop("processing_time"),
    ),
    "stream_route_metrics_1m": _stream_metrics_1m,
    "stream_route_metrics_5m": _stream_metrics_5m,
    "stream_error_events": _stream_errors,
    "stream_latency_alerts": _stream_alerts,
    "stream_landed_route_metrics_1m": _stream_landed_metrics_1m,
    "stream_session_metrics": _stream_sessions,
    "stream_hostname_traffic": _stream_view("hostname_traffic"),
    "stream_client_activity": _stream_view("client_activity"),
    "stream_route_summary": _stream_view("route_summary"),
    "stream_mv_route_metrics_1m": _stream_view("route_metrics_1m"),
    "stream_mv_route_metrics_1m_pct": _stream_view("route_metrics_1m_pct"),
    "stream_mv_route_metrics_5m": _stream_view("route_metrics_5m"),
    "stream_mv_error_events": _stream_view("error_events"),
    "stream_mv_latency_alerts": _stream_view("latency_alerts"),
}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key, value in SESSION_CONFS.items():
            spark.conf.set(key, value)
        return _comparable(query(spark, sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Metrics per route and minute at the smallest scale."""
    return queries()["route_metrics_1m"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every implemented operator by name."""
    found = {name: _registered(query) for name, query in QUERIES.items()}
    if llm_queries is not None:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the same tables."""
    return oracle_queries() | (llm_queries.ORACLE_SQL if llm_queries is not None else {})
