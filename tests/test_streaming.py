"""Streams are fed file by file: one call of ``feed`` is one micro-batch."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from routelens.operators.errors import error_events
from routelens.operators.metrics import route_metrics_1m, route_metrics_5m
from routelens.operators.sessions import session_metrics
from routelens.options import JobOptions
from routelens.plans.views import SQL_VIEWS, register_access_logs
from routelens.schemas import ACCESS_LOG
from routelens.streaming import job, sinks, tables
from routelens.streaming.late_rows import LateRowLog, late_rows
from routelens.streaming.views import STREAM_VIEWS, read_view, start_view
from tests.conftest import NOON, collect, log

ONCE = {"availableNow": True}
GAP = timedelta(seconds=20)


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.batches = spark, folder, 0

    def add(self, *rows):
        self.batches += 1
        frame = self.spark.createDataFrame(list(rows), ACCESS_LOG)
        frame.coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self, delay=None):
        source = self.spark.readStream.schema(ACCESS_LOG).option("maxFilesPerTrigger", 1)
        logs = source.parquet(self.folder)
        return job.with_event_time_limit(logs, delay) if delay else logs


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path / "input"))


@pytest.fixture
def drain(spark, tmp_path):
    """Run an append query over what has arrived and return everything it has emitted."""

    def run(frame, name="query"):
        out, checkpoint = str(tmp_path / name / "out"), str(tmp_path / name / "checkpoint")
        writer = frame.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query = writer.outputMode("append").trigger(**ONCE).start(out)
        query.awaitTermination()
        run.query = query
        return collect(spark.read.schema(frame.schema).parquet(out))

    return run


def counts(rows):
    return {(r["http_route"], int((r["window_start"] - NOON).total_seconds())): r["request_count"] for r in rows}


def test_window_is_emitted_once_and_late_rows_are_dropped(feed, drain):
    feed.add(log(1), log(2))
    assert drain(route_metrics_1m(feed.stream("5 seconds"))) == []
    feed.add(log(64))
    assert drain(route_metrics_1m(feed.stream("5 seconds"))) == []
    feed.add(log(3), log(65))
    assert counts(drain(route_metrics_1m(feed.stream("5 seconds")))) == {("catalog", 0): 3}
    feed.add(log(4), log(130))
    assert counts(drain(route_metrics_1m(feed.stream("5 seconds")))) == {("catalog", 0): 3, ("catalog", 60): 2}
    assert job.dropped_late_rows(drain.query) == 1


def test_late_rows_are_counted_over_more_triggers_than_are_remembered(spark, feed, database, tmp_path):
    folder, checkpoint = f"{tmp_path}/late", f"{tmp_path}/checkpoint"
    assert late_rows(spark, folder).count() == 0
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    tables.ensure_tables(spark, database)
    log_of_late = LateRowLog(spark, folder)
    spark.streams.addListener(log_of_late)
    remembered = []
    try:
        for run in range(2):  # the second one resumes from the checkpoint of the first
            feed.add(log(1000 * (run + 1)))
            for i in range(5):
                feed.add(log(i, f"late{i}"), log(3 + i, f"later{i}"), log(1000 * (run + 1) + 1 + i))
            query = job.write_minute_metrics_and_alerts(feed.stream("5 seconds"), database, 500, checkpoint, {"availableNow": True})
            query.awaitTermination()
            log_of_late.finish(query)
            remembered.append(job.dropped_late_rows(query))
    finally:
        spark.streams.removeListener(log_of_late)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    rows = collect(late_rows(spark, folder), "batch_id")
    assert {r["query_id"] for r in rows} == {str(query.id)} and {r["name"] for r in rows} == {"route_metrics_1m"}
    assert len({r["batch_id"] for r in rows}) == len(rows) > 2
    on_time = collect(spark.table(f"{database}.route_metrics_1m"))
    # Two in each of ten files, but for the second file: the watermark of the batch before it is not yet past them.
    assert sum(r["dropped"] for r in rows) == 18 > sum(remembered)
    assert {r["http_route"] for r in on_time} == {"late0", "later0", "catalog"}
    log_of_late.finish(query)  # again: nothing is counted twice
    assert late_rows(spark, folder).selectExpr("sum(dropped)").first()[0] == 18


def test_row_late_for_its_minute_still_counts_in_open_rolling_windows(feed, drain):
    feed.add(log(1))
    feed.add(log(90))
    feed.add(log(91))
    feed.add(log(2))
    feed.add(log(1000))
    found = counts(drain(route_metrics_5m(feed.stream("5 seconds"))))
    assert found["catalog", -240] == 1
    assert found["catalog", -180] == 4
    assert found["catalog", 0] == 4
    assert found["catalog", 60] == 2


def test_errors_keep_late_rows(feed, drain):
    feed.add(log(1000, status=500))
    feed.add(log(1, status=404), log(2))
    found = drain(error_events(feed.stream("5 seconds")))
    assert sorted(r["status_code"] for r in found) == [404, 500]


@pytest.mark.parametrize("build", [route_metrics_1m, route_metrics_5m])
def test_closed_windows_equal_batch(spark, feed, drain, build):
    for start in range(0, 600, 60):
        feed.add(*[
            log(start + i, f"r{i % 3}", (200, 404, 503)[i % 3], (start * 7 + i * 13) % 400) for i in range(60)
        ])
    found = drain(build(feed.stream("5 seconds")))
    limit = NOON + timedelta(seconds=599 - 5)
    batch = collect(build(spark.read.schema(ACCESS_LOG).parquet(feed.folder)))

    def comparable(rows):
        return sorted(tuple((k, round(v, 6) if isinstance(v, float) else v) for k, v in r.items()) for r in rows)

    assert comparable(found) == comparable(r for r in batch if r["window_end"] <= limit)


def test_closed_sessions_equal_batch(spark, feed, drain):
    feed.add(log(0), log(15, path="/x"), log(0, client_ip=None, path=None))
    feed.add(log(30), log(60, status=500), log(5, client_ip=None))
    feed.add(log(300))
    found = drain(session_metrics(feed.stream("5 seconds"), GAP))
    batch = collect(session_metrics(spark.read.schema(ACCESS_LOG).parquet(feed.folder), GAP))

    def key(row):
        return (row["client_ip"] or "", row["session_start"])

    closed = [r for r in batch if r["session_start"] < NOON + timedelta(seconds=300)]
    assert sorted(found, key=key) == sorted(closed, key=key)
    assert len(found) == 3


@pytest.fixture
def job_of(spark, tmp_path):
    def build(database, **options):
        return JobOptions(
            database=database, available_now=True, checkpoint_dir=str(tmp_path / "checkpoints"), **options
        )

    return build


def finish(queries):
    for query in queries:
        query.awaitTermination()


def message(row):
    fields = {k: v for k, v in row.items() if k != "event_time"}
    return json.dumps({"timestamp": row["event_time"].isoformat().replace("+00:00", "Z"), **fields})


def test_job_from_json_lines(spark, database, job_of, tmp_path):
    product = [log(i, status=200 if i < 8 else 500, latency=50 + 10 * i) for i in range(10)]
    checkout = [log(2 * i, route="checkout", latency=900 + 20 * i) for i in range(5)]
    lines = [message(r) for r in (*product, *checkout, log(1000))] + ["not valid json", "", "[]"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "part-0").write_text("\n".join(lines) + "\n")

    finish(job.start_job(spark, job_of(database, source_path=str(folder))))

    metrics = {r["http_route"]: r for r in collect(tables.read_table(spark, database, tables.ROUTE_METRICS_1M))}
    assert set(metrics) == {"catalog", "checkout"}
    assert metrics["catalog"]["request_count"] == 10
    assert metrics["catalog"]["error_rate_pct"] == 20
    assert metrics["catalog"]["processing_time"] is not None
    rolling = collect(tables.read_table(spark, database, tables.ROUTE_METRICS_5M))
    assert len(rolling) == 10
    errors = collect(tables.read_table(spark, database, tables.ERROR_EVENTS_TABLE))
    assert [r["error_category"] for r in errors] == ["SERVER_ERROR"] * 2
    (alert,) = collect(tables.read_table(spark, database, tables.LATENCY_ALERTS_TABLE))
    assert (alert["http_route"], alert["severity"], alert["threshold_ms"]) == ("checkout", "MEDIUM", 500)
    for table in tables.RESULT_TABLES:
        frame = tables.read_table(spark, database, table)
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in table.schema]


def test_job_resumes_from_its_checkpoints(spark, database, job_of, feed):
    feed.add(log(1, latency=600, status=500), log(2))
    finish(job.start_queries(spark, feed.stream(), job_of(database)))
    feed.add(log(3), log(70, status=404))
    finish(job.start_queries(spark, feed.stream(), job_of(database)))
    feed.add(log(200))
    finish(job.start_queries(spark, feed.stream(), job_of(database)))
    finish(job.start_queries(spark, feed.stream(), job_of(database)))
    assert counts(collect(tables.read_table(spark, database, tables.ROUTE_METRICS_1M))) == {
        ("catalog", 0): 3, ("catalog", 60): 1,
    }
    assert tables.read_table(spark, database, tables.LATENCY_ALERTS_TABLE).count() == 1
    assert tables.read_table(spark, database, tables.ERROR_EVENTS_TABLE).count() == 2


def test_one_file_per_small_batch(spark, database, job_of, feed):
    feed.add(*[log(i, route=f"r{i}", latency=900) for i in range(40)])
    feed.add(log(200))
    finish(job.start_queries(spark, feed.stream(), job_of(database)))
    for table in (tables.ROUTE_METRICS_1M, tables.LATENCY_ALERTS_TABLE):
        frame = tables.read_table(spark, database, table)
        assert frame.count() == 40
        assert len(frame.inputFiles()) == 1
    rolling = tables.read_table(spark, database, tables.ROUTE_METRICS_5M)
    assert rolling.count() == 120 and len(rolling.inputFiles()) == 1


def test_tables_are_created_once(spark, database):
    tables.ensure_tables(spark, database)
    tables.ensure_tables(spark, database)
    found = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").collect()
    assert {r.tableName for r in found} == {
        "route_metrics_1m", "route_metrics_5m", "error_events", "latency_alerts",
    }


def test_repeated_batch_replaces_itself(spark, database, logs_of):
    tables.ensure_tables(spark, database)

    def write(batch_id, *rows):
        frame = route_metrics_1m(logs_of(*rows)).withColumn("processing_time", F.current_timestamp())
        sinks.append_batch(frame, database, tables.ROUTE_METRICS_1M, batch_id, "q")

    write(1, log(0), log(90000))
    write(2, log(60))
    write(2, log(60))
    write(3)
    found = tables.read_table(spark, database, tables.ROUTE_METRICS_1M)
    assert sorted(counts(collect(found))) == [("catalog", 0), ("catalog", 60), ("catalog", 90000)]
    assert found.count() == 3


def test_a_new_checkpoint_keeps_earlier_results(spark, database, tmp_path):
    for number, route in enumerate(("a", "b")):
        folder = tmp_path / f"in{number}"
        folder.mkdir()
        rows = [log(60 * number, route=route, latency=900), log(1000, route=route)]
        (folder / "part-0").write_text("\n".join(map(message, rows)) + "\n")
        options = JobOptions(
            database=database, available_now=True, checkpoint_dir=str(tmp_path / f"c{number}"), source_path=str(folder)
        )
        finish(job.start_job(spark, options))
    for table in (tables.ROUTE_METRICS_1M, tables.ROUTE_METRICS_5M, tables.LATENCY_ALERTS_TABLE):
        assert {r["http_route"] for r in collect(tables.read_table(spark, database, table))} == {"a", "b"}
    late = tables.read_table(spark, database, tables.ROUTE_METRICS_1M, since=NOON + timedelta(days=1))
    assert late.count() == 0
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan


KEYS = ("http_route", "window_start")


@pytest.fixture
def upsert(spark, database, tmp_path):
    table = f"{database}.kept"
    schema = "http_route STRING, window_start BIGINT, request_count BIGINT, period STRING"
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet PARTITIONED BY (period)")

    def run(*rows, batch=0):
        frame = spark.createDataFrame([(*r, f"p{r[1] // 10}") for r in rows], schema)
        sinks.upsert_batch(frame, table, KEYS, "period", "parquet", f"{tmp_path}/staging/{batch}")
        spark.catalog.refreshTable(table)
        return sorted((tuple(r)[:3] for r in spark.table(table).collect()), key=str)

    run.staging = f"{tmp_path}/staging"
    run.schema = schema
    run.table = table
    return run


def test_upsert_replaces_and_adds(upsert):
    assert upsert(("a", 1, 5), (None, 1, 6), ("a", 11, 7)) == [("a", 1, 5), ("a", 11, 7), (None, 1, 6)]
    assert upsert(("a", 1, 50), (None, 1, 60), ("b", 2, 8)) == [
        ("a", 1, 50), ("a", 11, 7), ("b", 2, 8), (None, 1, 60),
    ]
    again = upsert(("a", 1, 50), (None, 1, 60), ("b", 2, 8))
    assert again == [("a", 1, 50), ("a", 11, 7), ("b", 2, 8), (None, 1, 60)]
    assert upsert() == again


def test_upsert_reads_touched_partitions_only(spark, upsert):
    upsert(("a", 1, 5), ("b", 11, 6), ("c", 25, 7))
    existing = spark.table(upsert.table)
    touched = existing.where("period = 'p1'").select("period").distinct()
    touched.write.parquet(f"{upsert.staging}/touched")
    found = sinks.rows_of_partitions(existing, spark.read.parquet(f"{upsert.staging}/touched"), "period")
    assert [tuple(r)[:3] for r in found.collect()] == [("b", 11, 6)]
    assert "dynamicpruning" in found._jdf.queryExecution().toString().lower()


def test_interrupted_upsert_publishes_what_it_staged(spark, upsert):
    upsert(("a", 1, 5), ("b", 2, 6))
    staged = spark.createDataFrame([("a", 1, 50, "p0"), ("b", 2, 6, "p0")], upsert.schema)
    staged.write.parquet(f"{upsert.staging}/7")
    assert upsert(("a", 1, 50), batch=7) == [("a", 1, 50), ("b", 2, 6)]


def run_view(feed, database, name, tmp_path):
    start_view(
        feed.stream(), database, name, "parquet", str(tmp_path / "views" / name), ONCE
    ).awaitTermination()
    return collect(read_view(feed.spark, database, name))


def test_alert_view_loses_a_row_that_no_longer_qualifies(feed, database, tmp_path):
    feed.add(log(0, latency=900), log(70, latency=900))
    assert len(run_view(feed, database, "latency_alerts", tmp_path)) == 2
    feed.add(*[log(1, latency=1) for _ in range(200)])
    (row,) = run_view(feed, database, "latency_alerts", tmp_path)
    assert row["window_start"] == NOON + timedelta(seconds=60)


def test_views_follow_late_rows(feed, database, tmp_path):
    feed.add(log(0), log(4000))
    feed.add(log(1, status=500))
    found = counts(run_view(feed, database, "route_metrics_1m", tmp_path))
    assert found == {("catalog", 0): 2, ("catalog", 3960): 1}


def test_summary_view_is_revised(feed, database, tmp_path):
    feed.add(log(0), log(0, route="a"))
    run_view(feed, database, "route_summary", tmp_path)
    feed.add(log(10), log(5, route=None))
    found = {r["http_route"]: r for r in run_view(feed, database, "route_summary", tmp_path)}
    assert {k: r["total_requests"] for k, r in found.items()} == {"catalog": 2, "a": 1, None: 1}
    assert found["catalog"]["last_seen"] == NOON + timedelta(seconds=10)


def test_client_view_appears_when_the_client_becomes_active(feed, database, tmp_path):
    feed.add(*[log(i) for i in range(10)])
    assert run_view(feed, database, "client_activity", tmp_path) == []
    feed.add(log(11))
    (row,) = run_view(feed, database, "client_activity", tmp_path)
    assert (row["request_count"], row["routes_accessed"]) == (11, 1)


@pytest.mark.parametrize("name", ["route_metrics_1m_pct", "route_metrics_5m", "hostname_traffic", "client_activity"])
def test_views_over_cells_equal_batch_after_revisions(spark, feed, database, tmp_path, name):
    for part in range(3):
        feed.add(*[
            log(7 * i + part, ("a", "b", None)[i % 3], (200, 404, 503)[(i + part) % 3], None if i % 11 == 0 else (i * 37 + part) % 700)
            for i in range(120)
        ])
        found = run_view(feed, database, name, tmp_path)
    batch = SQL_VIEWS[name](spark.read.schema(ACCESS_LOG).parquet(feed.folder))

    def comparable(rows):
        return sorted(str({k: round(v, 6) if isinstance(v, float) else v for k, v in r.items()}) for r in rows)

    assert comparable(found) == comparable(collect(batch)) and (found or name == "client_activity")
    assert list(found[0] if found else batch.columns) == batch.columns


def test_state_of_the_views_is_counters():
    plain = {name for name, view in STREAM_VIEWS.items() if not view.measures}
    assert plain == {"route_metrics_1m", "error_events", "route_summary"}


def test_stream_as_a_sql_table(spark, feed, drain):
    feed.add(log(0, status=500), log(1))
    register_access_logs(feed.stream(), "access_log_stream")
    frame = spark.sql("SELECT timestamp, http_route FROM access_log_stream WHERE status_code >= 400")
    assert frame.isStreaming
    assert drain(frame) == [{"timestamp": NOON, "http_route": "catalog"}]


def test_every_sql_view_can_be_streamed():
    assert set(STREAM_VIEWS) == set(SQL_VIEWS)


def test_complete_mode_equals_batch(spark, feed, tmp_path):
    feed.add(log(0, latency=5), log(61))
    feed.add(log(1, latency=9))
    frame = route_metrics_1m(feed.stream(), one_step=True)
    seen = str(tmp_path / "complete")
    writer = frame.writeStream.outputMode("complete").option("checkpointLocation", str(tmp_path / "c"))
    query = writer.trigger(**ONCE).foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(seen)).start()
    query.awaitTermination()
    assert counts(collect(spark.read.parquet(seen))) == {("catalog", 0): 2, ("catalog", 60): 1}


def test_checkpoint_folder_comes_from_the_session(spark):
    assert job.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert job.checkpoint_root(spark, "/given/") == "/given"
