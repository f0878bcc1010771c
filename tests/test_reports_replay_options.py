from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from routelens.operators import metrics
from routelens.operators.alerts import sql_latency_alerts
from routelens.options import JobOptions, catalog_confs, parse_args, storage_confs
from routelens.plans import reports, views
from routelens.sources import replay
from routelens.sources.reader import read_access_logs
from tests.conftest import NOON, collect, log

HOUR = 3600


@pytest.fixture
def hours(logs_of):
    rows = [log(h * HOUR + i, route=r, status=500 if i == 0 else 200, latency=100 * (h + 1))
            for h in range(3) for r in ("a", "b") for i in range(2 if r == "a" else 4)]
    return logs_of(*rows)


def test_route_rate_last_hour(hours):
    as_of = F.lit(NOON + timedelta(hours=2, minutes=1))
    found = collect(reports.route_rate_last_hour(metrics.route_metrics_1m(hours), as_of))
    assert [(r["http_route"], r["total_requests"], r["avg_latency"], r["max_p99"]) for r in found] == [
        ("b", 4, 300.0, 300.0), ("a", 2, 300.0, 300.0),
    ]
    assert reports.route_rate_last_hour(metrics.route_metrics_1m(hours)).count() == 0


def test_error_trend_hourly(hours):
    found = collect(reports.error_trend_hourly(metrics.route_metrics_1m(hours)))
    assert [r["hour"] - NOON for r in found[::2]] == [timedelta(hours=h) for h in (2, 1, 0)]
    assert all(r["total_errors"] == 1 for r in found)


def test_error_rate_trend(hours):
    found = collect(reports.error_rate_trend(metrics.route_metrics_5m(hours), 30.0))
    assert {r["http_route"] for r in found} == {"a"}
    ends = [r["window_end"] for r in found]
    assert ends == sorted(ends, reverse=True) and len(ends) == 15


def test_latest(hours):
    found = collect(reports.latest_metrics(metrics.sql_route_metrics_1m(hours), 3))
    assert [r["http_route"] for r in found] == ["a", "b", "a"]


def test_recent_alerts(logs_of):
    frame = logs_of(log(0, latency=900), log(2 * HOUR, latency=900))
    as_of = F.lit(NOON + timedelta(hours=2, minutes=30))
    assert reports.recent_alerts(sql_latency_alerts(frame), as_of).count() == 1


def test_sql_over_views(spark, hours):
    views.register_access_logs(hours)
    names = views.register_views(hours)
    assert set(names) == set(views.SQL_VIEWS)
    found = collect(spark.sql("""
        SELECT date_trunc('hour', window_end) AS hour, http_route,
            SUM(client_error_count + server_error_count) AS total_errors
        FROM route_metrics_1m GROUP BY 1, 2 ORDER BY 1 DESC, 3 DESC"""))
    assert len(found) == 6
    assert spark.sql("SELECT * FROM route_metrics_1m ORDER BY window_end DESC LIMIT 10").count() == 6
    assert spark.sql("SELECT * FROM error_events ORDER BY timestamp DESC LIMIT 20").count() == 6
    assert spark.sql("SELECT * FROM latency_alerts WHERE alerted_at > NOW() - INTERVAL '1 hour'").count() == 0
    assert spark.sql("SELECT max(timestamp) FROM access_logs").count() == 1


@pytest.fixture
def messages(spark):
    rows = [("s" + str(i % 3), i, f"v{i}") for i in range(1, 21)] + [(None, 21, "v21")]
    return spark.createDataFrame(rows, "subject STRING, seq BIGINT, value STRING")


def seqs(frame):
    return sorted(r["seq"] for r in frame.collect())


def test_replay(messages):
    assert seqs(replay.replay(messages, "all")) == list(range(1, 22))
    assert seqs(replay.replay(messages, "LAST")) == [21]
    assert seqs(replay.replay(messages, "last_per_subject")) == [18, 19, 20, 21]
    assert seqs(replay.replay(messages, "new", seq_at_start=19)) == [20, 21]
    assert seqs(replay.replay(messages, "no such policy")) == list(range(1, 22))


def test_resume_overrides_the_policy(messages):
    assert seqs(replay.replay(messages, "last", last_processed=18)) == [19, 20, 21]


@pytest.fixture
def broker_rows(spark):
    """Two partitions of one topic; subject b has a key, the others have none."""
    rows = [
        ("b" if offset % 2 else None, f'{{"http_route":"{partition}-{offset}"}}', "logs", partition, offset)
        for partition in (0, 1)
        for offset in range(4 + partition)
        if partition == 0 or offset % 2 == 0
    ]
    return spark.createDataFrame(rows, "key STRING, value STRING, topic STRING, partition INT, offset BIGINT").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic", "partition", "offset"
    )


def test_start_positions_in_broker_rows(broker_rows):
    messages = replay.from_broker(broker_rows)

    def found(frame):
        return sorted((r["partition"], r["seq"]) for r in frame.collect())

    assert found(replay.replay(messages, "last")) == [("logs-0", 3), ("logs-1", 4)]
    assert found(replay.replay(messages, "last_per_subject")) == [("logs-0", 2), ("logs-0", 3), ("logs-1", 4)]
    assert found(replay.replay(messages, "new", seq_at_start={"logs-0": 2, "logs-1": 9})) == [("logs-0", 3)]
    assert found(replay.replay(messages, "last", last_processed={"logs-0": 3})) == [("logs-1", s) for s in (0, 2, 4)]
    assert messages.where("subject = 'b'").count() == 2
    with pytest.raises(ValueError):
        replay.replay(messages, "new", seq_at_start=2)


def test_reader_takes_a_start_position(spark, messages, tmp_path):
    path = str(tmp_path / "messages")
    messages.withColumn("value", F.format_string('{"http_route":"%s"}', "value")).write.parquet(path)
    routes = [r["http_route"] for r in read_access_logs(spark, "parquet", path, policy="last").collect()]
    assert routes == ["v21"]
    assert read_access_logs(spark, "parquet", path, policy="new", seq_at_start=19).count() == 2
    assert read_access_logs(spark, "parquet", path, last_processed=18).count() == 3
    assert read_access_logs(spark, "parquet", path).count() == 21


def test_replay_from_time(logs_of):
    frame = logs_of(log(0), log(5), log(10))
    assert replay.replay_from_time(frame, F.lit(NOON + timedelta(seconds=5))).count() == 2


def test_parse_args():
    args = ["stray", "--a", "1", "--b=2", "--c=x=y", "--flag", "--d", "4", "ignored", "--end"]
    assert parse_args(args) == {"a": "1", "b": "2", "c": "x=y", "d": "4"}


def test_job_options():
    options = JobOptions.from_args(
        ["--latency.threshold.ms=250", "--parallelism", "4", "--deliver.policy", "ALL", "--database", "d",
         "--source.path", "/in", "--source.option.maxFilesPerTrigger", "3", "--available.now=true", "--x=1"],
        env={},
    )
    assert (options.latency_threshold_ms, options.parallelism, options.database) == (250, 4, "d")
    assert options.source_options == {"maxFilesPerTrigger": "3"} and options.available_now
    assert options.confs["spark.sql.shuffle.partitions"] == "4"
    defaults = JobOptions.from_args([], env={})
    assert (defaults.latency_threshold_ms, defaults.watermark, defaults.trigger_interval) == (
        500, "5 seconds", "60 seconds",
    )


def test_start_position_of_a_stream():
    broker = ["--source.format=kafka"]
    assert JobOptions.from_args(broker, {}).start_options() == {"startingOffsets": "earliest"}
    assert JobOptions.from_args([*broker, "--deliver.policy=new"], {}).start_options() == {
        "startingOffsets": "latest"
    }
    for policy in ("last", "last_per_subject", "new"):
        with pytest.raises(ValueError):
            JobOptions.from_args([f"--deliver.policy={policy}"], {}).start_options()


def test_storage_confs():
    env = {"S3_ENDPOINT": "http://env", "AWS_REGION": "eu"}
    found = storage_confs({"s3.access.key": "k", "s3.endpoint": ""}, env)
    assert found == {
        "spark.hadoop.fs.s3a.endpoint": "http://env",
        "spark.hadoop.fs.s3a.access.key": "k",
        "spark.hadoop.fs.s3a.endpoint.region": "eu",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }


def test_catalog_confs():
    assert catalog_confs({}) == {}
    found = catalog_confs({"catalog.name": "lake", "catalog.uri": "u", "catalog.conf.io-impl": "x"})
    assert found["spark.sql.catalog.lake.uri"] == "u" and found["spark.sql.catalog.lake.io-impl"] == "x"
