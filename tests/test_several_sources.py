"""Streams of two sources, one of them silent or behind."""

import pytest

from routelens.operators.metrics import route_metrics_1m
from routelens.schemas import ACCESS_LOG
from routelens.streaming import job
from tests.conftest import NOON, collect, log


@pytest.fixture
def closed(spark, tmp_path):
    """Feed rows to the sources ``a`` and ``b``, run, and return the requests of each closed minute so far."""
    for name in "ab":
        (tmp_path / name).mkdir()

    def run(wait, a=(), b=()):
        for name, rows in (("a", a), ("b", b)):
            if rows:
                frame = spark.createDataFrame(list(rows), ACCESS_LOG)
                frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        streams = [spark.readStream.schema(ACCESS_LOG).parquet(str(tmp_path / name)) for name in "ab"]
        frame = route_metrics_1m(job.with_event_time_limits(streams, "5 seconds", wait_for_idle=wait))
        out = str(tmp_path / "out")
        writer = frame.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        writer.outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
        rows = collect(spark.read.schema(frame.schema).parquet(out))
        return {int((r["window_start"] - NOON).total_seconds()): r["request_count"] for r in rows}

    return run


@pytest.mark.parametrize("wait, expected", [(False, {0: 1}), (True, {})])
def test_windows_close_beside_a_silent_source_unless_it_is_waited_for(closed, wait, expected):
    closed(wait, a=[log(1)])
    closed(wait, a=[log(100)])
    assert closed(wait, a=[log(101)]) == expected


@pytest.mark.parametrize("wait, expected", [(True, 2), (False, 1)])
def test_the_slower_source_is_late_only_if_it_is_not_waited_for(closed, wait, expected):
    closed(wait, a=[log(1000)], b=[log(2)])
    closed(wait, a=[log(1001, "other")], b=[log(30)])
    found = closed(wait, a=[log(3000)], b=[log(3000)])
    assert found[0] == expected and 960 in found
