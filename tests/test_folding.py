"""Days of the result tables folded into one unit: the same rows at every step, also of folds that are cut short."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from routelens.operators.metrics import route_metrics_1m
from routelens.streaming import folding, tables
from routelens.streaming.folding import FOLDED, FoldConflict, TableFolder, drop_folded, fold_closed_days, fold_day
from routelens.streaming.sinks import append_batch
from routelens.streaming.tables import RESULT_TABLES, ROUTE_METRICS_1M, read_table
from tests.conftest import NOON, collect, log

DAY = NOON.date()
NEXT = DAY + timedelta(days=1)
LATER = datetime.now(timezone.utc) + timedelta(days=30)


@pytest.fixture
def metrics(spark, database):
    tables.ensure_tables(spark, database)
    return Metrics(spark, database)


class Metrics:
    def __init__(self, spark, database):
        self.spark, self.database = spark, database
        self.expected = {}

    def write(self, batch, at, query="q1", routes=("a", "b")):
        """One micro-batch with a window for each route, ``at`` seconds after noon."""
        from routelens.schemas import ACCESS_LOG

        rows = [log(at + i, route=r) for r in routes for i in range(2)]
        frame = route_metrics_1m(self.spark.createDataFrame(rows, ACCESS_LOG)).withColumn("processing_time", F.current_timestamp())
        append_batch(frame, self.database, ROUTE_METRICS_1M, batch, query)
        self.expected[query, batch] = {(r, int(at // 60 * 60)) for r in routes}

    def read(self, **bounds):
        rows = collect(read_table(self.spark, self.database, ROUTE_METRICS_1M, **bounds))
        found = [(r["http_route"], int((r["window_start"] - NOON).total_seconds())) for r in rows]
        assert len(found) == len(set(found)) and all(r["request_count"] == 2 for r in rows)
        return set(found)

    def same(self):
        return self.read() == set().union(*self.expected.values())

    def fold(self, day=DAY):
        return fold_day(self.spark, self.database, ROUTE_METRICS_1M, day)

    def drop(self, now=LATER):
        return drop_folded(self.spark, self.database, RESULT_TABLES, now)

    @property
    def folder(self):
        return TableFolder.of(self.spark, f"`{self.database}`.`route_metrics_1m`", "window_date")

    def parts(self, day=DAY):
        return self.folder.parts(day).get(day, set())


@pytest.fixture
def three_batches(metrics):
    for batch in range(3):
        metrics.write(batch, batch * 60)
    metrics.write(0, 240, query="q2")
    metrics.write(3, 86400)
    return metrics


def test_a_folded_day_is_one_unit_with_the_same_rows(three_batches):
    table = three_batches
    before = read_table(table.spark, table.database, ROUTE_METRICS_1M)
    assert table.fold() and table.same() and not table.fold()
    assert before.count() == 10  # a reader that listed the old parts still finds them
    assert table.drop(now=datetime.now(timezone.utc)) == 0 and len(table.parts()) == 5
    assert table.drop() == 4 and table.same() and table.drop() == 0
    ((name, generation),) = table.parts()
    assert name.startswith(FOLDED) and generation == 1 and len(table.parts(NEXT)) == 1
    files = table.folder._listed(f"window_date={DAY}", "*", "*", "*.parquet")
    assert len(files) == 1
    assert not table.fold(NEXT) and not table.fold(date(2000, 1, 1))


def test_a_late_and_a_repeated_batch_after_the_fold(three_batches):
    table = three_batches
    table.fold()
    table.write(9, 600)
    table.write(1, 60)  # repeated: its part is in the generation
    assert table.same()
    table.drop()
    table.write(1, 60)
    assert table.same() and ("q1", 1) in table.parts()
    assert table.fold() and table.same()
    assert table.folder.record(DAY).generation == 2
    table.drop()
    assert table.same() and [g for _, g in table.parts()] == [2]
    assert len(table.folder.record_files(DAY)[DAY]) == 1


def test_a_fold_that_is_cut_short_changes_nothing(three_batches, monkeypatch):
    table = three_batches

    def cut(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(TableFolder, "publish", cut)
        with pytest.raises(RuntimeError):
            table.fold()
    assert len(table.parts()) == 5 and table.same() and table.drop() == 0
    assert table.fold() and table.same()
    assert table.drop() == 5 and table.same()


def test_of_two_folds_one_is_published(three_batches, monkeypatch):
    table = three_batches
    publish = TableFolder.publish

    def overtaken(folder, day, record):
        publish(folder, day, folding.Record(record.generation, "folded-other", {}))
        publish(folder, day, record)

    monkeypatch.setattr(TableFolder, "publish", overtaken)
    with pytest.raises(FoldConflict):
        table.fold()
    assert table.folder.record(DAY).name == "folded-other"
    assert not table.folder._listed("_days", "_draft*")


def test_closed_days_of_all_tables(three_batches):
    table = three_batches
    table.write(5, 86460)
    folded = fold_closed_days(table.spark, table.database, RESULT_TABLES, before=NEXT)
    assert folded == [("route_metrics_1m", DAY)] and table.same()
    assert fold_closed_days(table.spark, table.database, RESULT_TABLES, NEXT + timedelta(days=1)) == [("route_metrics_1m", NEXT)]
    assert table.same()
    since = NOON + timedelta(days=1)
    assert table.read(since=since) == {(r, s) for r, s in table.read() if s >= 86400}
    assert table.read(until=since) == {(r, s) for r, s in table.read() if s < 86400}


def test_parts_left_out_are_not_opened(three_batches):
    table = three_batches
    table.fold()
    rows = read_table(table.spark, table.database, ROUTE_METRICS_1M)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "query_id" in plan[plan.index("PartitionFilters: [") : plan.index("PushedFilters")]
    opened = {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}
    assert len(opened) == 2 and sum(f"query_id={FOLDED}" in path for path in opened) == 1


def test_the_job_folds_past_days_when_it_starts(three_batches):
    from routelens.options import JobOptions
    from routelens.streaming.job import fold_past_days

    assert JobOptions.from_args(["--fold.closed.days", "true"]).fold_closed_days
    assert not JobOptions.from_args([]).fold_closed_days
    table = three_batches
    fold_past_days(table.spark, table.database)
    assert table.folder.record(DAY).generation == 1 and table.same()
