"""Ways a stream reaches a table: append, append once per batch, and keyed upsert."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

if TYPE_CHECKING:
    from routelens.streaming.tables import ResultTable

# Formats whose tables take row-level changes.
MERGE_FORMATS = ("iceberg", "delta")

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

Trigger = dict


def append_stream(
    frame: DataFrame, database: str, table: ResultTable, table_format: str, checkpoint: str, trigger: Trigger
) -> StreamingQuery:
    """Append to a table. Files of a failed batch are never listed, so rows arrive once."""
    return (
        table.rows(frame)
        .writeStream.queryName(table.name)
        .outputMode("append")
        .format(table_format)
        .partitionBy(*table.partition_columns)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .toTable(f"`{database}`.`{table.name}`")
    )


@contextmanager
def batch_write_confs(spark: SparkSession) -> Iterator[None]:
    """Settings for the batch jobs of a micro-batch, put back afterwards.

    ``insertInto`` takes the overwrite mode from the session and ignores a writer option.
    A stream's session runs without adaptive execution because its state may not be
    repartitioned; writes behind the state may be, and ``rebalance`` needs it.
    """
    wanted = {OVERWRITE_MODE: "dynamic", "spark.sql.adaptive.enabled": "true"}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def replace_partitions(frame: DataFrame, table: str, by: str) -> None:
    """Overwrite the partitions ``frame`` has rows for and leave the others alone.

    Files are sized by ``rebalance``, so a quiet minute does not leave one file per
    shuffle partition and a busy one is still split.
    """
    with batch_write_confs(frame.sparkSession):
        frame.hint("rebalance", by).write.mode("overwrite").insertInto(table)


def query_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps for as long as its checkpoint, from the checkpoint's own metadata."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def append_batch(frame: DataFrame, database: str, table: ResultTable, batch_id: int, query_id: str) -> None:
    """Write one micro-batch as its own partitions; a repeat replaces them.

    Batch numbers start anew with every checkpoint, so the query's id is part of what is replaced.
    """
    rows = table.rows(frame).withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("bigint")})
    replace_partitions(rows, f"`{database}`.`{table.name}`", table.date_column)


def same_key(left: str, right: str, keys: Sequence[str]) -> str:
    """Null-safe equality of the key columns as a SQL condition."""
    return " AND ".join(f"{left}.`{k}` <=> {right}.`{k}`" for k in keys)


def _merge_into(rows: DataFrame, table: str, keys: Sequence[str]) -> None:
    rows.createOrReplaceTempView("upsert_rows")
    rows.sparkSession.sql(
        f"MERGE INTO {table} t USING upsert_rows s ON {same_key('t', 's', keys)} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def _staged(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows staged by an earlier, interrupted attempt, if that attempt finished staging."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(marker) else None


def _drop_staging(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def upsert_batch(
    rows: DataFrame,
    table: str,
    keys: Sequence[str],
    partition: str,
    table_format: str,
    staging: str,
) -> None:
    """Replace rows with the same key and add the others.

    A format with row-level changes gets a MERGE. For plain files only the partitions the
    batch touches are rewritten. Their new content is staged first and then published: if
    publishing is cut short, the repeated batch publishes the staged content again instead
    of reading a half-replaced partition.

    ``rows`` must hold each key once, and a key must never change its partition.
    """
    if table_format in MERGE_FORMATS:
        _merge_into(rows, table, keys)
        return
    spark = rows.sparkSession
    merged = _staged(spark, staging)
    if merged is None:
        with batch_write_confs(spark):
            if not _stage(rows, table, keys, partition, staging):
                return
        merged = spark.read.parquet(staging)
    merged = merged.select(*spark.table(table).columns)
    replace_partitions(merged, table, partition)
    _drop_staging(spark, staging)


def rows_of_partitions(existing: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """The rows of ``existing`` in the partitions that ``touched`` names.

    No value goes through the driver: the semi join prunes the scan while it runs. It does so
    only for a side with a filter, hence the comparison, which holds for every partition.
    """
    named = touched.where(F.col(partition).cast("string") >= F.lit(""))
    return existing.join(named, partition, "left_semi").select(*existing.columns)


def _stage(rows: DataFrame, table: str, keys: Sequence[str], partition: str, staging: str) -> bool:
    """Write the new content of every partition ``rows`` touches; False if there is none."""
    spark = rows.sparkSession
    existing = spark.table(table)
    # Used three times below; without this a stream would run its micro-batch three times.
    new = rows.select(*existing.columns).persist()
    periods = f"{staging}-touched"
    try:
        new.select(partition).distinct().write.mode("overwrite").parquet(periods)
        touched = spark.read.schema(new.select(partition).schema).parquet(periods)
        if touched.isEmpty():
            return False
        kept = rows_of_partitions(existing, touched, partition).alias("t")
        kept = kept.join(new.alias("s"), F.expr(same_key("t", "s", keys)), "left_anti")
        kept.unionByName(new).write.mode("overwrite").parquet(staging)
        return True
    finally:
        new.unpersist()
        _drop_staging(spark, periods)


def upsert_stream(
    frame: DataFrame,
    table: str,
    keys: Sequence[str],
    partition: str,
    table_format: str,
    checkpoint: str,
    trigger: Trigger,
    query_name: str | None = None,
) -> StreamingQuery:
    """Keep a table equal to an aggregation that is still being revised (update mode)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, table, keys, partition, table_format, f"{checkpoint}/staging/{batch_id}")

    writer = frame.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(**trigger).foreachBatch(write).start()
