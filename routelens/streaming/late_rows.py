"""Counts of rows that came too late, kept in a table for as long as one likes.

A query remembers the progress of its latest triggers only. A listener writes the count of every
micro-batch that has late rows, in a folder named after the query and the batch: a repeated batch
replaces its count, and a query that resumes from its checkpoint adds to the counts of earlier runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from routelens.schemas import struct

COUNT = "name STRING, dropped BIGINT, reported_at TIMESTAMP"
LATE_ROWS = struct(f"{COUNT}, query_id STRING, batch_id BIGINT")


class LateRowLog(StreamingQueryListener):
    """Writes the late rows of each micro-batch below ``folder``. Give it to ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def record(self, query_id: str, name: str | None, batch_id: int, dropped: int) -> None:
        """One batch's count; batches without late rows leave no file."""
        if dropped > 0:
            row = self._spark.range(1).select(
                F.lit(name).cast("string").alias("name"), F.lit(dropped).cast("bigint").alias("dropped"), F.current_timestamp().alias("reported_at")
            )
            row.write.mode("overwrite").json(f"{self._folder}/query_id={query_id}/batch_id={batch_id}")

    def finish(self, query: StreamingQuery) -> None:
        """Record what the engine still remembers of a query that has ended: its last events may not have come yet."""
        for p in query.recentProgress:
            self.record(str(query.id), query.name, p["batchId"], sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.record(str(p.id), p.name, p.batchId, sum(s.numRowsDroppedByWatermark for s in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``query_id, name, batch_id, dropped, reported_at`` of every micro-batch that had late rows.

    Rows are counted after a task has folded its part of them, so ``dropped`` counts folded rows.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        found = spark.createDataFrame([], LATE_ROWS)
    else:
        found = spark.read.schema(LATE_ROWS).json(folder)
    return found.select("query_id", "name", "batch_id", "dropped", "reported_at")
