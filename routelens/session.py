"""Session settings the jobs are written for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings that change results or the shape of plans. Sizing (executors, memory,
# shuffle partitions) belongs to spark-submit.
SESSION_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Timestamps with file statistics that a scan can skip by.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Fold each task's part of a client's session before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def apply_session_confs(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session that already exists."""
    for key, value in SESSION_CONFS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "routelens", confs: Mapping[str, str] | None = None) -> SparkSession:
    """Create or reuse a session with the settings above plus ``confs``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONFS, **(confs or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
