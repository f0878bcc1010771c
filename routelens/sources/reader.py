"""Access logs from any Spark source that yields a ``value`` payload column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from routelens.schemas import struct
from routelens.sources.decode import decode_messages
from routelens.sources.replay import ALL, Bound, from_broker, replay

# Sources that need a schema up front because Spark infers none for streams.
MESSAGES = struct("subject STRING, seq BIGINT, value STRING")
_FILES_WITH_COLUMNS = ("parquet", "orc")


def read_messages(
    spark: SparkSession, fmt: str, path: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Bounded payload rows: ``text`` lines, message files, or a broker's rows."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt in _FILES_WITH_COLUMNS:
        reader = reader.schema(MESSAGES)
    return reader.load(path)


def read_messages_stream(
    spark: SparkSession, fmt: str, path: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Unbounded payload rows from the same sources."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt in _FILES_WITH_COLUMNS:
        reader = reader.schema(MESSAGES)
    return reader.load(path)


def read_access_logs(
    spark: SparkSession,
    fmt: str = "text",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    sql_nulls: bool = False,
    policy: str = ALL,
    last_processed: Bound = 0,
    seq_at_start: Bound = 0,
) -> DataFrame:
    """Bounded access logs. A start position needs a source with sequence numbers or a broker's offsets."""
    messages = from_broker(read_messages(spark, fmt, path, options))
    if policy != ALL or last_processed:
        messages = replay(messages, policy, last_processed, seq_at_start)
    return decode_messages(messages.select("value"), sql_nulls=sql_nulls)


def read_access_logs_stream(
    spark: SparkSession,
    fmt: str = "text",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    sql_nulls: bool = False,
) -> DataFrame:
    """Unbounded access logs."""
    messages = read_messages_stream(spark, fmt, path, options).select("value")
    return decode_messages(messages, sql_nulls=sql_nulls)
