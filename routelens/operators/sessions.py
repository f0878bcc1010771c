"""Client sessions: a session ends when a client is silent for longer than the gap.

Grouping a client's raw events in one task would let one busy address stall the job, so
batch input takes another way to the same result. Time is cut into slices one gap long.
Two events of one client in the same slice are always in the same session, so events are first
folded per client, slice, path and route. A session is named by the time it opens at. Which slices
open one is seen inside *blocks* of slices, one client and block at a time; a block is then one row
with its first and last event and the last session that opens in it. The session that a block
begins in follows from the rows of the blocks before it, in the same way and again by blocks of
them, until one block spans all of time. No step orders more than a block of a client's rows.

A stream uses the built-in session window, whose state is merged batch by batch.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from routelens.functions.status import is_error, rate_pct, wide_sum


def session_metrics(logs: DataFrame, gap: timedelta) -> DataFrame:
    """One row per client session. Silence of exactly ``gap`` does not end a session."""
    if gap <= timedelta(0):
        raise ValueError("the session gap must be positive")
    if logs.isStreaming:
        return finish_sessions(_stream_totals(logs, gap))
    return finish_sessions(_batch_totals(logs, gap))


def _distinct_seen(streaming: bool, column: str) -> Column:
    """Distinct values where NULL counts as a value."""
    value = F.struct(column)
    return F.size(F.collect_set(value)) if streaming else F.count_distinct(value)


def _stream_totals(logs: DataFrame, gap: timedelta) -> DataFrame:
    millis = gap // timedelta(milliseconds=1)
    return logs.groupBy("client_ip", F.session_window("event_time", f"{millis} milliseconds")).agg(
        F.count("*").alias("request_count"),
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        _distinct_seen(True, "path").alias("unique_paths"),
        _distinct_seen(True, "http_route").alias("unique_routes"),
        F.sum(F.col("response_time_ms").cast("double")).alias("total_response_time_ms"),
        wide_sum("bytes_sent").try_cast("bigint").alias("total_bytes_sent"),
        F.count_if(is_error(F.col("status_code"))).alias("error_count"),
    )


#: Slices of a block, and blocks of the next larger one, as powers of two.
SLICE_BITS, BLOCK_BITS = 12, 22
#: First and last instant that a timestamp can be, in microseconds from 1970.
FIRST_MICROS, LAST_MICROS = -62_135_596_800_000_000, 253_402_300_799_999_999


def _running(above: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*above).orderBy(order)


def _heads(blocks: DataFrame, gap_micros: int, bits_left: int) -> DataFrame:
    """``client_ip, block, head, seen``: the session that is on when each block's first event comes.

    ``blocks`` has the first and last event of each and ``tail``, the last session that opens behind its first slice.
    Rows of a client are looked at by blocks of blocks, and where a larger block begins is known from its own row. The
    topmost spans all of time, so its windows hold one row for each of a client's blocks below.
    """
    top = bits_left <= BLOCK_BITS
    placed = blocks.withColumn("larger", F.lit(0).cast("bigint") if top else F.shiftright("block", BLOCK_BITS))
    before = _running(["client_ip", "larger"], "block").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.col("first_micros") - F.max("last_micros").over(before) > gap_micros
    placed = placed.withColumn("opened", F.when(opens, F.col("first_micros")))
    own = F.coalesce("tail", "opened")
    placed = placed.withColumn("own", own).withColumn("carried", F.coalesce("opened", F.max("own").over(before)))
    if top:
        begin = F.min("first_micros").over(before)
        return placed.select("client_ip", "block", F.coalesce("carried", begin, "first_micros").alias("head"), "seen")
    larger = placed.groupBy("client_ip", "larger").agg(
        F.min("first_micros").alias("first_micros"), F.max("last_micros").alias("last_micros"), F.max("own").alias("tail"), F.sum("seen").alias("seen")
    )
    heads = _heads(larger.withColumnRenamed("larger", "block"), gap_micros, bits_left - BLOCK_BITS)
    heads = heads.select(F.col("client_ip").alias("l_client_ip"), F.col("block").alias("l_block"), F.col("head").alias("l_head"))
    joined = placed.join(heads, F.col("client_ip").eqNullSafe(F.col("l_client_ip")) & F.col("larger").eqNullSafe(F.col("l_block")))
    return joined.select("client_ip", "block", F.coalesce("carried", "l_head").alias("head"), "seen")


def _batch_totals(logs: DataFrame, gap: timedelta) -> DataFrame:
    gap_micros = gap // timedelta(microseconds=1)
    micros = F.unix_micros("event_time")
    sliced = logs.where(F.col("event_time").isNotNull()).withColumn(
        "slice", F.call_function("div", micros - F.lit(FIRST_MICROS), F.lit(gap_micros))
    )
    visits = sliced.groupBy("client_ip", "slice", "path", "http_route").agg(
        F.count("*").alias("requests"),
        F.min(micros).alias("first_micros"),
        F.max(micros).alias("last_micros"),
        F.sum(F.col("response_time_ms").cast("double")).alias("response_time"),
        wide_sum("bytes_sent").alias("bytes"),
        F.count_if(is_error(F.col("status_code"))).alias("errors"),
    )
    folded = visits.columns
    visits = visits.withColumn("block", F.shiftright("slice", SLICE_BITS))
    by_slice = _running(["client_ip", "block"], "slice")
    silence = F.min("first_micros").over(by_slice.rangeBetween(0, 0)) - F.max("last_micros").over(
        by_slice.rangeBetween(Window.unboundedPreceding, -1)
    )
    first = F.min("first_micros").over(by_slice.rangeBetween(0, 0))
    visits = visits.withColumn("opened", F.when(silence > gap_micros, first))
    visits = visits.withColumn("within", F.max("opened").over(by_slice.rangeBetween(Window.unboundedPreceding, 0)))
    # Both uses of the folded rows read one shuffle of one scan, as long as they take the same columns and filters:
    # ``seen`` takes every column, and null-safe joins ask for no filter.
    slices = visits.groupBy("client_ip", "block", "slice").agg(
        F.min("first_micros").alias("first_micros"), F.max("last_micros").alias("last_micros"), F.sum(F.hash(*folded)).alias("seen")
    )
    blocks = (
        slices.withColumn("silence", F.col("first_micros") - F.lag("last_micros").over(by_slice))
        .groupBy("client_ip", "block")
        .agg(
            F.min("first_micros").alias("first_micros"),
            F.max("last_micros").alias("last_micros"),
            F.max(F.when(F.col("silence") > gap_micros, F.col("first_micros"))).alias("tail"),
            F.sum("seen").alias("seen"),
        )
    )
    bits = ((LAST_MICROS - FIRST_MICROS) // gap_micros).bit_length() - SLICE_BITS
    heads = _heads(blocks, gap_micros, bits).where("seen IS NOT NULL")
    heads = heads.select(F.col("client_ip").alias("h_client_ip"), F.col("block").alias("h_block"), "head")
    same_block = F.col("client_ip").eqNullSafe(F.col("h_client_ip")) & F.col("block").eqNullSafe(F.col("h_block"))
    return (
        visits.join(heads, same_block)
        .groupBy("client_ip", F.coalesce("within", "head").alias("session"))
        .agg(
            F.sum("requests").alias("request_count"),
            F.timestamp_micros(F.min("first_micros")).alias("session_start"),
            F.timestamp_micros(F.max("last_micros")).alias("session_end"),
            _distinct_seen(False, "path").alias("unique_paths"),
            _distinct_seen(False, "http_route").alias("unique_routes"),
            F.sum("response_time").alias("total_response_time_ms"),
            wide_sum("bytes").try_cast("bigint").alias("total_bytes_sent"),
            F.sum("errors").alias("error_count"),
        )
    )


def finish_sessions(totals: DataFrame) -> DataFrame:
    requests = F.col("request_count")
    return totals.select(
        "client_ip",
        "request_count",
        "session_start",
        "session_end",
        (F.unix_millis("session_end") - F.unix_millis("session_start")).alias("session_duration_ms"),
        F.col("unique_paths").cast("int").alias("unique_path_count"),
        F.col("unique_routes").cast("int").alias("unique_route_count"),
        F.when(requests == 0, F.lit(0.0))
        .otherwise(F.col("total_response_time_ms") / requests)
        .alias("avg_response_time_ms"),
        "total_bytes_sent",
        "error_count",
        rate_pct(F.col("error_count"), requests).alias("error_rate"),
    )
