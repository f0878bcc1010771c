"""Access logs derived from the ``events`` table, for tests, checks and benchmarks.

The mapping is described in FIXTURES.md. Time is compressed so that a minute holds enough
rows to be worth a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routelens.schemas import MESSAGE_FIELDS, struct
from routelens.sources.decode import DEFAULT_ROUTE

EVENTS = struct(
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

# The sample traffic: routes by event type, and hosts, methods and status codes of our own choice.
ROUTE_BY_EVENT = {
    "click": "catalog",
    "view": "reviews",
    "purchase": "checkout",
    "signup": "details",
    "error": "cart",
}
HOSTS = ("store.routelens.test", "search.routelens.test", "media.routelens.test")
METHODS = ("GET", "HEAD", "PATCH", "OPTIONS")
STATUS_CODES = (200, 206, 504, 200, 429, 304, 200, 409, 202, 200, 501, 302, 410, 200, 422)
# The event type whose route has hardly any errors.
RELIABLE = "view"
BASE_MICROS = 1704067200000000
TIME_COMPRESSION = 720


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def read_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream. The pattern matches one file as well as a directory."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def first_half(events: DataFrame) -> Column:
    """True for rows in the first half of the time that ``events`` span."""
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    if ends.low is None:
        return F.lit(True)
    return F.col("ts") < F.lit(str(ends.low + (ends.high - ends.low) / 2)).cast("timestamp_ntz")


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _div(dividend: Column, divisor: int) -> Column:
    return F.call_function("div", dividend, F.lit(divisor))


def events_to_logs(events: DataFrame, default_route: bool = True) -> DataFrame:
    """Access logs of an events frame, with ``event_id`` in front."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    base_route = F.lit(None).cast("string")
    for event_type, route in ROUTE_BY_EVENT.items():
        base_route = F.when(F.col("event_type") == event_type, route).otherwise(base_route)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    squeezed = F.lit(BASE_MICROS) + _div(micros - BASE_MICROS, TIME_COMPRESSION)
    route = F.when(event_id % 50 != 0, base_route)
    if default_route:
        route = F.coalesce(route, F.lit(DEFAULT_ROUTE))
    return events.select(
        "event_id",
        F.timestamp_micros(_div(squeezed, 1000) * 1000).alias("event_time"),
        route.alias("http_route"),
        _pick(HOSTS, user_id % 3 + 1).alias("hostname"),
        _pick(METHODS, event_id % 4 + 1).alias("method"),
        F.concat(F.lit("/api/v1/"), base_route, F.lit("/"), (k % 7).cast("string")).alias("path"),
        F.when((F.col("event_type") == RELIABLE) & (event_id % 40 != 0), STATUS_CODES[0])
        .otherwise(_pick(STATUS_CODES, k % 15 + 1))
        .alias("status_code"),
        F.floor(F.col("value") * 4).cast("bigint").alias("response_time_ms"),
        (F.lit(100) + event_id * 37 % 10000).alias("bytes_sent"),
        (F.lit(50) + event_id * 17 % 5000).alias("bytes_received"),
        F.concat(base_route, F.lit("-cluster")).alias("upstream_cluster"),
        F.concat(F.lit("10.42.0."), (user_id % 15).cast("string")).alias("client_ip"),
    )


def access_logs(spark: SparkSession, sf_dir: str, default_route: bool = True) -> DataFrame:
    return events_to_logs(read_events(spark, sf_dir), default_route)


def access_logs_stream(spark: SparkSession, sf_dir: str, default_route: bool = True) -> DataFrame:
    return events_to_logs(read_events_stream(spark, sf_dir), default_route)


def logs_to_messages(logs: DataFrame) -> DataFrame:
    """Broker-shaped rows: one subject per host, ``seq`` from 1."""
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    fields = [iso.alias("timestamp"), *[F.col(c) for c in MESSAGE_FIELDS[1:]]]
    return logs.select(
        F.concat(F.lit("access.logs."), F.col("hostname")).alias("subject"),
        (F.col("event_id") + 1).alias("seq"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_to_messages(access_logs(spark, sf_dir, default_route=False))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages with every kind of damage the decoder has to handle."""
    logs = access_logs(spark, sf_dir, default_route=False)
    kind = (F.col("seq") - 1) % 97
    quoted = F.regexp_replace("value", r'"status_code":(\d+)', r'"status_code":"$1"')
    no_latency = F.regexp_replace("value", r'"response_time_ms":\d+,', "")
    extra = F.regexp_replace("value", r"^\{", r'{"unknown_field":"ignored",')
    value = (
        F.when(kind == 1, "")
        .when(kind == 2, "not valid json")
        .when(kind == 3, "null")
        .when(kind == 4, "[]")
        .when(kind == 5, extra)
        .when(kind == 6, quoted)
        .when(kind == 7, no_latency)
        .when(kind == 8, "{'http_route':'q'}")
        .when(kind == 9, '{"http_route":["x"],"status_code":200}')
        .when(kind == 10, '{"http_route":"x","path":{"a":1}}')
        .when(kind == 11, '{"timestamp":"2024-01-01T00:00:00.000Z","http_route":"[x]","path":"{}"}')
        .otherwise(F.col("value"))
    )
    return logs_to_messages(logs).withColumn("value", value)
