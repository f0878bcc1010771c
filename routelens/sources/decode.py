"""JSON payloads to access logs.

All fields are read as text first. A typed schema would reject numbers that arrive quoted
or with a fraction, which are accepted here, and would hide which field was at fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routelens.functions.instants import parse_instant
from routelens.schemas import MESSAGE_FIELDS

DEFAULT_ROUTE = "unknown"
INT_RANGE = (-(2**31), 2**31 - 1)

_CORRUPT = "_corrupt_record"
_AS_TEXT = T.StructType([T.StructField(name, T.StringType()) for name in (*MESSAGE_FIELDS, _CORRUPT)])
# What the parser would accept beyond the JSON standard.
_LENIENCIES = (
    "allowComments",
    "allowUnquotedFieldNames",
    "allowSingleQuotes",
    "allowNumericLeadingZeros",
    "allowNonNumericNumbers",
    "allowBackslashEscapingAnyCharacter",
    "allowUnquotedControlChars",
)
_TEXT_FIELDS = ("hostname", "method", "path", "upstream_cluster", "client_ip")
_LONG_FIELDS = ("response_time_ms", "bytes_sent", "bytes_received")


def _parsed(messages: DataFrame, value: str) -> DataFrame:
    """``messages`` with the parsed payload.

    The parsed record goes through ``explode`` so that it is a column of its own to the
    optimizer. As a plain projection it would be copied into every condition on it, and
    each payload would be parsed several times.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT} | dict.fromkeys(_LENIENCIES, "false")
    record = F.from_json(F.col(value).cast("string"), _AS_TEXT, options)
    return messages.select("*", F.explode(F.array(record)).alias("_json"))


def _field(name: str) -> Column:
    return F.col(f"_json.{name}")


def _is_blank(name: str) -> Column:
    return F.coalesce(F.trim(_field(name)) == "", F.lit(True))


def _whole_number(name: str) -> Column:
    """Long value of a field, cutting off a fraction; NULL when it is not a number."""
    text = _field(name)
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def _number(name: str, missing: int | None) -> Column:
    return F.when(_is_blank(name), F.lit(missing).cast("bigint")).otherwise(_whole_number(name))


def _is_text(name: str, value: str) -> Column:
    """False for an object or array where text is expected.

    The parser hands over a structure as its JSON text, just as a string with the same
    content. Only a payload whose field begins like a structure is parsed once more to tell them apart.
    """
    whole = F.try_parse_json(F.col(value).cast("string"))
    kind = F.schema_of_variant(F.try_variant_get(whole, f"$.{name}", "variant"))
    starts_like_one = F.coalesce(F.substring(_field(name), 1, 1).isin("{", "["), F.lit(False))
    return F.when(starts_like_one, F.coalesce(kind == "STRING", F.lit(False))).otherwise(F.lit(True))


def _readable(value: str) -> Column:
    """False for payloads that are no JSON object, or hold a structure for text or a number that cannot be read."""
    is_object = F.col("_json").isNotNull() & _field(_CORRUPT).isNull()
    numbers_ok = [_is_blank(n) | _whole_number(n).isNotNull() for n in _LONG_FIELDS]
    status_ok = _is_blank("status_code") | F.coalesce(
        _whole_number("status_code").between(*INT_RANGE), F.lit(False)
    )
    readable = is_object & status_ok
    for ok in (*numbers_ok, *[_is_text(n, value) for n in ("timestamp", "http_route", *_TEXT_FIELDS)]):
        readable = readable & ok
    return F.coalesce(readable, F.lit(False))


def decode_messages(messages: DataFrame, value: str = "value", sql_nulls: bool = False) -> DataFrame:
    """Access logs from payloads; unreadable payloads are dropped.

    A missing route becomes ``unknown`` and a missing number 0. ``sql_nulls`` leaves them
    NULL, as the SQL views expect. A missing or unreadable time becomes the time of
    ingest, read once per batch. Other columns of ``messages`` are kept in front.
    """
    kept = [F.col(c) for c in messages.columns if c != value]
    missing = None if sql_nulls else 0
    route = _field("http_route")
    if not sql_nulls:
        route = F.coalesce(F.nullif(route, F.lit("")), F.lit(DEFAULT_ROUTE))
    event_time = parse_instant(_field("timestamp"))
    if not sql_nulls:
        now = F.date_trunc("MILLISECOND", F.current_timestamp())
        event_time = F.coalesce(event_time, now)
    return (
        _parsed(messages, value)
        .where(_readable(value))
        .select(
            *kept,
            event_time.alias("event_time"),
            route.alias("http_route"),
            *[_field(c).alias(c) for c in _TEXT_FIELDS[:3]],
            _number("status_code", missing).cast("int").alias("status_code"),
            *[_number(c, missing).alias(c) for c in _LONG_FIELDS],
            *[_field(c).alias(c) for c in _TEXT_FIELDS[3:]],
        )
    )


def rejected_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """The payloads ``decode_messages`` drops, unchanged."""
    return _parsed(messages, value).where(~_readable(value)).drop("_json")
