import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from routelens.sources.decode import decode_messages, rejected_messages
from tests.conftest import NOON, collect

FULL = {
    "timestamp": "2026-01-21T12:00:00Z",  # fixed value, with its epoch milliseconds below
    "http_route": "catalog",
    "hostname": "shop.example.net",
    "method": "GET",
    "path": "/shelf/17",
    "status_code": 200,
    "response_time_ms": 73,
    "bytes_sent": 3300,
    "bytes_received": 610,
    "upstream_cluster": "catalog-cluster",
    "client_ip": "192.0.2.44",
}


@pytest.fixture
def decode(spark):
    def run(*payloads, **options):
        rows = [(p if p is None or isinstance(p, str) else json.dumps(p),) for p in payloads]
        return collect(decode_messages(spark.createDataFrame(rows, "value STRING"), **options))

    return run


def test_full_record(decode):
    (row,) = decode(FULL)
    expected = {k: v for k, v in FULL.items() if k != "timestamp"}
    assert row == {"event_time": NOON, **expected}


def test_epoch_of_instant(spark):
    frame = decode_messages(spark.createDataFrame([(json.dumps(FULL),)], "value STRING"))
    assert frame.select(F.unix_millis("event_time")).first()[0] == 1768996800000


@pytest.mark.parametrize("payload", ["{'http_route':'q'}", '{http_route:"q"}', '{"status_code":0200}'])
def test_only_standard_json_is_read(spark, decode, payload):
    assert decode(payload) == []
    assert rejected_messages(spark.createDataFrame([(payload,)], "value STRING")).collect() == [(payload,)]


@pytest.mark.parametrize("field", ["timestamp", "http_route", "path", "client_ip"])
@pytest.mark.parametrize("value", [{}, {"a": 1}, [], ["x"]])
def test_structure_is_no_text(spark, decode, field, value):
    payload = json.dumps({**FULL, field: value})
    assert decode(payload) == []
    assert rejected_messages(spark.createDataFrame([(payload,)], "value STRING")).collect() == [(payload,)]


@pytest.mark.parametrize("text", ["{}", '{"a":1}', "[x]", "["])
def test_text_may_look_like_a_structure(decode, text):
    (row,) = decode({**FULL, "path": text})
    assert row["path"] == text


@pytest.mark.parametrize("route", [None, ""])
def test_missing_route(decode, route):
    assert decode({**FULL, "http_route": route})[0]["http_route"] == "unknown"
    assert decode({"status_code": 200})[0]["http_route"] == "unknown"


def test_unknown_field_is_ignored(decode):
    assert len(decode({**FULL, "unknown_field": {"nested": [1, 2]}})) == 1


@pytest.mark.parametrize("payload", [None, "", "   ", "not valid json", "null", "[]", "[1]", "5", '"text"', "{"])
def test_unreadable_payload(spark, decode, payload):
    assert decode(payload) == []
    frame = spark.createDataFrame([(payload,)], "value STRING")
    assert rejected_messages(frame).collect() == [(payload,)]


def test_array_of_objects_is_rejected(decode):
    assert decode(json.dumps([FULL])) == []


def test_numbers_may_be_quoted_or_have_a_fraction(decode):
    (row,) = decode({**FULL, "status_code": "404", "response_time_ms": 73.7, "bytes_sent": "12"})
    assert (row["status_code"], row["response_time_ms"], row["bytes_sent"]) == (404, 73, 12)


@pytest.mark.parametrize("missing", [None, ""])
def test_missing_number(decode, missing):
    fields = ("status_code", "response_time_ms", "bytes_sent", "bytes_received")
    (row,) = decode({**FULL, **{f: missing for f in fields}})
    assert [row[f] for f in fields] == [0, 0, 0, 0]


@pytest.mark.parametrize(
    ("field", "value"),
    [
        ("status_code", "abc"),
        ("status_code", 2**31),
        ("status_code", -(2**31) - 1),
        ("status_code", {"a": 1}),
        ("response_time_ms", "fast"),
        ("bytes_sent", True),
        ("bytes_received", 1e30),
    ],
)
def test_number_that_cannot_be_read(spark, decode, field, value):
    payload = json.dumps({**FULL, field: value})
    assert decode(payload) == []
    assert rejected_messages(spark.createDataFrame([(payload,)], "value STRING")).count() == 1


@pytest.mark.parametrize(
    ("text", "millis"),
    [
        ("2026-01-21T12:00:00.123456Z", 123),
        ("2026-01-21T12:00:00.9999Z", 999),
        ("2026-01-21T14:00:00+02:00", 0),
        ("2026-01-21T06:30:00.5-05:30", 500),
    ],
)
def test_instants(decode, text, millis):
    (row,) = decode({**FULL, "timestamp": text})
    assert row["event_time"] == NOON + timedelta(milliseconds=millis)


@pytest.mark.parametrize(
    "text",
    [None, "", "2026-01-21", "2026-01-21 12:00:00", "2026-01-21T12:00:00", "2026-01-21T12:00Z",
     "2026-13-41T12:00:00Z", "2026-01-21T12:00:00 Europe/Paris", "yesterday"],
)
def test_no_instant_means_time_of_ingest(spark, text):
    frame = decode_messages(
        spark.createDataFrame([(json.dumps({**FULL, "timestamp": text}),)], "value STRING")
    )
    age = frame.select(F.unix_millis(F.current_timestamp()) - F.unix_millis("event_time")).first()[0]
    assert 0 <= age < 60_000


def test_sql_nulls(decode):
    (row,) = decode({"hostname": "h"}, sql_nulls=True)
    assert {k for k, v in row.items() if v is not None} == {"hostname"}


def test_binary_value_and_other_columns(spark):
    frame = spark.createDataFrame([(7, bytearray(json.dumps(FULL).encode()))], "seq BIGINT, value BINARY")
    (row,) = collect(decode_messages(frame))
    assert row["seq"] == 7 and row["status_code"] == 200


def test_payload_is_parsed_once(spark):
    frame = spark.createDataFrame([(json.dumps(FULL),)], "value STRING")
    for result in (decode_messages(frame), rejected_messages(frame)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
