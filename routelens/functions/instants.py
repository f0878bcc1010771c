"""Instants: ISO text, epoch milliseconds, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: an ISO-8601 instant has a date, a time with seconds, and a zone.
ISO_INSTANT = (
    r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,9})?"
    r"([Zz]|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)$"
)


def parse_instant(text: Column) -> Column:
    """Timestamp in whole milliseconds, NULL where ``text`` is not an ISO instant."""
    parsed = F.when(text.rlike(ISO_INSTANT), F.try_to_timestamp(F.upper(text)))
    return F.date_trunc("MILLISECOND", parsed)


def epoch_millis(instant: Column) -> Column:
    return F.unix_millis(instant)


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def whole_seconds_between(start: Column, end: Column) -> Column:
    """Full seconds from ``start`` to ``end``."""
    return F.call_function("div", F.unix_millis(end) - F.unix_millis(start), F.lit(1000))
