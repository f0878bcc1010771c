"""Where reading starts, over rows of ``(subject, seq, value)``.

``seq`` is unique in the log. A stream resumes from its checkpoint instead; these are for
batch reads and for the first start.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)

# A sequence number, or one by partition (``topic-partition``).
Bound = int | Mapping[str, int]

# Names of the start positions.
ALL = "all"
LAST = "last"
NEW = "new"
LAST_PER_SUBJECT = "last_per_subject"
DELIVER_POLICIES = (ALL, LAST, NEW, LAST_PER_SUBJECT)


def parse_deliver_policy(name: str) -> str:
    """Known policy name in lower case; anything else reads from the beginning."""
    policy = name.lower()
    if policy not in DELIVER_POLICIES:
        LOG.warning("unknown deliver policy %r, reading everything", name)
        return ALL
    return policy


def from_broker(rows: DataFrame) -> DataFrame:
    """Rows with ``topic, partition, offset`` as ``subject, partition, seq, value``; other rows as they are.

    The subject is the key, or the topic where there is none. An offset orders the rows of
    one topic and partition only, so these two go on as one ``partition``.
    """
    if not {"key", "topic", "partition", "offset"} <= set(rows.columns):
        return rows
    topic = F.col("topic")
    return rows.select(
        F.coalesce(F.col("key").cast("string"), topic).alias("subject"),
        F.concat_ws("-", topic, F.col("partition")).alias("partition"),
        F.col("offset").alias("seq"),
        "value",
    )


def _parts(messages: DataFrame) -> list[str]:
    """The column inside which ``seq`` has an order, if not the whole log."""
    return [c for c in messages.columns if c == "partition"]


def _newest(messages: DataFrame, keys: list[str]) -> DataFrame:
    newest = messages.groupBy(*keys).agg(F.max("seq").alias("s_seq"))
    pos = newest.select(*[F.col(k).alias(f"s_{k}") for k in keys], "s_seq")
    same = messages["seq"] == pos["s_seq"]
    for key in keys:
        same = same & messages[key].eqNullSafe(pos[f"s_{key}"])
    return messages.join(pos, same, "left_semi")


def replay_last(messages: DataFrame) -> DataFrame:
    """The newest message, of each partition where there are partitions."""
    if _parts(messages):
        return _newest(messages, _parts(messages))
    return messages.orderBy(F.desc("seq")).limit(1)


def replay_last_per_subject(messages: DataFrame) -> DataFrame:
    """The newest message of each subject.

    The highest ``seq`` per subject is a hash aggregation over two columns. Payloads are
    fetched by a join on subject and ``seq``, which spreads a busy subject and lets the
    engine broadcast the newest positions when they turn out small. A broker keeps a key in
    one partition; messages without a key have a newest one in each.
    """
    return _newest(messages, ["subject", *_parts(messages)])


def replay_after(messages: DataFrame, seq: Bound) -> DataFrame:
    """Messages after the last processed one. Partitions without a bound are read whole."""
    if isinstance(seq, Mapping):
        known = F.create_map(*[F.lit(x) for pair in seq.items() for x in pair]) if seq else None
        bound = F.element_at(known, F.col("partition")) if seq else F.lit(None)
        return messages.where(bound.isNull() | (F.col("seq") > bound))
    if _parts(messages):
        raise ValueError("messages of several partitions take one bound for each")
    return messages.where(F.col("seq") > seq)


def replay_new(messages: DataFrame, seq_at_start: Bound) -> DataFrame:
    """Messages written after the reader started."""
    return replay_after(messages, seq_at_start)


def replay_from_time(logs: DataFrame, start: Column) -> DataFrame:
    """Decoded messages not older than ``start``."""
    return logs.where(F.col("event_time") >= start)


def replay(messages: DataFrame, policy: str, last_processed: Bound = 0, seq_at_start: Bound = 0) -> DataFrame:
    """Apply a start position; a known last processed message overrides the policy."""
    if last_processed if isinstance(last_processed, Mapping) else last_processed > 0:
        return replay_after(messages, last_processed)
    policy = parse_deliver_policy(policy)
    if policy == LAST:
        return replay_last(messages)
    if policy == LAST_PER_SUBJECT:
        return replay_last_per_subject(messages)
    if policy == NEW:
        return replay_new(messages, seq_at_start)
    return messages
