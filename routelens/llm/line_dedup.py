"""Reversible line dedup: exact counts of documents by line, and sharded cuckoo filters of the common lines."""

from __future__ import annotations

import string
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routelens.llm.common import BLANKS, whole_text, written
from routelens.llm.cuckoo import CuckooFilter

MIN_DOCUMENTS = 10
#: Distinct lines that a shard is planned for; one task holds the common ones among them.
LINES_A_SHARD = 2_000_000
_FILTERS = "shard long, filter binary"


def lines_of(text: Column) -> Column:
    """A text's lines; a null or empty text is one empty line."""
    return F.split(whole_text(text), "\n")


def line_key(line: Column) -> Column:
    """md5 of the line without white space at its ends and with A-Z in lower case; null if nothing is left."""
    bare = F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)
    return F.when(bare != "", F.unhex(F.md5(bare)))


def _keys(docs: DataFrame) -> DataFrame:
    """One row for each document and different key; a row of ``docs`` is a document."""
    distinct = F.array_distinct(F.transform(lines_of(F.col("text")), line_key))
    return docs.select(F.explode(distinct).alias("key")).where("key IS NOT NULL")


def _as_numbers(keys: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


@dataclass(frozen=True)
class LineIndex:
    """How many documents have each line, and filters of the lines that ``min_documents`` or more have.

    ``counts(shard, key, documents)`` is exact. ``filters(shard, filter)`` has a cuckoo filter for each
    shard with common lines. ``insert`` and ``delete`` return a new index, which is written to the shared folder; the old one
    stays valid. Deleting documents that were inserted brings back the counts from before.
    """

    spark: SparkSession
    shards: int
    min_documents: int
    counts: DataFrame
    filters: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession, shards: int, min_documents: int = MIN_DOCUMENTS) -> LineIndex:
        counts = spark.createDataFrame([], "shard long, key binary, documents long")
        return cls(spark, shards, min_documents, counts, spark.createDataFrame([], _FILTERS))

    @classmethod
    def build(cls, docs: DataFrame, min_documents: int = MIN_DOCUMENTS, lines_a_shard: int = LINES_A_SHARD) -> LineIndex:
        """An index of ``docs`` with as many shards as its different lines need."""
        found = written(_keys(docs).groupBy("key").agg(F.count("*").alias("n")), "lines")
        shards = max(1, -(-found.count() // lines_a_shard))
        return cls.empty(docs.sparkSession, shards, min_documents)._changed(found)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(_keys(docs).groupBy("key").agg(F.count("*").alias("n")))

    def delete(self, docs: DataFrame) -> LineIndex:
        return self._changed(_keys(docs).groupBy("key").agg((-F.count("*")).alias("n")))

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards))

    def _changed(self, delta: DataFrame) -> LineIndex:
        old = self.counts.select("shard", "key", F.col("documents").alias("was"), F.lit(0).cast("long").alias("n"))
        new = delta.select(self._shard().alias("shard"), "key", F.lit(0).cast("long").alias("was"), "n")
        merged = old.unionByName(new).groupBy("shard", "key").agg(F.sum("was").alias("was"), F.sum("n").alias("n"))
        merged = written(merged.select("shard", "key", "was", (F.col("was") + F.col("n")).alias("documents")), "merged")
        least = self.min_documents

        def renew(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            shard = int((keys if len(keys) else filters)["shard"].iloc[0])
            now = keys["documents"] >= least
            was = keys["was"] >= least
            if not len(filters):
                made = CuckooFilter.of(_as_numbers(keys["key"][now]))
            else:
                made = CuckooFilter.from_bytes(filters["filter"].iloc[0])
                made.delete(_as_numbers(keys["key"][was & ~now]))
                if not made.insert(_as_numbers(keys["key"][now & ~was])):
                    made = CuckooFilter.of(_as_numbers(keys["key"][now]))
            return pd.DataFrame({"shard": [shard], "filter": [made.to_bytes()]})

        common = merged.where((F.col("was") >= least) | (F.col("documents") >= least))
        groups = common.groupBy("shard").cogroup(self.filters.groupBy("shard"))
        filters = written(groups.applyInPandas(renew, _FILTERS), "filters")
        return replace(self, counts=merged.where("documents > 0").select("shard", "key", "documents"), filters=filters)

    def common(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys(key)``, each once, that are common: a shard's filter sorts most out, the exact counts decide."""

        def probe(some: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            if not len(filters) or not len(some):
                return some.iloc[:0][["shard", "key"]]
            hit = CuckooFilter.from_bytes(filters["filter"].iloc[0]).contains(_as_numbers(some["key"]))
            return some[hit][["shard", "key"]]

        asked = keys.distinct().select(self._shard().alias("shard"), "key")
        maybe = asked.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(probe, "shard long, key binary")
        exact = self.counts.where(F.col("documents") >= self.min_documents)
        return maybe.join(exact.select("shard", "key"), ["shard", "key"], "left_semi").select("key")

    def drop_common(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``n_lines, n_dropped, kept_text`` in place of columns so named; every row stays.

        Common lines go wherever they stand. Lines without a key always stay, so a null or empty text has one line and keeps
        it. Repeated rows lose the same lines. A document is found again by its id and a hash of its text, nulls alike.
        """
        own = ("n_lines", "n_dropped", "kept_text")
        rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own])
        rows = rows.withColumns({"__id": F.xxhash64("doc_id", F.col("doc_id").isNull()), "__hash": F.xxhash64("text")})
        common = written(self.common(_keys(docs)), "common")
        keys = F.transform(lines_of(F.col("text")), line_key)
        places = rows.select("__id", "__hash", F.posexplode(keys).alias("place", "key")).where("key IS NOT NULL")
        # Copies name the same places, so a place counts once for an id and a hash.
        gone = places.join(common, "key").groupBy("__id", "__hash").agg(F.collect_set("place").alias("__gone"))
        joined = rows.join(gone.hint("merge"), ["__id", "__hash"], "left")
        lines = lines_of(F.col("text"))
        none = F.array().cast("array<int>")
        joined = joined.select("*", F.inline(F.array(F.struct(lines.alias("__lines"), F.coalesce("__gone", none).alias("__out")))))
        stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__out"))
        joined = joined.select("*", F.inline(F.array(F.struct(stay.alias("__stay")))))
        kept = F.array_join(F.transform("__stay", lambda place: F.get(F.col("__lines"), place)), "\n")
        joined = joined.withColumns(
            {"n_lines": F.size("__lines").cast("long"), "n_dropped": (F.size("__lines") - F.size("__stay")).cast("long"), "kept_text": kept}
        )
        return joined.drop("__id", "__hash", "__gone", "__lines", "__out", "__stay")
