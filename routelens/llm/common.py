"""What the operators share: scratch tables, words, folds and connected classes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Space and the five ASCII control characters that count as white space.
BLANKS = " \t\n\u000b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    Only a local session, as in tests, may leave that setting out.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a table in the shared folder: its lineage ends there, so a lost executor
    costs no recomputation and every later use reads the same rows."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def whole_text(text: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than ``BLANKS``; none for null."""
    return F.array_remove(F.split(whole_text(text), BLANK_RUN), "")


def shingle_words(text: Column) -> Column:
    """The words that near-duplicate operators compare: lower case, split at white space."""
    return words_of(F.lower(text))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id hashes as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def in_share(share, *keys: str) -> Column:
    """True for about ``share`` of all rows, by a hash of ``keys``: a sample of known size without a sort or a row order."""
    return F.pmod(F.xxhash64(*keys), F.lit(2**40)) < F.lit(float(2**40)) * share


def first_by_hash(rows: DataFrame, group: str, key: str, most: Column) -> DataFrame:
    """At most ``most`` rows of each group of a frame with distinct keys, chosen by a hash of ``key``.

    ``__n`` holds the group's number of keys. A share by the hash leaves some more than wanted, and only those are ranked,
    so no task ever sorts a whole group.
    """
    spare = most + 8 * F.sqrt(most) + 16
    drawn = rows.where(in_share(F.least(F.lit(1.0), spare / F.greatest(F.col("__n"), F.lit(1))), key))
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.pmod(F.xxhash64(key), F.lit(2**40)), key))
    return drawn.withColumn("__place", place).where(F.col("__place") <= F.greatest(most, F.lit(1)))


def connected(edges: DataFrame, name: str) -> DataFrame:
    """``(vertex, root)`` for every vertex of the undirected ``edges(a, b)``; root is the least vertex of its class.

    Alternates large-star and small-star steps, so the number of rounds grows with the logarithm of
    the longest path. Every round is written to the shared folder. A vertex's least neighbour is found
    by aggregation, so no vertex's neighbours meet in one task's memory.
    """
    stars = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    seen = _print_of(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.unionByName(root.select("u", F.col("m").alias("v"))).distinct(), name)
        now = _print_of(stars)
        if now == seen:
            break
        seen = now
    ends = stars.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return ends.unionByName(stars.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())


def _print_of(stars: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(stars.agg(F.count("*"), F.sum(mixed)).first())


def per_worker(build: Callable) -> Callable:
    """``build`` called once in each Python worker and kept there, by its arguments."""
    kept: dict = {}

    def get(*args):
        if args not in kept:
            kept[args] = build(*args)
        return kept[args]

    return get
