"""A training corpus from ``documents``: toxic documents go, then common lines, then near copies; sources are mixed and packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelens.llm import jaccard_join, line_dedup, mixing, packing, toxicity
from routelens.llm.common import written
from routelens.llm.queries import TOXICITY_FOLDS, table
from routelens.llm.shingles import content_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), *TOXICITY_FOLDS)
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more have go; every document stays, with n_chars of what is left."""
    kept = line_dedup.LineIndex.build(docs).drop_common(docs.select(*COLUMNS))
    kept = kept.withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept_text")))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents one stays: the one with the least id. Texts without words all stay."""
    classes = jaccard_join.jaccard_join(docs)
    first = classes.where("content IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "content")).alias("stays"))
    stays = written(first.select("stays.*"), "stays")
    rows = docs.select(*COLUMNS).withColumn("__content", content_key(F.col("text")))
    same = rows["doc_id"].eqNullSafe(stays["doc_id"]) & (rows["__content"] == stays["content"])
    kept = rows.join(stays.hint("merge"), same).select(*[rows[c] for c in COLUMNS], rows["__content"])
    kept = kept.dropDuplicates(["doc_id", "__content"])
    return kept.unionByName(rows.where("__content IS NULL")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to the root of their sizes by Poisson replication, and all rows shuffled."""
    return mixing.mix(docs.select(*COLUMNS), mixing.repetition_rates(docs)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2,048 ids: one row for each piece of a document and its place."""
    return packing.pack(packing.cut_documents(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_common_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL has no zstandard dictionaries, MinHash or tokenizer; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus. Every stage's result is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
