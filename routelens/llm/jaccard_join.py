"""Similarity join of documents on word shingles: MinHash bands find classes of candidates, full shingle sets decide."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.llm.common import connected, written
from routelens.llm.shingles import SHINGLE, content_key, flat_lists, mixed, shingle_set, word_hashes

THRESHOLD = 0.8
#: A pair at the threshold shares a band with this probability.
RECALL = 0.9999
HASHES = 128
#: Shingles and texts that a block of a candidate class holds; a task compares two blocks.
BLOCK_SHINGLES, BLOCK_TEXTS = 1_000_000, 2_048
_COLUMNS = 4_096


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """``(bands, rows)``: the most rows a band, and so the fewest chance candidates, with which ``hashes`` reach ``recall``."""
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= hashes:
            best = (bands, rows)
    return best


def band_keys(shingles: np.ndarray, starts: np.ndarray, bands: int, rows: int, seed: int = 11) -> np.ndarray:
    """(texts, bands) hashes of ``rows`` least hashes each. ``shingles[starts[i]:starts[i + 1]]`` is text i's set, never empty."""
    rng = np.random.default_rng(seed)
    keys = np.empty((len(starts) - 1, bands), np.int64)
    for band in range(bands):
        key = np.full(len(starts) - 1, band, np.uint64)
        for _ in range(rows):
            factor, shift = rng.integers(0, 2**63, 2, dtype=np.uint64)
            hashed = shingles * (factor | np.uint64(1)) + shift
            hashed ^= hashed >> np.uint64(29)
            hashed *= np.uint64(0xBF58476D1CE4E5B9)
            key = mixed(key * np.uint64(31) + np.minimum.reduceat(hashed, starts[:-1]))
        keys[:, band] = key.view(np.int64)
    return keys


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, content, n_shingles, bands`` of every row; content null and no bands without words."""

    def sign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                words, ends = flat_lists(part.column(2))
                sets = [shingle_set(words[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                lists = [[]] * len(sets)
                if len(full):
                    starts = np.concatenate([[0], np.cumsum(sizes[full])])
                    keys = band_keys(np.concatenate([sets[i] for i in full]), starts, bands, rows)
                    lists = [[] for _ in sets]
                    for i, row in zip(full, keys, strict=True):
                        lists[i] = row
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes), pa.array(lists, pa.list_(pa.int64()))],
                    names=["doc_id", "content", "n_shingles", "bands"],
                )

    text = F.col("text")
    rows_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content_key(text).alias("content"), word_hashes(text).alias("words"))
    return rows_.mapInArrow(sign, "doc_id long, content binary, n_shingles long, bands array<bigint>")


def _compare(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the texts of two blocks, or inside one: by text the number of linked texts and documents, and the least text it is
    linked to. Shared shingles are counted by matrix products over blocks of columns, so no pair becomes a row.
    """
    pdf = pdf.drop_duplicates("content").sort_values("content", ignore_index=True)
    sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
    sizes = np.array([len(s) for s in sets], np.int64)
    text = np.repeat(np.arange(len(sets)), sizes)
    _, column, seen = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64), return_inverse=True, return_counts=True)
    common = seen > 1  # a shingle of one text is in no intersection
    number = np.cumsum(common) - 1
    keep = common[column]
    text, column = text[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    text, column = text[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(common.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [low, low + _COLUMNS])
        rows, inverse = np.unique(text[a:b], return_inverse=True)
        has = np.zeros((len(rows), _COLUMNS), np.float32)
        has[inverse, column[a:b] - low] = 1
        shared[np.ix_(rows, rows)] += has @ has.T
    linked = shared >= threshold * (sizes[:, None] + sizes[None] - shared) - 1e-6
    np.fill_diagonal(linked, False)
    first, second = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    if first != second:
        block = pdf["block"].to_numpy()
        linked &= block[:, None] != block[None]
    copies = pdf["copies"].to_numpy(np.int64)
    some = np.flatnonzero(linked.any(axis=1))
    root = _roots(linked)
    return pd.DataFrame(
        {
            "content": pdf["content"].to_numpy()[some],
            "linked_texts": linked[some].sum(axis=1).astype(np.int64),
            "linked_docs": linked[some].astype(np.int64) @ copies,
            "root": pdf["content"].to_numpy()[root[some]],
        }
    )


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first member of every row's connected class."""
    root = np.arange(len(linked))
    done = np.zeros(len(linked), bool)
    for start in range(len(linked)):
        if done[start]:
            continue
        front = np.zeros(len(linked), bool)
        front[start] = True
        members = front.copy()
        while front.any():
            front = linked[front].any(axis=0) & ~members
            members |= front
        done |= members
        root[members] = start
    return root


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``doc_id, content, root, class_id, n_links, n_linked_texts`` of every row of ``docs(doc_id, text)``.

    Words are lower case and split at white space; documents are linked if their sets of ``SHINGLE`` words have a Jaccard
    similarity of at least ``threshold``. ``n_links`` counts the other rows linked, exact copies included. ``n_linked_texts``
    counts different word sequences linked. ``class_id`` is the least doc_id of all rows that links connect; where ids
    are null or repeated, several classes have the same. ``root`` is the least content of the class, and its key. Shorter texts
    are one shingle. A text without words, or null, is linked to nothing: its content and root are null and its class its own id.
    Columns other than doc_id and text are ignored.

    Rows with the same words are one text from the first step on. Only texts that share a band with another text go on. Bands
    join them to candidate classes, a superset of the linked ones. Classes are compared as pairs of blocks of bounded
    size, so the largest class is spread over many tasks.
    """
    bands, rows = choose_bands(threshold, recall)
    signed = written(_signed(docs, bands, rows), "signed")
    texts = signed.where("content IS NOT NULL").groupBy("content").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")
    )
    texts = written(texts, "texts")
    buckets = texts.select("content", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("content").alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "head")
    edges = buckets.join(heads, "band").where("content <> head").select(F.col("content").alias("a"), F.col("head").alias("b"))
    candidates = connected(edges, "candidates").withColumnsRenamed({"vertex": "content", "root": "candidate"})
    members = candidates.join(texts.drop("bands"), "content")
    sizes = members.groupBy("candidate").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("s") / BLOCK_SHINGLES), F.ceil(F.col("m") / BLOCK_TEXTS)).cast("int")
    members = members.join(sizes, "candidate").withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"))
    members = written(members.select("content", "candidate", "rep", "copies", "blocks", "block"), "members")
    found = written(_links(docs, members, threshold), "links")
    links = found.groupBy("content").agg(F.sum("linked_texts").alias("linked_texts"), F.sum("linked_docs").alias("linked_docs"))
    roots = connected(found.select(F.col("content").alias("a"), F.col("root").alias("b")), "classes")
    classed = texts.select("content", "rep", "copies").join(
        roots.withColumnsRenamed({"vertex": "content"}), "content", "left"
    ).withColumn("root", F.coalesce("root", "content"))
    least = classed.groupBy("root").agg(F.min("rep").alias("class_id"))
    by_text = classed.join(least, "root").join(links, "content", "left").select(
        "content", "root", "class_id", (F.coalesce("linked_docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("linked_texts", F.lit(0)).alias("n_linked_texts"),
    )
    by_text = written(by_text, "by_text")
    out = signed.select("doc_id", "content").join(by_text, "content", "left")
    return out.select(
        "doc_id", "content", "root", F.when(F.col("content").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_linked_texts", F.lit(0)).cast("long").alias("n_linked_texts"),
    )


def _links(docs: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """Compares all pairs of blocks of every candidate class."""

    def sets(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                words, ends = flat_lists(part.column(1))
                made = [shingle_set(words[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary()), *part.columns[2:]], names=names)

    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), text.alias("text"), content_key(text).alias("__content"))
    same = (F.col("__content") == F.col("content")) & F.col("__id").eqNullSafe(F.col("rep"))
    joined = rows.join(members.hint("merge"), same)  # one plan at every size, rather than a broadcast of small tables
    names = ["content", "shingles", "candidate", "copies", "blocks", "block"]
    fields = "content binary, shingles binary, candidate binary, copies long, blocks int, block int"
    full = joined.select("content", word_hashes(text).alias("words"), *names[2:]).mapInArrow(sets, fields)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = full.select("content", "shingles", "candidate", "copies", "block", other.alias("other"))
    paired = paired.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    compared = paired.groupBy("candidate", "i", "j").applyInPandas(
        lambda pdf: _compare(pdf, threshold), "content binary, linked_texts long, linked_docs long, root binary"
    )
    return compared
