"""Repeated passages by relative Lempel-Ziv parsing against indexed reference blocks.

The symbols of a document are its windows of ``WINDOW`` words, so a factor of l symbols is l + WINDOW - 1 equal words
and none is too short to count. A window can only be equal to windows with the same anchor (``word_windows``). So the
reference is dealt to blocks by anchor: a block holds every stretch of text around its anchors, each document is
factored against every block that holds one of its anchors, and no other block can hold a factor of it.

1. Stretches go to their blocks as numbers, without text. A stretch equal to an earlier one is one factor as a whole.
2. The first of each kind, where its anchor has others, is fetched as symbols. A block indexes the first place of
   each of its symbols and factors greedily: a factor goes on as long as its source does; where the source ends, the
   window across that factor boundary is looked up again, so windows over a boundary are not missed.
3. The factors' word ranges, put together by document, are the duplicate spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.llm.common import whole_text, written
from routelens.llm.shingles import mixed
from routelens.llm.word_windows import WINDOW, Stretches, batch_words, stretches, window_hashes

#: Stretches that one block of the reference holds, about.
BLOCK_STRETCHES = 200_000
#: Stretches that a task gathers before it sends the first of each kind on.
GATHERED = 500_000
#: An anchor around which a task sees this share of its distinct stretches is common, and its stretches are cut to single windows.
COMMON_SHARE = 1e-4
COMMON_LEAST = 64
#: Common anchors that every task is told, the most frequent: 8 bytes each. Others only make their block larger.
COMMON_MOST = 200_000
#: The id that a null stands for: it is larger than all others.
NULL_ID = 2**63 - 1

_PLACE = np.dtype([("anchor", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("crc", "<u4"), ("start", "<i4"), ("n", "u1"), ("state", "u1")])
_SYMBOLS = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("crc", "<u4"), ("start", "<i4"), ("n", "u1")])
_LATER, _FIRST, _REPEATS = 0, 1, 2


def _documents(docs: DataFrame) -> DataFrame:
    """``d, crc, text``: the id, and a checksum that tells the texts of rows with one id apart."""
    text = whole_text(F.col("text").cast("string"))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    return docs.select(doc.alias("d"), F.crc32(text.cast("binary")).alias("crc"), text.alias("text"))


def _found(batches, window: int) -> Iterator[tuple[np.ndarray, Stretches, np.ndarray, np.ndarray]]:
    """Stretches of a task's documents: as ``_PLACE`` rows, as they were found, and their batch's words."""
    for batch in batches:
        words, firsts = batch_words(batch.column(2))
        doc, crc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for found in stretches(words, firsts, window):
            rows = np.empty(len(found), _PLACE)
            rows["anchor"], rows["content"], rows["start"], rows["n"] = found.anchor, found.content, found.start, found.n
            rows["doc"], rows["crc"] = doc[found.row], crc[found.row]
            rows["state"] = np.where(found.repeats, _REPEATS, _FIRST)
            yield rows, found, words, firsts


def _gathered(parts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    held, count = [], 0
    for rows in parts:
        held.append(rows)
        count += len(rows)
        if count >= GATHERED:
            yield np.concatenate(held)
            held, count = [], 0
    if count:
        yield np.concatenate(held)


def _groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by anchor, content and place; in that order, where an anchor and where a content begins."""
    order = np.lexsort((rows["start"], rows["doc"], rows["content"], rows["anchor"]))
    anchor, content = rows["anchor"][order], rows["content"][order]
    new_anchor = np.ones(len(rows), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new_content = new_anchor.copy()
    new_content[1:] |= content[1:] != content[:-1]
    return order, new_anchor, new_content


def _later(rows: np.ndarray, order: np.ndarray, new_content: np.ndarray) -> np.ndarray:
    """In ``order``: True where an equal stretch starts earlier. Rows of one id and start are no earlier than each other."""
    first = order[np.maximum.accumulate(np.where(new_content, np.arange(len(order)), 0))]
    return (rows["doc"][order] != rows["doc"][first]) | (rows["start"][order] != rows["start"][first])


def _common_anchors(docs: DataFrame, window: int) -> tuple[int, np.ndarray]:
    """The number of stretches, and anchors around which very many distinct stretches stand.

    Any anchor with more than ``COMMON_SHARE`` of all is over that share in some task's part, so the parts name few.
    """

    def count(batches):
        for rows in _gathered(rows for rows, *_ in _found(batches, window)):
            order, new_anchor, new_content = _groups(rows)
            begin = np.flatnonzero(new_anchor)
            kinds = np.add.reduceat(new_content, begin, dtype=np.int64)
            often = kinds > max(COMMON_LEAST, COMMON_SHARE * len(rows))
            anchors = np.append(rows["anchor"][order][begin][often].view(np.int64), 0)
            total = np.arange(len(anchors)) == len(anchors) - 1
            columns = [pa.array(anchors), pa.array(np.append(kinds[often], len(rows))), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "kinds", "total"])

    counted = written(docs.mapInArrow(count, "anchor long, kinds long, total boolean"), "anchors")
    total = counted.where("total").agg(F.sum("kinds")).first()[0] or 0
    sums = counted.where("NOT total").groupBy("anchor").agg(F.sum("kinds").alias("kinds"))
    common = sums.orderBy(F.desc("kinds"), "anchor").limit(COMMON_MOST).select("anchor").toPandas()
    return total, np.sort(common["anchor"].to_numpy(np.int64).view(np.uint64))


def _is_common(anchors: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.zeros(len(anchors), bool)
    return common[np.minimum(np.searchsorted(common, anchors), len(common) - 1)] == anchors


def _single_windows(
    rows: np.ndarray, found: Stretches, words: np.ndarray, firsts: np.ndarray, common: np.ndarray, window: int
) -> np.ndarray:
    """``rows`` with those of common anchors cut to one window each, whose anchor is a hash of the window."""
    cut = np.flatnonzero(_is_common(rows["anchor"], common))
    if not len(cut):
        return rows
    n = rows["n"][cut].astype(np.int64)
    one = np.repeat(rows[cut], n)
    step = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(firsts[found.row[cut]] + found.start[cut], n) + step
    one["start"] += step.astype(np.int32)
    one["n"], one["state"] = 1, _FIRST
    for name, multiplier in (("anchor", 0x9E3779B97F4A7C15), ("content", 0xD1B54A32D192ED03)):
        total = np.zeros(len(place), np.uint64)
        for i in range(window):
            total = total * np.uint64(multiplier) + words[place + i]
        one[name] = mixed(total)
    return np.concatenate([np.delete(rows, cut), one])


def _by_block(rows: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    order = np.argsort(block, kind="stable")
    names, begin = np.unique(block[order], return_index=True)
    return names, [part.tobytes() for part in np.split(rows[order], begin[1:])]


def _send_stretches(docs: DataFrame, common: np.ndarray, blocks: int, window: int) -> DataFrame:
    """``block, places``: the first of each kind in a task's part goes to its anchor's block.

    The others are later than that one whatever else there is, so they need no comparison and go anywhere: copies
    beyond counting bring one row for each part, not for each copy, to the block of their anchor.
    """

    def send(batches):
        cut = (_single_windows(*found, common, window) for found in _found(batches, window))
        for rows in _gathered(cut):
            order, _, new_content = _groups(rows)
            later = np.empty(len(rows), bool)
            later[order] = _later(rows, order, new_content)
            rows["state"][later] = _LATER
            anywhere = mixed(rows["doc"].view(np.uint64) + rows["start"].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
            names, data = _by_block(rows, (np.where(later, anywhere, rows["anchor"]) % np.uint64(blocks)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(data, pa.binary())], names=["block", "places"])

    return docs.mapInArrow(send, "block long, places binary")


def _judge_stretches(sent: DataFrame, window: int) -> DataFrame:
    """Word ranges of stretches that are one factor, and (``anchor`` not null) stretches that have to be factored."""

    def judge(batches):
        parts = [np.frombuffer(data.as_py(), _PLACE) for batch in batches for data in batch.column(1)]
        if not parts:
            return
        rows = np.concatenate(parts)
        known = rows["state"] == _LATER
        yield _ranges(rows[known], window)
        rows = rows[~known]
        order, new_anchor, new_content = _groups(rows)
        later = _later(rows, order, new_content)
        rows = rows[order]
        yield _ranges(rows[later], window)
        group = np.cumsum(new_anchor) - 1
        kinds = np.bincount(group, weights=new_content)
        rows = rows[~later & ((kinds[group] > 1) | (rows["state"] == _REPEATS))]
        yield _ranges(rows, 0, rows["anchor"].view(np.int64))

    return sent.mapInArrow(judge, "d long, crc long, low int, high int, anchor long")


def _ranges(rows: np.ndarray, more: int, anchor: np.ndarray | None = None) -> pa.RecordBatch:
    """``low`` to ``high``: the words of whole stretches (``more`` is the window), or their windows (0)."""
    high = rows["start"] + rows["n"].astype(np.int32) + np.int32(more - 1 if more else 0)
    anchors = pa.nulls(len(rows), pa.int64()) if anchor is None else pa.array(anchor)
    columns = [pa.array(rows["doc"]), pa.array(rows["crc"].astype(np.int64)), pa.array(rows["start"]), pa.array(high), anchors]
    return pa.RecordBatch.from_arrays(columns, names=["d", "crc", "low", "high", "anchor"])


def _send_symbols(wanted: DataFrame, blocks: int, window: int) -> DataFrame:
    """``block, heads, symbols`` of the wanted stretches; columns of ``wanted``: d, crc, text, list of (low, high, anchor)."""

    def send(batches):
        for batch in batches:
            words, firsts = batch_words(batch.column(2))
            lists = batch.column(3)
            counts = np.array(lists.value_lengths(), np.int64)
            low, high, anchor = (column.to_numpy(zero_copy_only=False) for column in lists.flatten().flatten())
            rows = np.empty(len(low), _SYMBOLS)
            rows["doc"] = np.repeat(batch.column(0).to_numpy(), counts)
            rows["crc"] = np.repeat(batch.column(1).to_numpy(), counts)
            rows["anchor"], rows["start"], rows["n"] = anchor.view(np.uint64), low, high - low
            block = (rows["anchor"] % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            names, begin = np.unique(block[order], return_index=True)
            place = np.repeat(firsts[:-1], counts) + low
            hashes = window_hashes(words, window)
            symbols = []
            for part in np.split(order, begin[1:]):
                n = rows["n"][part].astype(np.int64)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                symbols.append(hashes[np.repeat(place[part], n) + step].tobytes())
            heads = [rows[part].tobytes() for part in np.split(order, begin[1:])]
            columns = [pa.array(names), pa.array(heads, pa.binary()), pa.array(symbols, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "heads", "symbols"])

    return wanted.mapInArrow(send, "block long, heads binary, symbols binary")


def factors(heads: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy factors of a block's stretches: ``(stretch, first symbol, symbols)`` of each, counted in the stretch.

    A symbol's source is the first place in the block, by document and start, that has it. A factor runs as long as
    the sources of its symbols follow each other in one stretch.
    """
    n = heads["n"].astype(np.int64)
    stretch = np.repeat(np.arange(len(heads)), n)
    begin = np.cumsum(n) - n
    step = np.arange(len(symbols)) - begin[stretch]
    doc, at, anchor = heads["doc"][stretch], heads["start"][stretch] + step, heads["anchor"][stretch]
    order = np.lexsort((at, doc, symbols, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (anchor[order[1:]] != anchor[order[:-1]])
    source = np.empty(len(order), np.int64)
    source[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    copied = (doc != doc[source]) | (at != at[source])
    goes_on = np.zeros(len(order), bool)
    goes_on[1:] = copied[1:] & copied[:-1] & (stretch[1:] == stretch[:-1])
    goes_on[1:] &= (source[1:] == source[:-1] + 1) & (stretch[source[1:]] == stretch[source[:-1]])
    first = np.flatnonzero(copied & ~goes_on)
    last = np.flatnonzero(copied & ~np.append(goes_on[1:], False))
    return stretch[first], step[first], last - first + 1


def _factor_ranges(sent: DataFrame, window: int) -> DataFrame:
    def factor(batches):
        heads, symbols = [], []
        for batch in batches:
            heads += [np.frombuffer(data.as_py(), _SYMBOLS) for data in batch.column(1)]
            symbols += [np.frombuffer(data.as_py(), np.uint64) for data in batch.column(2)]
        if not heads:
            return
        head = np.concatenate(heads)
        of, first, count = factors(head, np.concatenate(symbols))
        low = head["start"][of] + first
        columns = [pa.array(head["doc"][of]), pa.array(head["crc"][of].astype(np.int64)), pa.array(low.astype(np.int32)), pa.array((low + count + window - 1).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["d", "crc", "low", "high"])

    return sent.mapInArrow(factor, "d long, crc long, low int, high int")


def duplicate_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``d, crc, low, high``: word ranges (from 0, ``high`` excluded) of ``docs`` that stand earlier in the corpus as well.

    ``d`` is the id, or ``NULL_ID`` for null; ``crc`` the checksum of the text. Ranges may overlap and may be named twice.
    """
    rows = _documents(docs)
    total, common = _common_anchors(rows, window)
    blocks = total // BLOCK_STRETCHES + 1
    sent = _send_stretches(rows, common, blocks, window).repartition(blocks, "block")
    judged = written(_judge_stretches(sent, window), "stretches")
    want = judged.where("anchor IS NOT NULL").groupBy("d", "crc").agg(F.collect_set(F.struct("low", "high", "anchor")).alias("want"))
    wanted = rows.join(want.hint("shuffle_hash"), ["d", "crc"]).select("d", "crc", "text", "want")
    symbols = _send_symbols(wanted, blocks, window).repartition(blocks, "block")
    found = written(_factor_ranges(symbols, window), "factors")
    return judged.where("anchor IS NULL").drop("anchor").unionByName(found)


def drop_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: every row without the words of windows that start earlier elsewhere.

    Earlier means at a smaller ``doc_id``, or in the same document at an earlier start. Null texts have no words; a null
    id is larger than all others. Texts with the same id are one document in this order: equal windows at the same start
    in them are no earlier than each other, so a repeated row changes nothing. Other columns are left out.
    """
    ranges = duplicate_ranges(docs, window)
    spans = ranges.groupBy("d", "crc").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    rows = _documents(docs).join(spans.hint("shuffle_hash"), ["d", "crc"], "left").select("d", "text", "spans")

    def drop(batches):
        for batch in batches:
            sizes, removed, texts = [], [], []
            lists = batch.column(2)
            for text, spans in zip(batch.column(1), lists, strict=True):
                words = text.as_py().encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if spans.is_valid:
                    low, high = (column.to_numpy(zero_copy_only=False) for column in spans.values.flatten())
                    np.add.at(gone, low, 1)
                    np.add.at(gone, high, -1)
                    words_left = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
                else:
                    words_left = words
                sizes.append(len(words))
                removed.append(len(words) - len(words_left))
                texts.append(b" ".join(words_left))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])

    kept = rows.mapInArrow(drop, "doc_id long, n_words long, n_removed long, kept_text string")
    return kept.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
