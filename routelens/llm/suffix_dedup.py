"""Repeated passages by a sparse suffix array: suffixes at minimisers, sorted, compared with their neighbours, extended both ways.

Where a minimiser has more suffixes than a suffix has neighbours, every passage around it is looked up by its hash instead.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.llm.common import written
from routelens.llm.shingles import content_key, flat_lists, gram_hashes, word_hashes

#: Words of a repeated passage at least, and of the gram that a suffix is chosen by.
PASSAGE, GRAM = 50, 8
#: Neighbours of another text that a suffix is compared with, on each side. A gram with more suffixes is looked up by passages.
NEIGHBOURS = 3
#: Suffixes that one task sorts and compares.
PARTITION_SUFFIXES = 100_000
_SUFFIX = "gram long, after binary, before binary, n_after int, n_before int, content binary, place int, window long"
_SPAN = "content binary, first int, last int"


def minimisers(words: np.ndarray, gram: int = GRAM, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of a text's suffixes: the least hash of every window of grams that a passage holds.

    Equal passages of ``passage`` words have the same least gram, so at least one suffix starts inside every
    copy at the same word. Of equal hashes in a window the leftmost is taken. A shorter text is one window.
    """
    hashes = gram_hashes(words, gram)
    if not len(hashes):
        return np.empty(0, np.int64), hashes
    window = min(passage - gram + 1, len(hashes))
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    chosen = np.unique(_leftmost_least(views) + np.arange(len(views)))
    return chosen, hashes[chosen]


def passages_at(words: np.ndarray, places: np.ndarray, gram: int = GRAM, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of all passages whose minimiser is one of ``places``; none in a text shorter than a passage."""
    if len(words) < passage or not len(places):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    views = np.lib.stride_tricks.sliding_window_view(gram_hashes(words, gram), passage - gram + 1)
    first = np.flatnonzero(np.isin(_leftmost_least(views) + np.arange(len(views)), places))
    return first, gram_hashes(words, passage)[first]


def _leftmost_least(views: np.ndarray) -> np.ndarray:
    out = np.empty(len(views), np.int64)
    for at in range(0, len(views), 20_000):
        out[at : at + 20_000] = views[at : at + 20_000].argmin(axis=1)
    return out


def _contexts(words: np.ndarray, places: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Next and previous ``passage`` words of each place as 32-bit hashes, the nearest first, and how many there are."""
    short = (words >> np.uint64(32)).astype(">u4")
    step = np.arange(passage)
    after, before = places[:, None] + step, places[:, None] - 1 - step
    n_after, n_before = np.minimum(len(words) - places, passage), np.minimum(places, passage)
    right = np.where(after < len(words), short[np.minimum(after, len(words) - 1)], 0).astype(">u4")
    left = np.where(before >= 0, short[np.maximum(before, 0)], 0).astype(">u4")
    return right, left, n_after, n_before


def _places(docs: DataFrame, gram: int, passage: int) -> DataFrame:
    """``doc_id, content, n_words, grams, places, times`` of every row; times is how often the text has each gram among its suffixes."""

    def choose(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                words, ends = flat_lists(part.column(2))
                found = [minimisers(words[a:b], gram, passage) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(np.diff(ends), pa.int64()),
                        pa.array([h.view(np.int64) for _, h in found], pa.list_(pa.int64())),
                        pa.array([p for p, _ in found], pa.list_(pa.int32())),
                        pa.array([_times(h) for _, h in found], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "content", "n_words", "grams", "places", "times"],
                )

    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content_key(text).alias("content"), word_hashes(text).alias("words"))
    return rows.mapInArrow(choose, "doc_id long, content binary, n_words long, grams array<bigint>, places array<int>, times array<int>")


def _times(hashes: np.ndarray) -> np.ndarray:
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return counts[inverse].astype(np.int32)


def compare_neighbours(pdf: pd.DataFrame, passage: int, neighbours: int) -> pd.DataFrame:
    """Spans that suffixes, given in order, share with the nearest suffixes of other texts: the match at the suffix, extended to the left."""
    n = len(pdf)
    empty = pd.DataFrame({"content": [], "first": [], "last": []})
    if n < 2:
        return empty
    grams = pdf["gram"].to_numpy()
    right = np.frombuffer(b"".join(pdf["after"]), ">u4").reshape(n, passage)
    left = np.frombuffer(b"".join(pdf["before"]), ">u4").reshape(n, passage)
    n_right, n_left = pdf["n_after"].to_numpy(np.int64), pdf["n_before"].to_numpy(np.int64)
    places, contents = pdf["place"].to_numpy(np.int64), pdf["content"].to_numpy()
    new_run = np.ones(n, bool)
    new_run[1:] = (contents[1:] != contents[:-1]) | (grams[1:] != grams[:-1])
    run = np.cumsum(new_run) - 1
    starts = np.append(np.flatnonzero(new_run), n)
    out = []
    for step in range(1, neighbours + 1):
        for other in (starts[np.maximum(run - step + 1, 0)] - 1, starts[np.minimum(run + step, len(starts) - 1)]):
            mine = np.flatnonzero((other >= 0) & (other < n))
            theirs = other[mine]
            same = (grams[mine] == grams[theirs]) & (contents[mine] != contents[theirs])
            mine, theirs = mine[same], theirs[same]
            for at in range(0, len(mine), 20_000):
                a, b = mine[at : at + 20_000], theirs[at : at + 20_000]
                ahead = _agreeing(right[a], right[b], np.minimum(n_right[a], n_right[b]))
                back = _agreeing(left[a], left[b], np.minimum(n_left[a], n_left[b]))
                long_enough = ahead + back >= passage
                a, ahead, back = a[long_enough], ahead[long_enough], back[long_enough]
                out.append(pd.DataFrame({"content": contents[a], "first": places[a] - back, "last": places[a] + ahead}))
    return pd.concat(out, ignore_index=True).drop_duplicates() if out else empty


def _agreeing(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1]), most)


def _edges(pdf: pd.DataFrame, neighbours: int) -> pd.DataFrame:
    """Of the first and the last ``neighbours + 1`` texts in a partition's order one suffix each."""
    run = ((pdf["content"] != pdf["content"].shift()) | (pdf["gram"] != pdf["gram"].shift())).cumsum()
    head = pdf[run <= neighbours + 1].groupby(run).head(1)
    tail = pdf[run > run.iloc[-1] - neighbours - 1].groupby(run).tail(1)
    return pd.concat([head, tail]).loc[lambda x: ~x.index.duplicated()].sort_index()


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, gram: int = GRAM, neighbours: int = NEIGHBOURS) -> DataFrame:
    """``doc_id, n_words, n_repeated, spans`` of every row of ``docs(doc_id, text)``; other columns are ignored.

    ``spans`` are the stretches ``[first, last)`` of words that the text shares with a text of different words, in matches of at least
    ``passage`` words; touching ones are one span. ``n_repeated`` counts their words. Words are lower case and split at white space.
    If several rows have the same words, at least ``passage`` of them, the whole text is a span of each. Null, empty
    and shorter texts have none.

    Suffixes whose gram occurs in one text alone are dropped first: they match nothing. Those of a gram with at most
    ``neighbours + 1`` suffixes, each of another text, are sorted over the cluster by gram and the words that follow, in
    partitions of even size, and each is compared with all others of its gram; suffixes at partition edges are compared in a
    second step, a few for each partition. A match longer than the compared words on a side is put together from its
    successive suffixes. Around the suffixes of all other grams every passage is counted by the hash of its words, so none
    is missed, however many texts have the gram and wherever the passages differ.
    """
    chosen = written(_places(docs, gram, passage), "suffixes")
    texts = chosen.where("content IS NOT NULL").groupBy("content").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    texts = written(texts, "texts")
    grams = chosen.select("content", F.explode(F.arrays_zip("grams", "times")).alias("at")).select("content", "at.grams", "at.times")
    shared = grams.groupBy(F.col("grams").alias("gram")).agg(
        F.min("content").alias("a"), F.max("content").alias("b"), F.count("*").alias("n"), F.max("times").alias("times")
    ).where("a <> b").select("gram", ((F.col("n") <= neighbours + 1) & (F.col("times") == 1)).alias("few"))
    owners = chosen.join(texts, (chosen.content == texts.content) & chosen.doc_id.eqNullSafe(texts.rep)).select(
        texts.content, "rep", F.explode(F.arrays_zip("grams", "places")).alias("at")
    )
    kept = owners.select("content", "rep", F.col("at.grams").alias("gram"), F.col("at.places").alias("place")).join(shared, "gram")
    few, many = (F.collect_set(F.when(is_so, F.col("place"))) for is_so in (F.col("few"), ~F.col("few")))
    wanted = written(kept.groupBy("content", "rep").agg(few.alias("few"), many.alias("many")), "wanted")
    around = written(_suffixes(docs, wanted, gram, passage), "suffixes_and_passages")
    table = around.where("window IS NULL").drop("window")
    n = max(1, -(-table.count() // PARTITION_SUFFIXES))
    order = ["gram", "after", "before", "content", "place"]
    ordered = table.repartitionByRange(n, *order).sortWithinPartitions(*order)
    spans = written(_compared(ordered, passage, neighbours), "spans")
    edges = spans.where("edge IS NOT NULL").select("edge.*")
    inner = spans.where("edge IS NULL").select("content", "first", "last")
    across = edges.groupBy().applyInPandas(
        lambda pdf: compare_neighbours(pdf.sort_values(order, ignore_index=True), passage, neighbours), _SPAN
    )
    passages = around.where("window IS NOT NULL").select("window", "content", F.col("place").alias("first"))
    merged = _merged(inner.unionByName(across).unionByName(_repeated(passages, passage)))
    by_text = written(texts.join(merged, "content", "left").select("content", "copies", "spans"), "by_text")
    out = chosen.select("doc_id", "content", "n_words").join(by_text, "content", "left")
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("last")))
    none = F.array().cast("array<struct<first:int,last:int>>")
    found = F.when((F.col("copies") > 1) & (F.col("n_words") >= passage), whole).otherwise(F.coalesce("spans", none))
    out = out.select("doc_id", "n_words", F.inline(F.array(F.struct(found.alias("spans")))))
    repeated = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    return out.select("doc_id", "n_words", repeated.alias("n_repeated"), "spans")


def _suffixes(docs: DataFrame, wanted: DataFrame, gram: int, passage: int) -> DataFrame:
    """The wanted suffixes of every text: those of few with the words around them, those of many as ``window``, the hash of each passage."""
    names = ["gram", "after", "before", "n_after", "n_before", "content", "place", "window"]

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                words, ends = flat_lists(part.column(1))
                few, many = part.column(2).to_pylist(), part.column(3).to_pylist()
                for i, content in enumerate(part.column(0).to_pylist()):
                    own, places = words[ends[i] : ends[i + 1]], np.array(sorted(few[i]), np.int64)
                    right, left, n_after, n_before = _contexts(own, places, passage)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(gram_hashes(own, gram)[places].view(np.int64)),
                            pa.array([row.tobytes() for row in right], pa.binary()), pa.array([row.tobytes() for row in left], pa.binary()),
                            pa.array(n_after, pa.int32()), pa.array(n_before, pa.int32()),
                            pa.array([content] * len(places), pa.binary()), pa.array(places, pa.int32()), pa.nulls(len(places), pa.int64()),
                        ],
                        names=names,
                    )
                    first, hashes = passages_at(own, np.array(many[i], np.int64), gram, passage)
                    for a in range(0, len(first), 20_000):
                        places, window = first[a : a + 20_000], hashes[a : a + 20_000].view(np.int64)
                        rest = [pa.nulls(len(places), kind) for kind in (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32())]
                        own_key = pa.array([content] * len(places), pa.binary())
                        yield pa.RecordBatch.from_arrays([*rest, own_key, pa.array(places, pa.int32()), pa.array(window)], names=names)

    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), text.alias("text"), content_key(text).alias("__content"))
    same = (F.col("__content") == F.col("content")) & F.col("__id").eqNullSafe(F.col("rep"))
    joined = rows.join(wanted.hint("merge"), same).select("content", word_hashes(text).alias("words"), "few", "many")
    return joined.mapInArrow(cut, _SUFFIX)


def _repeated(passages: DataFrame, passage: int) -> DataFrame:
    """``content, first, last`` of the ``passages(window, content, first)`` that another text has too."""
    texts = passages.groupBy("window").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    shared = texts.where("a <> b").select("window")
    found = passages.join(shared.hint("merge"), "window", "left_semi")  # one plan at every size
    return found.select("content", "first", (F.col("first") + passage).cast("int").alias("last"))


def _compared(ordered: DataFrame, passage: int, neighbours: int) -> DataFrame:
    """Spans found inside partitions, with ``edge`` null, and the suffixes at their edges."""
    kind = f"{_SPAN}, edge struct<gram:bigint,after:binary,before:binary,n_after:int,n_before:int,content:binary,place:int>"
    fields = ["gram", "after", "before", "n_after", "n_before", "content", "place"]

    def compare(batches):
        parts = list(batches)
        pdf = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()
        if len(pdf):
            yield compare_neighbours(pdf, passage, neighbours).assign(edge=None)
            edges = _edges(pdf, neighbours)[fields]
            yield pd.DataFrame({"content": edges["content"], "first": 0, "last": 0, "edge": edges.to_dict("records")})

    return ordered.mapInPandas(compare, kind)


def _merged(spans: DataFrame) -> DataFrame:
    """``content, spans``: touching spans of a text become one. A text's spans are bounded by its suffixes."""
    listed = spans.groupBy("content").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("all"))
    kind = "array<struct<first:int,last:int>>"

    def add(done, span):
        last = F.element_at(done, -1)
        grown = F.concat(
            F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last")))
        )
        return F.when(F.size(done) == 0, F.array(span)).when(span["first"] <= last["last"], grown).otherwise(F.concat(done, F.array(span)))

    return listed.select("content", F.aggregate("all", F.array().cast(kind), add).alias("spans"))
