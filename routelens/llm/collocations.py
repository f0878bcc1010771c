"""Collocations: phrases counted in tiles of frequency-ranked ids, and scored by their weakest cut.

Words are ranked by frequency. Neighbouring words are two ids, a cell of a square that is cut into tiles: a tile with
many pairs is counted by its cells' addresses (``bincount``), one with few as sorted coordinates. Pairs that are
frequent enough are ranked in turn, and (pair, next word) is counted in the same way.

Ranks are told to all tasks and so are bounded in number (``WORD_IDS``, ``PAIR_IDS``). A word beyond them goes by its hash
instead, as sorted coordinates; if none is beyond them, words without an id are known to be too rare and are left out.
No two words share a hash: the dictionary is looked through for that, and a second seed taken if they do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routelens.llm.common import whole_text, written
from routelens.llm.shingles import mixed
from routelens.llm.word_windows import chunk_words, row_offsets, text_chunks

MIN_COUNT, TOP = 10, 2000
#: A phrase goes if a longer one that holds it has this percentage of its places.
ABSORBED_PERCENT = 50
SCORE_UNIT = 1_000_000
#: Ids that words and pairs get at most: 8 bytes each in every task.
WORD_IDS, PAIR_IDS = 1 << 20, 1 << 22
#: Ids along a tile's side; a tile with a pair for every so many cells is counted by address.
TILE_SIDE, CELLS_A_PAIR = 512, 8
#: Pairs or triples that a task counts at once, distinct words that it holds, and rows that it hands over together.
GATHERED, GATHERED_WORDS, HANDED = 500_000, 300_000, 50_000
#: Parts of a language that are ranked by themselves first.
RANKED_PARTS = 64
_KEY_BIT = np.uint64(1 << 62)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(b".,;:!?\n\v\f\r")] = True
_ENDS_WORD = _ENDS_PIECE.copy()
_ENDS_WORD[[9, 32]] = True


@dataclass
class _Tokens:
    """Words of a part of a batch: their key, piece (equal for words of one piece), language and bytes."""

    key: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    data: bytes
    start: np.ndarray
    end: np.ndarray


def _tokens(batch: pa.RecordBatch, seed: int) -> Iterator[_Tokens]:
    """Lower-cased words of column 1 in the languages of column 0."""
    langs = batch.column(0).dictionary_encode()
    codes = langs.indices.to_numpy().astype(np.int64)
    salts = np.array([_number(name) for name in langs.dictionary.to_pylist()], np.uint64)
    offsets, pieces = row_offsets(batch.column(1)), 0
    for at, raw, breaks in text_chunks(batch.column(1), _ENDS_WORD):
        data = _LOWER[raw]
        hashes, start, end = chunk_words(data, breaks, _ENDS_WORD)
        ended = np.cumsum(_ENDS_PIECE[data])
        row = np.searchsorted(offsets, start + at, side="right") - 1
        lang = codes[row]
        key = mixed(hashes + mixed(salts[lang] + np.uint64(seed))) >> np.uint64(2) | _KEY_BIT
        yield _Tokens(key.view(np.int64), pieces + ended[start] + row, lang, data.tobytes(), start, end)
        pieces += int(ended[-1]) if len(ended) else 0


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text(F.col("text")).alias("text"))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each was first, and the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    found = keys[order]
    begin = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)
    return found[begin], order[begin], np.add.reduceat(counts[order], begin) if len(begin) else np.empty(0, np.int64)


def _words(docs: DataFrame, seed: int) -> DataFrame:
    """``key, lang, word, n`` of all words of all languages."""

    def count(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            names = batch.column(0).dictionary_encode().dictionary.to_pylist()
            for tokens in _tokens(batch, seed):
                keys, first, counts = _summed(tokens.key, np.ones(len(tokens.key), np.int64))
                words = [tokens.data[a:b] for a, b in zip(tokens.start[first].tolist(), tokens.end[first].tolist(), strict=True)]
                held.append((keys, counts, words, [names[i] for i in tokens.lang[first].tolist()]))
                size += len(keys)
                if size > GATHERED_WORDS:
                    yield release(held)
                    held, size = [], 0
        if held:
            yield release(held)

    def release(held):
        keys, first, counts = _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        words, langs = [w for h in held for w in h[2]], [name for h in held for name in h[3]]
        first = first.tolist()
        columns = [pa.array(keys), pa.array([langs[i] for i in first], pa.string()), pa.array([words[i] for i in first], pa.binary()).cast(pa.string()), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "lang", "word", "n"])

    parts = docs.mapInArrow(count, "key long, lang string, word string, n long")
    return parts.repartition("key").groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))


def _ranked_words(docs: DataFrame) -> DataFrame:
    """The dictionary, with a seed under which every word has a key of its own."""
    seed = 0
    while True:
        words = written(_words(docs, seed), "words")
        if not words.groupBy("key").agg(F.count("*").alias("words")).where("words > 1").take(1):
            return words.withColumn("seed", F.lit(seed))
        seed += 1


class _Ranks:
    """Ids below ``most`` of values by their rank, the most frequent first; ``complete`` if nothing frequent is left without one."""

    def __init__(self, ranked: np.ndarray, most: int, complete: bool):
        self.most = most
        self._order = np.argsort(ranked, kind="stable").astype(np.int32)
        self._sorted = ranked[self._order]
        self.complete = complete

    def ranked(self) -> np.ndarray:
        """The values by their id."""
        values = np.empty_like(self._sorted)
        values[self._order] = self._sorted
        return values

    def of(self, values: np.ndarray) -> np.ndarray:
        """The id of each value, -1 where it has none."""
        if not len(self._sorted):
            return np.full(len(values), -1, np.int64)
        place = np.minimum(np.searchsorted(self._sorted, values), len(self._sorted) - 1)
        return np.where(self._sorted[place] == values, self._order[place].astype(np.int64), np.int64(-1))


def _rank(frame: DataFrame, value: Column, most: int) -> _Ranks:
    """The most frequent values of ``frame``, as many as have one of the largest counts and are at most ``most``."""
    total, least = frame.count(), 0
    if total > most:
        above = F.sum("values").over(Window.orderBy(F.desc("n")))
        sizes = frame.groupBy("n").agg(F.count("*").alias("values")).withColumn("above", above)
        least = sizes.where(F.col("above") <= most).agg(F.min("n")).first()[0]
    told = frame.where(F.lit(least is not None) & (F.col("n") >= F.lit(least))).select(value.alias("value"), "n").toArrow()
    values, n = (told.column(i).to_numpy() for i in (0, 1))
    return _Ranks(values[np.lexsort((values, -n))].astype(np.int64), most, total <= most)


def count_cells(rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row id, column id, count)`` of every pair of ids that occurs, tile by tile."""
    tile = (rows // TILE_SIDE << 32) | columns // TILE_SIDE
    order = np.argsort(tile, kind="stable")
    rows, columns, tile = rows[order], columns[order], tile[order]
    begin = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])) if len(tile) else np.empty(0, np.int64)
    size = np.diff(np.append(begin, len(tile)))
    dense = size * CELLS_A_PAIR >= TILE_SIDE * TILE_SIDE
    found = []
    for at, n in zip(begin[dense].tolist(), size[dense].tolist(), strict=True):
        top, left = rows[at] // TILE_SIDE * TILE_SIDE, columns[at] // TILE_SIDE * TILE_SIDE
        cells = np.bincount((rows[at : at + n] - top) * TILE_SIDE + columns[at : at + n] - left, minlength=TILE_SIDE * TILE_SIDE)
        used = np.flatnonzero(cells)
        found.append((top + used // TILE_SIDE, left + used % TILE_SIDE, cells[used]))
    sparse = np.repeat(~dense, size)
    rows, columns = rows[sparse], columns[sparse]
    found.append(count_coordinates(rows, columns))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def count_coordinates(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct rows of ``columns`` by sorting them, and how often each occurs."""
    order = np.lexsort(columns[::-1])
    columns = tuple(c[order] for c in columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    begin = np.flatnonzero(new)
    return *(c[begin] for c in columns), np.diff(np.append(begin, len(order)))


def _runs(batch: pa.RecordBatch, seed: int, words: _Ranks, length: int) -> Iterator[list[np.ndarray]]:
    """The words at each of ``length`` places in a row within a piece: an id, or the key of a word that has none."""
    held = None
    for tokens in _tokens(batch, seed):
        ids = words.of(tokens.key)
        values = np.where(ids >= 0, ids, np.int64(-1) if words.complete else tokens.key)
        piece = tokens.piece
        if held is not None:
            values, piece = np.concatenate([held[0], values]), np.concatenate([held[1], piece])
        n = len(values) - length + 1
        if n > 0:
            inside = piece[length - 1 :] == piece[:n]
            for i in range(length):
                inside &= values[i : i + n] >= 0
            yield [values[i : i + n][inside] for i in range(length)]
        held = values[max(0, len(values) - length + 1) :], piece[max(0, len(piece) - length + 1) :]


def _counted(docs: DataFrame, seed: int, length: int, words: _Ranks, cells: Callable, keep: Callable) -> DataFrame:
    """``w1 .. wN, n``: how often each run of ``length`` words that ``keep`` lets through occurs."""
    names = [f"w{i + 1}" for i in range(length)]

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for run in _runs(batch, seed, words, length):
                held.append(keep(run))
                size += len(held[-1][0])
                if size >= GATHERED:
                    yield from release(held)
                    held, size = [], 0
        if size:
            yield from release(held)

    def release(held):
        for found in cells([np.concatenate(parts) for parts in zip(*held, strict=True)]):
            for at in range(0, len(found[0]), HANDED):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + HANDED]) for c in found], names=[*names, "n"])

    parts = docs.mapInArrow(count, ", ".join(f"{name} long" for name in (*names, "n")))
    return parts.groupBy(*names).agg(F.sum("n").alias("n"))


def _pairs(docs: DataFrame, seed: int, words: _Ranks) -> DataFrame:
    def cells(run):
        ranked = (run[0] < words.most) & (run[1] < words.most)
        yield count_cells(run[0][ranked], run[1][ranked])
        yield count_coordinates(run[0][~ranked], run[1][~ranked])

    return _counted(docs, seed, 2, words, cells, lambda run: run)


def _triples(docs: DataFrame, seed: int, words: _Ranks, pairs: _Ranks) -> DataFrame:
    most = words.most

    def keep(run):
        """The run and its first pair's id. Triples with a pair that is known to be rare are left out."""
        ranked = [word < most for word in run]
        ids = [np.where(ranked[i] & ranked[i + 1], pairs.of(run[i] * most + run[i + 1]), -1) for i in (0, 1)]
        if not pairs.complete:
            return [*run, ids[0]]
        stays = ((ids[0] >= 0) | ~(ranked[0] & ranked[1])) & ((ids[1] >= 0) | ~(ranked[1] & ranked[2]))
        return [column[stays] for column in (*run, ids[0])]

    def cells(run):
        ranked = (run[3] >= 0) & (run[2] < most)
        pair, last, n = count_cells(run[3][ranked], run[2][ranked])
        pair = pairs.ranked()[pair]
        yield pair // most, pair % most, last, n
        yield count_coordinates(*[column[~ranked] for column in run[:3]])

    return _counted(docs, seed, 3, words, cells, keep)


def _score(a: str, left: str, right: str) -> Column:
    """Whole numbers of up to 38 digits, so that no product overflows and nothing is rounded."""
    wide = "CAST({} AS DECIMAL(38, 0))".format
    return F.expr(f"CAST(({wide(a)} * {wide(a)} * {SCORE_UNIT}) div ({wide(left)} * {wide(right)}) AS BIGINT)")


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, word_ids: int = WORD_IDS, pair_ids: int = PAIR_IDS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two or three words of each language.

    Texts lose the case of A to Z and are split into pieces at ``.,;:!?`` and line ends, and those into words at blanks and
    tabs. ``a`` is the phrase's places, ``l`` and ``r`` those of the parts of its weakest cut, ``n`` the language's words, score
    the whole part of 1,000,000 a a / (l r). Null texts are empty; a null language is ``und``; rows alike count each; other
    columns are left out. Every document is counted in full, whatever number of ids is told to tasks.
    """
    rows = _documents(docs)
    dictionary = _ranked_words(rows)
    seed = dictionary.select("seed").first()
    seed = seed[0] if seed else 0
    totals = dictionary.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = written(dictionary.where(F.col("n") >= min_count).drop("seed"), "frequent-words")
    words = _rank(frequent, F.col("key"), word_ids)
    known = written(frequent.mapInArrow(_with_ids(words), "w long, lang string, word string, n long"), "word-ids")
    pairs = written(_pairs(rows, seed, words).where(F.col("n") >= min_count), "pairs")
    coded = pairs.where((F.col("w1") < word_ids) & (F.col("w2") < word_ids))
    codes = coded.select((F.col("w1") * word_ids + F.col("w2")).alias("code"), "n")
    pair_ranks = _rank(codes, F.col("code"), pair_ids)
    triples = written(_triples(rows, seed, words, pair_ranks).where(F.col("n") >= min_count), "triples")
    kept = _candidates(pairs, triples, known)
    named = written(_named(kept, known, totals), "phrases")
    order = (F.desc("score"), F.desc("a"), "phrase")
    parts = named.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    parts = parts.withColumn("rank", first).where(F.col("rank") <= top)  # so that no task ranks all of a language
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _with_ids(words: _Ranks) -> Callable:
    def tell(batches):
        for batch in batches:
            key = batch.column(0).to_numpy()
            ids = words.of(key)
            yield pa.RecordBatch.from_arrays([pa.array(np.where(ids >= 0, ids, key)), *batch.columns[1:]], names=["w", "lang", "word", "n"])

    return tell


def _candidates(pairs: DataFrame, triples: DataFrame, known: DataFrame) -> DataFrame:
    """``w1, w2, w3, a, l, r, score`` of the phrases that no longer one absorbs."""

    def times(name: str, alias: str) -> DataFrame:
        return known.select(F.col("w").alias(name), F.col("n").alias(alias))

    def pair_times(first: str, second: str, alias: str) -> DataFrame:
        return pairs.select(F.col("w1").alias(first), F.col("w2").alias(second), F.col("n").alias(alias))

    longer = triples.select("w1", "w2", "n").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n"))
    longer = longer.groupBy("w1", "w2").agg(F.max("n").alias("longest"))
    two = pairs.withColumnRenamed("n", "a").join(longer, ["w1", "w2"], "left")
    two = two.where(f"longest IS NULL OR 100 * longest < {ABSORBED_PERCENT} * a")
    two = two.join(times("w1", "l"), "w1").join(times("w2", "r"), "w2")
    two = two.select("w1", "w2", F.lit(None).cast("long").alias("w3"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    three = triples.withColumnRenamed("n", "a").join(pair_times("w1", "w2", "l2"), ["w1", "w2"]).join(pair_times("w2", "w3", "r1"), ["w2", "w3"])
    three = three.join(times("w1", "l1"), "w1").join(times("w3", "r2"), "w3")
    three = three.withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2"))
    second = F.col("s2") < F.col("s1")
    cut = [F.when(second, F.col(f"{name}2")).otherwise(F.col(f"{name}1")).alias(to) for name, to in (("l", "l"), ("r", "r"), ("s", "score"))]
    return two.unionByName(three.select("w1", "w2", "w3", "a", *cut))


def _named(phrases: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    def word(i: int) -> DataFrame:
        return known.select(F.col("w").alias(f"w{i}"), F.col("word").alias(f"t{i}"), *([F.col("lang")] if i == 1 else []))

    named = phrases.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3", "left").join(totals, "lang")
    return named.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", "l", "r", F.col("total").alias("n"), "score")
