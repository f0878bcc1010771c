"""Toxicity by compression distance: two zstandard dictionaries and windows of text.

A window of toxic text compresses better once the compressor also knows toxic phrases. The ordinary
dictionary is trained on windows of ordinary documents. The toxic one is trained on the phrases by which
toxic documents stand out. It is put before the ordinary one, because toxic documents are otherwise
ordinary prose, and there it leaves the distances to ordinary phrases, and so their cost, as they are. A window's gain is the bytes saved by the toxic dictionary. Each gain
counts by how much more often windows of toxic documents have it. Documents are judged by the stretch of windows
where these counts add up to most, against what chance gives in a text of so many windows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from routelens.llm.common import first_by_hash, fold_of, per_worker, whole_text, written

WINDOW, STRIDE = 48, 32
#: Labelled documents that the model is fitted on, by class, and the characters that all of a class have at most. Where texts are
#: long, fewer are chosen; one with more than a tenth of its class's characters is never among them.
TRAINING_DOCUMENTS, TRAINING_CHARS = {0: 6_000, 1: 2_000}, {0: 60_000_000, 1: 20_000_000}
#: Gains from here on count alike.
MOST_GAIN = 12
LEAST_RATIO = 24.0
ORDINARY_BYTES, TOXIC_BYTES = 24_576, 6_144
_STEM = 5
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries, the log-likelihood ratio of each gain, and score by the stretch of windows with the largest sum of them."""

    ordinary: bytes
    toxic: bytes
    ratios: tuple[float, ...]
    weight: float
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        evidence = _evidence(window_gains(self, texts), len(texts), self.ratios)
        return _sigmoid(self.weight * np.log1p(evidence) + self.bias)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _levels(gains: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Gains from 0 to ``MOST_GAIN``, and which windows count: of two in a row that share a phrase only the first."""
    owner, gain = gains
    counts = np.ones(len(gain), bool)
    counts[1:] = (owner[1:] != owner[:-1]) | (gain[1:] != gain[:-1]) | (gain[1:] <= 0)
    return np.clip(gain, 0, MOST_GAIN), counts


def _ratios(level: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Log of the share of each gain among windows of toxic documents over that among ordinary ones; no larger gain counts less."""
    shares = []
    for some in (toxic, ~toxic):
        count = np.bincount(level[some], minlength=MOST_GAIN + 1) + 0.5
        shares.append(np.log(count / count.sum()))
    return tuple(np.maximum.accumulate(shares[0] - shares[1]).tolist())


def _evidence(gains: tuple[np.ndarray, np.ndarray], n: int, ratios: tuple[float, ...]) -> np.ndarray:
    """The largest sum of ratios over a stretch of each text's windows, less the log of their number, at least 0.

    Among ``w`` ordinary windows a sum of ``log(w) + x`` is met by chance with a probability of the order ``exp(-x)``, whatever ``w``.
    """
    level, counts = _levels(gains)
    sums = np.concatenate([[0.0], np.cumsum(np.where(counts, np.array(ratios)[level], 0.0))])
    ends = np.searchsorted(gains[0], np.arange(n + 1))
    best = np.zeros(n)
    for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        best[i] = (sums[a : b + 1] - np.minimum.accumulate(sums[a : b + 1])).max()
    return np.maximum(best - np.log(np.maximum(np.diff(ends), 1)), 0.0)


def windows(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts in lower case end to end, each with a blank on both sides; ``(start, length)`` and text of each window.

    The last window of a text ends where the text ends, so that all windows of a text have the same length if it is long enough.
    """
    data = [b" " + text.lower().encode("utf-8", "replace") + b" " for text in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    counts = np.maximum(1, 1 + -(-(sizes - WINDOW) // STRIDE))
    owner = np.repeat(np.arange(len(data)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.minimum(within * STRIDE, np.maximum(sizes[owner] - WINDOW, 0))
    spans = np.empty((len(owner), 2), "<u8")
    spans[:, 0] = start + (np.cumsum(sizes) - sizes)[owner]
    spans[:, 1] = np.minimum(sizes, WINDOW)[owner]
    return b"".join(data), spans, owner


@per_worker
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, window_log=17, hash_log=15, chain_log=15, search_log=4,
        min_match=5, target_length=16, strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_dict_id=0,
    )
    known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=parameters)


def _lengths(dictionary: bytes, data: bytes, spans: np.ndarray) -> np.ndarray:
    parts = zstandard.BufferWithSegments(data, spans.tobytes())
    made = _compressor(dictionary).multi_compress_to_buffer(parts, threads=0)
    return np.array([len(made[i]) for i in range(len(made))], np.int64)


def window_gains(model: ToxicityModel, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bytes gained)`` of every window of every text, a hundred texts at a time."""
    both = model.toxic + model.ordinary
    owners, gains = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(texts), 100):
        data, spans, owner = windows(texts[at : at + 100])
        owners.append(owner + at)
        gains.append(_lengths(model.ordinary, data, spans) - _lengths(both, data, spans))
    return np.concatenate(owners), np.concatenate(gains)


def _stems(text: str) -> set[str]:
    return {word[:_STEM] for word in _WORD.findall(text.lower())}


def standing_out(ordinary: list[str], toxic: list[str]) -> set[str]:
    """Word beginnings whose share among toxic documents is higher by more than chance explains.

    The test is the likelihood ratio of one share against two; its bound keeps chance finds
    among some 100,000 beginnings below one.
    """
    bad, good = Counter(), Counter()
    ordinary, toxic = one_of_each_family(ordinary), one_of_each_family(toxic)
    for text in toxic:
        bad.update(_stems(text))
    for text in ordinary:
        good.update(_stems(text))
    n, m = len(toxic), len(ordinary)
    return {s for s, k in bad.items() if k * m > 4 * good[s] * n and _ratio(k, n, good[s], m) > LEAST_RATIO}


def one_of_each_family(texts: list[str]) -> list[str]:
    """The texts without those that share a least hash of word pairs with an earlier one, so that copies of one text do not count as evidence."""
    seen: set[tuple[int, int]] = set()
    out = []
    for text in texts:
        words = text.lower().split()
        pairs = {f"{a} {b}".encode() for a, b in zip(words, words[1:], strict=False)}
        marks = {(seed, min(zlib.crc32(p, seed) for p in pairs)) for seed in (1, 2, 3, 4)} if pairs else set()
        if not marks & seen:
            out.append(text)
        seen |= marks
    return out


def _ratio(k: int, n: int, j: int, m: int) -> float:
    def fit(x, of, share):
        return (x * math.log(share) if x else 0) + ((of - x) * math.log(1 - share) if of > x else 0)

    both = (k + j) / (n + m)
    return 2 * (fit(k, n, k / n) + fit(j, m, j / m) - fit(k, n, both) - fit(j, m, both))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    joined = b"".join(samples)
    if len(joined) <= size:
        return joined.rjust(8)
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return joined[:size]


def fit(ordinary: list[str], toxic: list[str]) -> ToxicityModel:
    """Trains both dictionaries, and calibrates the ratios and the score.

    Every second ordinary text trains the dictionary, the others calibrate: a text in the dictionary gains less than an unseen one.
    """
    marks = standing_out(ordinary, toxic)
    phrases = []
    for text in toxic:
        words = [w.group() for w in _WORD.finditer(text.lower()) if w.group()[:_STEM] in marks]
        if words:
            phrases.append((" " + " ".join(words) + " ").encode())
    prose = []
    for text in ordinary[::2]:
        data, spans, _ = windows([text])
        prose += [data[a : a + n] for a, n in spans[::4].tolist()]
    model = ToxicityModel(_dictionary(prose, ORDINARY_BYTES), _dictionary(phrases, TOXIC_BYTES), (0.0,) * (MOST_GAIN + 1), 0.0, -1.0)
    ordinary = ordinary[1::2] or ordinary
    texts = ordinary + toxic
    truth = np.repeat([0.0, 1.0], [len(ordinary), len(toxic)])
    if not ordinary or not toxic:
        return model
    gains = window_gains(model, texts)
    level, counts = _levels(gains)
    ratios = _ratios(level[counts], gains[0][counts] >= len(ordinary))
    weight, bias = _logistic(np.log1p(_evidence(gains, len(texts), ratios)), truth)
    return ToxicityModel(model.ordinary, model.toxic, ratios, weight, bias)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """One weight and a bias by Newton's method, the rarer class weighted by the root of its rarity, a small ridge on the weight."""
    share = np.where(y > 0, np.sqrt((1 - y).sum() / max(y.sum(), 1)), 1.0)
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(40):
        p = _sigmoid(design @ w)
        slope = design.T @ (share * (p - y)) + np.array([0.1, 0.0]) * w
        bend = (design * (share * p * (1 - p))[:, None]).T @ design + np.diag([0.1, 1e-6])
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.0)), float(w[1])


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> ToxicityModel:
    """Fits on ``TRAINING_DOCUMENTS`` different labelled texts of each class outside the held-out fold, or all if there are fewer.

    A hash of the text chooses them among all, equal texts counting once, fewer where together they would have more than
    ``TRAINING_CHARS`` characters. They reach the driver whole. Ids and texts with contradicting labels teach nothing.
    The order in which rows arrive changes nothing.
    """
    known = labels.where(F.col("toxic").isin(0, 1)).where(fold_of(F.col("doc_id"), folds) != held_out)
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("__most")).where("toxic = __most").drop("__most")
    texts = docs.select("doc_id", "text").where(F.length("text") > 0).withColumn("__hash", F.xxhash64("text"))
    sized = texts.select("doc_id", "__hash", F.length("text").cast("long").alias("__chars")).join(known, "doc_id")
    different = sized.groupBy("__hash").agg(
        F.min("doc_id").alias("doc_id"), F.max("__chars").alias("__chars"), F.min("toxic").alias("toxic"), F.max("toxic").alias("__most")
    )
    budget = F.when(F.col("toxic") == 1, TRAINING_CHARS[1]).otherwise(TRAINING_CHARS[0])
    different = different.where("toxic = __most").where(F.col("__chars") <= budget / 10).drop("__most")
    different = written(different, "labelled")
    counts = {r.toxic: r for r in different.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("__chars").alias("chars")).collect()}
    total, most = F.lit(0), F.lit(0)
    for toxic, row in counts.items():
        documents = min(TRAINING_DOCUMENTS[toxic], row.n, max(1, row.n * TRAINING_CHARS[toxic] // row.chars))
        total = F.when(F.col("toxic") == toxic, row.n).otherwise(total)
        most = F.when(F.col("toxic") == toxic, documents).otherwise(most)
    drawn = first_by_hash(different.withColumn("__n", total), "toxic", "__hash", most)
    so_far = F.sum("__chars").over(Window.partitionBy("toxic").orderBy("__place"))
    drawn = written(drawn.withColumn("__chars_so_far", so_far).where(F.col("__chars_so_far") <= budget).select("doc_id", "__hash", "toxic"), "drawn")
    rows = texts.join(drawn, ["doc_id", "__hash"]).dropDuplicates(["__hash"])
    found: dict[int, list[str]] = {0: [], 1: []}
    for row in rows.select("toxic", "text").collect():
        found[row.toxic].append(row.text)
    return fit(sorted(found[0], key=_by_content), sorted(found[1], key=_by_content))


def _by_content(text: str) -> tuple[int, str]:
    return zlib.crc32(text.encode("utf-8", "replace")), text


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) in place of columns so named; no shuffle.

    Every window of every whole text is compared. A null text is an empty one; empty texts have the score of no
    evidence. Repeated rows are scored one by one.
    """
    constants = model

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                texts = [text or "" for text in batch.column(0).slice(at, 200).to_pylist()]
                rest = batch.slice(at, 200)
                values = pa.array(constants.scores(texts), pa.float64())
                yield pa.RecordBatch.from_arrays([*rest.columns[1:], values], names=[*kept, "score"])

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(whole_text(F.col("text")).alias("__text"), *[F.col(f"`{c}`") for c in kept])
    fields = rows.drop("__text").schema.add("score", "double", False)
    scored = rows.mapInArrow(run, fields)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
