"""Language of whole texts by a bidirectional gated recurrent network over UTF-8 bytes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.llm.common import first_by_hash, fold_of, whole_text, written

HIDDEN = 8
#: Bytes that the network reads in one run; each run starts from a zero state, in both directions.
RUN = 128
#: Texts of each language that the network learns from if there are at most so many languages, and the longest stretch of a text in
#: characters. With more languages each has fewer texts, but none less than one.
TRAINING_DOCUMENTS, LANGUAGES, TRAINING_CHARS = 300, 64, 20_000
UNDETERMINED = "und"
_EPOCHS, _BATCH, _TRAINING_RUN, _RUNS_OF_A_TEXT = 6, 128, 48, 12


@dataclass(frozen=True)
class Direction:
    """Gates z (how much is new), r (how much of the past enters the candidate), and the candidate n.

    ``zr_in`` (2, 256, H) and ``n_in`` (256, H) are the inputs' parts with the biases, by byte; ``zr``
    (2, H, H) and ``n`` (H, H) those of the state; ``out`` (H, K) goes to the labels.
    """

    zr_in: np.ndarray
    n_in: np.ndarray
    zr: np.ndarray
    n: np.ndarray
    out: np.ndarray


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    forward: Direction
    backward: Direction
    bias: np.ndarray

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Mean over all bytes of a text of the label probabilities at each; (texts, languages)."""
        data = [text.encode("utf-8", "replace") for text in texts]
        runs = np.array([-(-len(d) // RUN) for d in data], np.int64)
        totals = np.zeros((len(texts), len(self.languages)))
        owner = np.repeat(np.arange(len(texts)), runs)
        padded = np.frombuffer(b"".join([d.ljust(n * RUN, b"\0") for d, n in zip(data, runs.tolist(), strict=True)]), np.uint8)
        padded = padded.reshape(-1, RUN)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
        sizes = np.array([len(d) for d in data], np.int64)
        lengths = np.minimum(sizes[owner] - within * RUN, RUN)
        order = np.argsort(-lengths, kind="stable")
        width = max(16, min(1024, 1024 * LANGUAGES // max(len(self.languages), 1)))  # bounds memory where languages are many
        for at in range(0, len(order), width):
            some = order[at : at + width]
            np.add.at(totals, owner[some], self._label_sums(padded[some], lengths[some]))
        return totals / np.maximum(sizes, 1)[:, None]

    def _label_sums(self, runs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        steps = int(lengths.max())
        codes = np.ascontiguousarray(runs[:, :steps].T)
        inside = (np.arange(steps)[:, None] < lengths[None]).astype(np.float32)
        logits = np.empty((steps, len(runs), len(self.languages)), np.float32)
        for t, state in _states(self.forward, codes, None):
            np.matmul(state, self.forward.out, out=logits[t])
        logits += self.bias
        for t, state in _states(self.backward, codes[::-1], inside[::-1]):
            logits[steps - 1 - t] += state @ self.backward.out
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits *= (inside / logits.sum(axis=2))[:, :, None]
        return logits.sum(axis=0)


def _states(net: Direction, codes: np.ndarray, inside: np.ndarray | None):
    """``(step, state after it)``. ``inside`` keeps the state at zero over the padding that a backward run meets first."""
    width, hidden = codes.shape[1], net.n.shape[0]
    state = np.zeros((width, hidden), np.float32)
    gates = np.empty((2, width, hidden), np.float32)
    new = np.empty((width, hidden), np.float32)
    for t in range(len(codes)):
        np.matmul(state, net.zr, out=gates)
        gates += net.zr_in.take(codes[t], axis=1)
        _sigmoid_in_place(gates)
        np.matmul(state, net.n, out=new)
        new *= gates[1]
        new += net.n_in.take(codes[t], axis=0)
        np.tanh(new, out=new)
        new -= state
        new *= gates[0]
        state += new
        if inside is not None and t < len(codes) - 1 and not inside[t].all():
            state *= inside[t][:, None]
        yield t, state


def _sigmoid_in_place(x: np.ndarray) -> None:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5


def _start(rng: np.random.Generator, labels: int) -> dict[str, np.ndarray]:
    h = HIDDEN
    weights: dict[str, np.ndarray] = {"bias": np.zeros(labels)}
    for way in ("f", "b"):
        weights[way + "zr_in"] = rng.normal(0, 0.3, (2, 256, h))
        weights[way + "n_in"] = rng.normal(0, 0.3, (256, h))
        weights[way + "zr"] = rng.normal(0, 0.3, (2, h, h))
        weights[way + "n"] = rng.normal(0, 0.3, (h, h))
        weights[way + "out"] = rng.normal(0, 0.3, (h, labels))
        weights[way + "zr_in"][0] -= 1.0
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _run_forward(w: dict, way: str, codes: np.ndarray):
    """States of one direction with what its gradient needs. ``codes`` is (steps, batch)."""
    state = np.zeros((codes.shape[1], HIDDEN), np.float32)
    kept, states = [], []
    for code in codes:
        gates = state @ w[way + "zr"] + w[way + "zr_in"][:, code]
        _sigmoid_in_place(gates)
        past = state @ w[way + "n"]
        new = np.tanh(gates[1] * past + w[way + "n_in"][code])
        kept.append((state, gates, past, new))
        state = state + gates[0] * (new - state)
        states.append(state)
    return np.stack(states), kept


def _run_backward(w: dict, way: str, codes: np.ndarray, kept: list, from_labels: np.ndarray, grads: dict) -> None:
    """Backpropagation through time: adds to ``grads`` given the loss's slope by each state."""
    slope = np.zeros_like(from_labels[0])
    zr, n = w[way + "zr"], w[way + "n"]
    for t in range(len(codes) - 1, -1, -1):
        state, (z, r), past, new = kept[t]
        slope = slope + from_labels[t]
        by_new = slope * z * (1 - new * new)
        by_z = slope * (new - state) * z * (1 - z)
        by_r = by_new * past * r * (1 - r)
        by_past = by_new * r
        for i, part in ((0, by_z), (1, by_r)):
            grads[way + "zr"][i] += state.T @ part
            np.add.at(grads[way + "zr_in"][i], codes[t], part)
        grads[way + "n"] += state.T @ by_past
        np.add.at(grads[way + "n_in"], codes[t], by_new)
        slope = slope * (1 - z) + by_z @ zr[0].T + by_r @ zr[1].T + by_past @ n.T


def fit(texts: list[str], languages: list[str], seed: int = 7) -> LanguageModel:
    """Learns to name the language at every byte, by Adam on short runs of the texts."""
    names = tuple(sorted(set(languages)))
    rng = np.random.default_rng(seed)
    runs, truth = [], []
    for text, language in zip(texts, languages, strict=True):
        data = text.encode("utf-8", "replace")
        if len(data) < _TRAINING_RUN:
            data = (data + b" ") * (_TRAINING_RUN // (len(data) + 1) + 1)
        for at in rng.integers(0, len(data) - _TRAINING_RUN + 1, _RUNS_OF_A_TEXT):
            runs.append(np.frombuffer(data, np.uint8)[at : at + _TRAINING_RUN])
            truth.append(names.index(language))
    w = _start(rng, len(names))
    if not runs:
        return _finished(names, w)
    codes_of, truth_of = np.stack(runs), np.array(truth)
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    batches = -(-len(codes_of) // _BATCH)
    for epoch in range(_EPOCHS):
        order = rng.permutation(len(codes_of))
        for b in range(batches):
            some = order[b * _BATCH : (b + 1) * _BATCH]
            grads = _gradients(w, codes_of[some].T, truth_of[some])
            step += 1
            rate = 0.015 * (1 - (epoch + b / batches) / _EPOCHS) + 0.0005
            for k in w:
                g = np.clip(grads[k], -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                w[k] -= (rate * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return _finished(names, w)


def _gradients(w: dict, codes: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    ahead, kept_f = _run_forward(w, "f", codes)
    back, kept_b = _run_forward(w, "b", codes[::-1])
    logits = ahead @ w["fout"] + back[::-1] @ w["bout"] + w["bias"]
    slope = np.exp(logits - logits.max(axis=2, keepdims=True))
    slope /= slope.sum(axis=2, keepdims=True)
    slope[:, np.arange(len(truth)), truth] -= 1
    slope /= np.float32(codes.size)
    flat = slope.reshape(-1, slope.shape[2])
    grads["bias"] += flat.sum(axis=0)
    grads["fout"] += ahead.reshape(-1, HIDDEN).T @ flat
    grads["bout"] += back[::-1].reshape(-1, HIDDEN).T @ flat
    _run_backward(w, "f", codes, kept_f, slope @ w["fout"].T, grads)
    _run_backward(w, "b", codes[::-1], kept_b, (slope @ w["bout"].T)[::-1], grads)
    return grads


def _finished(names: tuple[str, ...], w: dict) -> LanguageModel:
    parts = [Direction(*[np.ascontiguousarray(w[way + k]) for k in ("zr_in", "n_in", "zr", "n", "out")]) for way in ("f", "b")]
    return LanguageModel(names, parts[0], parts[1], w["bias"])


def train(docs: DataFrame, folds: int = 4, held_out: int = 2) -> LanguageModel:
    """Fits on ``TRAINING_DOCUMENTS`` different texts of each language outside the held-out fold, or all if there are fewer.

    A hash chooses them among all texts, equal ones of a language counting once; only these reach the driver, of longer
    texts a stretch of ``TRAINING_CHARS`` at a place chosen by the hash. Every language is learned: with more than
    ``LANGUAGES`` each has the fewer texts, but at least one.
    """
    rows = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    rows = rows.where(fold_of(F.col("doc_id"), folds) != held_out).withColumn("__hash", F.xxhash64("lang", "text"))
    distinct = written(rows.select("lang", "__hash").distinct(), "training-texts")
    counts = distinct.groupBy("lang").agg(F.count("*").alias("__n"))
    of_each = max(1, int(TRAINING_DOCUMENTS * min(1.0, LANGUAGES / max(counts.count(), 1))))
    chosen = written(first_by_hash(distinct.join(counts, "lang"), "lang", "__hash", F.lit(of_each)).select("lang", "__hash"), "chosen")
    spare = F.greatest(F.length("text") - TRAINING_CHARS, F.lit(0))
    stretch = F.substring("text", (F.pmod(F.col("__hash"), spare + 1) + 1).cast("int"), F.lit(TRAINING_CHARS))
    chosen = rows.join(chosen, ["lang", "__hash"]).select("lang", "__hash", stretch.alias("text")).dropDuplicates(["lang", "__hash"])
    learned = sorted((row.lang, row.text) for row in chosen.collect())
    return fit([text for _, text in learned], [lang for lang, _ in learned])


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; no shuffle.

    Every byte of the whole text is labelled. A text that is null or has no letter is ``und`` with score 0, and so
    is every text if no language was learned. Of equal probabilities the first language by name wins.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [text or "" for text in part.column(1).to_pylist()]
                lettered = np.array([any(map(str.isalpha, text)) for text in texts], bool)
                names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if model.languages:
                    found = model.probabilities(texts)
                    best = found.argmax(axis=1)
                    names = [model.languages[i] if ok else UNDETERMINED for i, ok in zip(best.tolist(), lettered, strict=True)]
                    scores = np.where(lettered, np.clip(found.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
