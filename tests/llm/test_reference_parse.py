"""Repeated passages by factoring against reference blocks, next to a comparison of all windows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from routelens.llm import reference_parse
from routelens.llm.reference_parse import _SYMBOLS, drop_repeated_words, factors
from routelens.llm.word_windows import STRETCH, batch_words, stretches


def brute(rows, window=20):
    """Every window of every row against all others, by id (null last) and start."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    order = [float("inf") if doc is None else doc for doc, _ in rows]
    first = {}
    for doc, words in zip(order, texts, strict=True):
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            first[key] = min(first.get(key, (doc, at)), (doc, at))
    found = []
    for (doc_id, _), doc, words in zip(rows, order, texts, strict=True):
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] != (doc, at):
                gone.update(range(at, at + window))
        found.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(found, key=repr)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def _corpus(seed=1, docs=60):
    rng = random.Random(seed)
    passages = [[f"p{rng.randrange(40)}" for _ in range(rng.randrange(15, 90))] for _ in range(8)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rng.randrange(5)):
            part = rng.choice([rng.choice(passages), [f"w{rng.randrange(300)}" for _ in range(rng.randrange(60))]])
            low = rng.randrange(len(part) + 1) if rng.random() < 0.4 else 0
            words += part[low : low + rng.randrange(1, 100)]
        rows.append((rng.randrange(1000) if rng.random() < 0.9 else i, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


ODD = [
    (5, None), (6, ""), (7, " \n "), (8, "a " * 19), (9, "a " * 20), (10, "a " * 500), (11, "a b " * 200), (12, "b a " * 90),
    (None, "z " * 30), (None, "é ü " * 30), (10, "a " * 500), (10, "a " * 300 + "c"), (13, "x y z " * 25),
]


@pytest.mark.parametrize("seed", [1, 2])
def test_as_all_windows_compared(spark, documents, seed):
    rows = _corpus(seed) + (ODD if seed == 1 else [])
    assert found(drop_repeated_words(documents(rows, extra=["text_", "d", "crc", "spans", "want"]))) == brute(rows)


def test_common_anchors_and_many_blocks_change_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(reference_parse, "COMMON_SHARE", 0.0)
    monkeypatch.setattr(reference_parse, "COMMON_LEAST", 2)
    monkeypatch.setattr(reference_parse, "BLOCK_STRETCHES", 30)
    monkeypatch.setattr(reference_parse, "GATHERED", 25)
    rows = _corpus(3) + ODD
    cut = reference_parse._common_anchors(reference_parse._documents(documents(rows)), 20)[1]
    assert len(cut) > 5
    assert found(drop_repeated_words(documents(rows))) == brute(rows)


def test_other_window_and_a_passage_across_a_factor_boundary(spark, documents):
    left, right = [f"l{i}" for i in range(30)], [f"r{i}" for i in range(30)]
    rows = [(1, " ".join(left)), (2, " ".join(right)), (3, " ".join(left[-10:] + right[:10])), (4, " ".join(left + right))]
    assert found(drop_repeated_words(documents(rows))) == brute(rows)
    assert found(drop_repeated_words(documents(rows), 8)) == brute(rows, 8)


def test_no_rows_and_no_words(spark, documents):
    assert drop_repeated_words(documents([])).collect() == []
    assert found(drop_repeated_words(documents([(1, None), (2, "")]))) == [(1, 0, 0, ""), (2, 0, 0, "")]


def test_a_large_group_of_copies_sends_few_rows(spark, documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = reference_parse._documents(documents([(i, text) for i in range(3000)]).coalesce(2))
    _, common = reference_parse._common_anchors(docs, 20)
    sent = reference_parse._send_stretches(docs, common, 1, 20).collect()
    places = np.concatenate([np.frombuffer(r.places, reference_parse._PLACE) for r in sent])
    each = len(np.unique(places["content"]))
    assert (places["state"] != 0).sum() <= 2 * each and len(places) == 3000 * each


def test_words_of_long_texts_and_rows_in_chunks(monkeypatch):
    from routelens.llm import word_windows

    texts = ["one two", "", "x" * 50 + " y", None, "tailé   end", "a b c d e f g h i j" * 9, "last"]
    whole, firsts = batch_words(pa.array(texts))
    expected = [(t or "").encode().split() for t in texts]
    assert np.diff(firsts).tolist() == [len(e) for e in expected]
    names = dict(zip([w for e in expected for w in e], whole.tolist(), strict=True))
    assert len(set(names.values())) == len(names)
    for size in (1, 3, 7, 40):
        monkeypatch.setattr(word_windows, "CHUNK_BYTES", size)
        again, places = batch_words(pa.array(texts))
        assert again.tolist() == whole.tolist() and places.tolist() == firsts.tolist()
        sliced = batch_words(pa.array(["zz", *texts]).slice(1))
        assert sliced[0].tolist() == whole.tolist() and sliced[1].tolist() == firsts.tolist()


def test_stretches_hold_every_window_once(monkeypatch):
    from routelens.llm import word_windows

    rng = np.random.default_rng(1)
    words = rng.integers(0, 50, 3000).astype(np.uint64)
    words[500:900] = 7
    firsts = np.array([0, 10, 10, 1500, 1519, 1539, 3000])
    for size in (1 << 20, 64):
        monkeypatch.setattr(word_windows, "CHUNK_WORDS", size)
        seen = []
        for part in stretches(words, firsts):
            assert part.n.max() <= STRETCH
            seen += [(r, s + i) for r, s, n in zip(part.row.tolist(), part.start.tolist(), part.n.tolist(), strict=True) for i in range(n)]
        expected = [(r, i) for r in range(6) for i in range(firsts[r + 1] - firsts[r] - 19)]
        assert sorted(seen) == expected


def test_factors_run_as_long_as_their_source():
    heads = np.array([(1, 1, 0, 0, 4), (1, 2, 0, 0, 3), (1, 3, 0, 5, 3)], _SYMBOLS)
    symbols = np.array([10, 11, 12, 13, 20, 21, 22, 11, 12, 20], np.uint64)
    assert [x.tolist() for x in factors(heads, symbols)] == [[2, 2], [0, 2], [2, 1]]
