"""Collocations by tiles, next to plain counting; tiles next to a dictionary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from routelens.llm import collocations as module
from routelens.llm.collocations import collocations, count_cells, count_coordinates


def brute(rows, min_count=10, top=2000):
    words, counts = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            found = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(found)
            for n in (1, 2, 3):
                counts.update((lang, *found[i : i + n]) for i in range(len(found) - n + 1))
    best = defaultdict(list)
    for (lang, *p), a in counts.items():
        if len(p) < 2 or a < min_count:
            continue
        if len(p) == 2:
            longer = (c for (g, *q), c in counts.items() if g == lang and len(q) == 3 and c >= min_count and (q[:2] == p or q[1:] == p))
            if any(100 * c >= 50 * a for c in longer):
                continue
        cuts = [(counts[lang, *p[:k]], counts[lang, *p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        best[lang].append((-score, -a, " ".join(p).encode(), left, right))
    out = []
    for lang, found in best.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def _corpus(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "fr", None, "und"])
        vocabulary = [f"{'Éa' if lang == 'fr' else 'A'}{k}" for k in range(12)]
        words = []
        for _ in range(rng.randrange(60)):
            words += rng.choice([["New", "york", "City"], ["of", "the"], [rng.choice(vocabulary)], [f"rare{rng.randrange(400)}"]])
        rows.append((i, "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ". "]) for w in words), lang))
    return rows + [(900, None, "en"), (901, "", None), (902, " . , \n", "xx"), (903, "a a a a " * 400, "xx"), (903, "a a a a " * 400, "xx"), (904, "z" * 9000 + " b", "xx")]


def _frame(documents, rows):
    frame = documents([(i, text, lang, "web") for i, text, lang in rows], extra=["w1", "word", "n", "key", "rank"])
    return frame


@pytest.mark.parametrize("ids", [(1 << 20, 1 << 22), (1 << 20, 7), (6, 1 << 22), (6, 3), (1, 1)])
def test_as_counted_plainly(spark, documents, ids):
    rows = _corpus(1)
    found = collocations(_frame(documents, rows), top=25, word_ids=ids[0], pair_ids=ids[1])
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, top=25)


def test_other_least_count_and_small_chunks(spark, documents, monkeypatch):
    rows = _corpus(2)[:60]
    assert sorted(map(tuple, collocations(_frame(documents, rows), min_count=3).collect())) == brute(rows, min_count=3)


def test_scores_beyond_64_bits(spark):
    a, left, right = 3 * 10**12, 4 * 10**14, 7 * 10**12 + 1
    frame = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert frame.select(module._score("a", "l", "r")).first()[0] == 1000000 * a * a // (left * right)


def test_no_words(spark, documents):
    assert collocations(documents([])).collect() == []
    assert collocations(documents([(1, None), (2, ""), (3, "only once")])).collect() == []


def test_runs_go_on_over_parts_of_a_text(monkeypatch):
    import pyarrow as pa

    from routelens.llm import word_windows

    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(["a b c d, e f g h i", "j k"])], names=["lang", "text"])
    ranks = module._Ranks(np.empty(0, np.int64), 1 << 20, False)

    def runs(length):
        return [tuple(r) for parts in module._runs(batch, 0, ranks, length) for r in zip(*[p.tolist() for p in parts], strict=True)]

    whole = {n: runs(n) for n in (1, 2, 3)}
    assert [len(whole[n]) for n in (1, 2, 3)] == [11, 8, 5]
    for size in (1, 4, 9):
        monkeypatch.setattr(word_windows, "CHUNK_BYTES", size)
        assert {n: runs(n) for n in (1, 2, 3)} == whole


def test_tiles_count_as_a_dictionary(monkeypatch):
    rng = np.random.default_rng(1)
    for side, cells in ((4, 8), (4, 0), (4, 10**6), (512, 8)):
        monkeypatch.setattr(module, "TILE_SIDE", side)
        monkeypatch.setattr(module, "CELLS_A_PAIR", cells)
        rows, columns = rng.zipf(1.3, 3000) % 50, rng.zipf(1.3, 3000) % 70
        found = {(r, c): n for r, c, n in zip(*[x.tolist() for x in count_cells(rows, columns)], strict=True)}
        assert found == Counter(zip(rows.tolist(), columns.tolist(), strict=True))
    assert [len(x) for x in count_cells(np.empty(0, np.int64), np.empty(0, np.int64))] == [0, 0, 0]
    assert [x.tolist() for x in count_coordinates(np.array([2, 1, 2]), np.array([5, 5, 5]))] == [[1, 2], [5, 5], [1, 2]]


def test_two_words_under_one_key_take_another_seed(spark, documents, monkeypatch):
    original, seeds = module._words, []

    def words(docs, seed):
        seeds.append(seed)
        found = original(docs, seed)
        return found if seed else found.unionByName(found.selectExpr("key", "lang", "word || 'x' AS word", "n"))

    monkeypatch.setattr(module, "_words", words)
    rows = _corpus(4)[:40]
    assert sorted(map(tuple, collocations(_frame(documents, rows)).collect())) == brute(rows) and seeds == [0, 1]
