"""Spelling variants: the composed automata next to a comparison of all pairs, and the whole operator by brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from routelens.llm.one_edit import Acceptor, one_edit_pairs
from routelens.llm.spelling import near_words, spelling_variants


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("seed", range(30))
def test_composition_accepts_each_near_pair_once(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 70))}
    found = list(one_edit_pairs(Acceptor(words)))
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if one_edit(a, b) and (len(a), a) < (len(b), b)}
    assert set(one_edit_pairs(Acceptor(words), end_insertions=False)) == {(a, b) for a, b in found if len(a) == len(b) or not b == a + b[-1]}


def test_the_acceptor_is_minimal_and_takes_long_words():
    acceptor = Acceptor(["tap", "taps", "top", "tops", ""])
    assert len(acceptor.edges) == 5 and acceptor.ends[acceptor.start]
    long = ["x" * 20000, "x" * 20001, "y" + "x" * 20000]
    assert len(list(one_edit_pairs(Acceptor(long)))) == 3
    assert list(one_edit_pairs(Acceptor([]))) == []


@pytest.mark.parametrize("most", [2, 20_000])
def test_near_words_in_halved_partitions(spark, most):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(400)} | {"a" * 30, "a" * 31, "a" * 32})
    frame = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    found = [(r.word, r.near) for r in near_words(frame, most).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if one_edit(a, b)}


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: f if f is not None and n[f] >= 2 * n[w] else None for w, f in form.items()}
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out)


def test_variants_by_brute_force(spark, documents):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcde") for _ in range(rng.randrange(4, 8))) for _ in range(25)]
    rows = [(1, None), (2, ""), (3, "12 ,;\n"), (None, "Élan élan ÉLAN Elans elans elans" * 2), (4, "X" * 5000), (4, "ab×cd÷e " * 4)]
    for i in range(150):
        words = []
        for _ in range(rng.randrange(30)):
            word = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "b", "E", "é"]) + word[at + rng.randrange(2) :]
            words.append(rng.choice([word, word.upper(), word.title()]))
        rows.append((i % 140, rng.choice([" ", ", ", "-\n"]).join(words)))
    rows += [(1000 + i, "chainaa " * (1 << (2 * i)) + "chainab " * 3) for i in range(3)]
    rows += [(2000, " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["abbbb"] * 48 + ["bbbbb"] * 96))]
    found = spelling_variants(documents(rows, extra=["word", "n", "id", "run", "h", "root"]))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute(rows)
    assert sorted(map(tuple, found.collect())) == expected
    assert ("aaaaa", "aaaab", "bbbbb", 3, 1, 6) in expected


def test_no_words(spark, documents):
    assert spelling_variants(documents([])).collect() == []
    assert spelling_variants(documents([(1, None), (2, "1 2 3"), (3, "seldom")])).collect() == []
