"""Operators that compare documents or arrange them: mixing, lines, passages, near copies, packing, neighbours."""

import hashlib
import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from routelens.llm import jaccard_join, line_dedup, mixing, nearest, packing, suffix_dedup
from routelens.llm.cuckoo import CuckooFilter
from routelens.llm.common import connected


def _words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_connected_classes(spark):
    pairs = [(1, 2), (2, 3), (10, 11), (5, 5)] + [(100 + i, 101 + i) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)]
    found = {r.vertex: r.root for r in connected(spark.createDataFrame(pairs, "a long, b long"), "t").collect()}
    assert {found[x] for x in (1, 2, 3)} == {1} and found[11] == 10 and 5 not in found
    assert {found[100 + i] for i in range(41)} == {100} and {found[1000 + i] for i in range(60)} == {1000}
    assert connected(spark.createDataFrame([], "a long, b long"), "t").count() == 0


# mixing


def test_poisson_steps_are_the_distribution():
    steps = mixing.poisson_steps(2.5)
    assert steps[0] == pytest.approx(math.exp(-2.5)) and steps[2] == pytest.approx(math.exp(-2.5) * (1 + 2.5 + 3.125))
    assert steps[-1] == pytest.approx(1) and mixing.poisson_steps(0.0)[0] == 1
    large = mixing.poisson_steps(900.0)
    assert len(large) > 900 and large[-1] == pytest.approx(1)


def test_sources_reach_their_weights(documents):
    docs = documents([(i, f"t{i}", "en", "big" if i < 3000 else "small") for i in range(4000)])
    rates = mixing.repetition_rates(docs, {"big": 1.0, "small": 1.0})
    found = Counter(r.source for r in mixing.mix(docs, rates).select("source").collect())
    assert found["big"] == pytest.approx(2000, rel=0.08) and found["small"] == pytest.approx(2000, rel=0.08)
    again = mixing.mix(docs, rates)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixing.mix(docs, rates).collect()))
    by_id = again.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("m")).where("n <> m").count()
    assert by_id == 0


def test_mixing_odd_rows(documents):
    docs = documents([(1, None, "en", None), (1, None, "en", None), (None, "x", None, "a"), (2, "", "en", "b")], extra=["copy", "rate"])
    rates = mixing.repetition_rates(docs, {None: 50.0, "a": 25.0}, epochs=10)
    found = mixing.mix(docs, rates)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "rate", "copy"]
    counts = Counter(r.doc_id for r in found.collect())
    assert counts[1] > 8 and counts[1] % 2 == 0 and counts[None] > 3 and counts[2] == 0
    assert mixing.mix(docs.limit(0), mixing.repetition_rates(docs.limit(0))).count() == 0


# lines


def _bare(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def _without_common(texts, least, counted=None):
    counts = Counter(k for t in (texts if counted is None else counted) for k in {_bare(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (_bare(x) and counts[_bare(x)] >= least)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _line_texts(n, seed):
    rng = random.Random(seed)
    stock = ["Menu", " menu ", "MENU\t", "footer é", "FOOTER É", "", " ", "\x0b", "only"]
    texts = ["\n".join(rng.choice([*stock, f"own {rng.randrange(40)}"]) for _ in range(rng.randint(0, 6))) for _ in range(n)]
    return texts + [None, "", "menu", "menu", "\n" * 50, "menu\n" * 3000]


def test_common_lines_go(documents):
    texts = _line_texts(80, 2)
    docs = documents(list(enumerate(texts)), extra=["n_lines", "key", "place"])
    found = line_dedup.LineIndex.build(docs, min_documents=10, lines_a_shard=10).drop_common(docs).collect()
    expected = _without_common(texts, 10)
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_lines, r.n_dropped, r.kept_text) == expected[r.doc_id]


def test_repeated_rows_each_count(documents):
    docs = documents([(7, "again\nown")] * 10 + [(None, "again\nnull")] * 2 + [(8, "other")])
    rows = [(r.doc_id, r.n_dropped, r.kept_text) for r in line_dedup.LineIndex.build(docs).drop_common(docs).collect()]
    assert sorted(rows, key=str) == sorted([(7, 2, "")] * 10 + [(None, 1, "null")] * 2 + [(8, 0, "other")], key=str)
    none = docs.limit(0)
    assert line_dedup.LineIndex.build(none).drop_common(none).count() == 0


def test_line_index_is_reversible(spark, documents):
    first, second = _line_texts(60, 3), _line_texts(60, 4)
    a, b = documents(list(enumerate(first))), documents(list(enumerate(second)))
    index = line_dedup.LineIndex.empty(spark, 3, 10).insert(a)
    grown = index.insert(b)
    back = grown.delete(b)

    def kept(i):
        return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in i.drop_common(a).collect()}

    assert [kept(grown)[i] for i in range(len(first))] == _without_common(first, 10, first + second)
    assert kept(back) == kept(index) and [kept(index)[i] for i in range(len(first))] == _without_common(first, 10)
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, index.counts.collect()))


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (6_000, 2)).astype(np.uint64)
    made = CuckooFilter.of(keys[:4_000])
    assert made.contains(keys[:4_000]).all() and made.contains(keys[4_000:]).mean() < 0.01
    made = CuckooFilter.from_bytes(made.to_bytes())
    made.delete(keys[:2_000])
    assert made.contains(keys[2_000:4_000]).all() and made.contains(keys[:2_000]).mean() < 0.01
    assert not CuckooFilter(np.zeros((4, 4), np.uint16)).insert(keys[:100])


# near copies


def _jaccard(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else None)
    links = {i: set() for i in range(len(texts))}
    for i, j in combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) >= 0.8 * len(a | b):
            links[i].add(j)
            links[j].add(i)
    return links


def _class(links, i):
    seen, todo = {i}, [i]
    while todo:
        for j in links[todo.pop()] - seen:
            seen.add(j)
            todo.append(j)
    return min(seen)


def _near_copies(seed):
    rng = random.Random(seed)
    texts = []
    for group in range(6):
        base = _words(120, group)
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    shared = " ".join(_words(40, 99))
    texts += [" ".join(_words(100, 200 + i)) + " " + shared for i in range(15)]
    return texts + ["a b", "A  b", "a b c", None, "", " ", "a b c d e", texts[0].upper(), texts[0]]


@pytest.mark.parametrize("block", [2_048, 3])
def test_links_match_all_pairs(documents, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", block)
    texts = _near_copies(1)
    docs = documents(list(enumerate(texts)), extra=["content", "class_id", "bands"])
    links = _jaccard(texts)
    found = {r.doc_id: r for r in jaccard_join.jaccard_join(docs).collect()}
    assert len(found) == len(texts)
    for i in range(len(texts)):
        assert (found[i].n_links, found[i].class_id) == (len(links[i]), _class(links, i)), texts[i]


def test_links_of_odd_rows(documents):
    docs = documents([(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (6, None), (6, None)])
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs).collect())
    assert rows == [(False, 5, 5, 2), (False, 6, 6, 0), (False, 6, 6, 0), (True, 0, 5, 2), (True, 0, 5, 2)]
    assert jaccard_join.jaccard_join(docs.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands, rows = jaccard_join.choose_bands(0.8, 0.9999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.9999


# passages


def _shared_words(texts, passage):
    """By text the words in runs of at least ``passage`` words that a text of other words has too."""
    words = [(t or "").lower().split() for t in texts]
    owners = {}
    for i, w in enumerate(words):
        for k in range(len(w) - passage + 1):
            owners.setdefault(tuple(w[k : k + passage]), set()).add(tuple(w))
    copies = Counter(tuple(w) for w in words)
    out = []
    for w in words:
        hit = set()
        for k in range(len(w) - passage + 1):
            if owners[tuple(w[k : k + passage])] - {tuple(w)}:
                hit |= set(range(k, k + passage))
        out.append(len(w) if copies[tuple(w)] > 1 and len(w) >= passage else len(hit))
    return out


@pytest.mark.parametrize("partition", [100_000, 7])
def test_repeated_passages_match_all_windows(documents, monkeypatch, partition):
    monkeypatch.setattr(suffix_dedup, "PARTITION_SUFFIXES", partition)
    shared = [" ".join(_words(n, 500 + n)) for n in (49, 50, 60, 180)]
    texts = [" ".join(_words(40 + i, i)) + " " + shared[i % 4] + " " + " ".join(_words(30, 90 + i)) for i in range(16)]
    texts += [shared[1], shared[3] + " tail", None, "", "short", texts[0], texts[0].upper(), "w " * 300, " ".join(_words(3000, 77))]
    docs = documents(list(enumerate(texts)), extra=["spans", "gram", "place"])
    found = {r.doc_id: r for r in suffix_dedup.repeated_passages(docs).collect()}
    expected = _shared_words(texts, 50)
    assert len(found) == len(texts)
    for i, n in enumerate(expected):
        assert found[i].n_repeated == n, (i, found[i].spans)
        assert found[i].n_repeated == sum(s.last - s.first for s in found[i].spans)


def test_passages_that_end_with_a_frequent_line(documents):
    """Where the minimiser stands in the line, the words that follow do not bring the two copies of a passage together."""
    texts = []
    for at in range(1_000, 17_000, 1_000):
        words = _words(60, at)
        texts += [" ".join([*_words(30, at + i), *words, *_words(30, at + 50 + i)]) for i in (1, 2)]
        texts += [" ".join([*_words(30, at + i), *words[40:], *_words(30, at + 50 + i)]) for i in range(3, 24)]
    rows = {r.doc_id: r.n_repeated for r in suffix_dedup.repeated_passages(documents(list(enumerate(texts)))).collect()}
    assert [rows[i] for i in range(len(texts))] == _shared_words(texts, 50)


def test_passages_of_odd_rows(documents):
    text = " ".join(_words(60, 1))
    docs = documents([(None, text), (None, text), (1, None), (1, "")])
    assert sorted(r.n_repeated for r in suffix_dedup.repeated_passages(docs).collect()) == [0, 0, 60, 60]
    assert suffix_dedup.repeated_passages(docs.limit(0)).count() == 0


def test_every_passage_has_a_minimiser():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**63, 2_000).astype(np.uint64)
    places, _ = suffix_dedup.minimisers(words)
    assert max(np.diff(places)) <= 43 and len(places) < 150
    inside, _ = suffix_dedup.minimisers(words[300:350])
    assert set(inside + 300) <= set(places)


# packing


def test_packing_round_trip(documents):
    texts = ["some words here", None, "", "word " * 2_500, "x", "x", " ".join(_words(700, 3))] + [" ".join(_words(5 + 9 * i, i)) for i in range(40)]
    docs = documents(list(enumerate(texts)) + [(None, "x")], extra=["piece", "offset"])
    packed = packing.pack(packing.cut_documents(docs), partition_pieces=10).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in packed if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) == len(ids) and all(r.length == 2048 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == packing.zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    best = packing.lower_bound(np.array([r.length for r in packed]))
    assert len(bins) <= best + 2  # of partitions of ten pieces


def test_exchange_saves_bins(spark):
    rng = random.Random(4)
    rows = [(i, 0, 0, rng.choice([1100, 700, 500, 340]), 0) for i in range(600)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    apart, exchanged = (packing.pack(pieces, partition_pieces=20, rounds=n).select("sequence_id").distinct().count() for n in (0, 4))
    assert packing.lower_bound(np.array([r[3] for r in rows])) <= exchanged < apart
    assert packing.pack(pieces.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(pieces, capacity=600)


def _fewest_bins(sizes, capacity):
    best = [len(sizes)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best[0]


def test_bounds_are_below_and_packings_above_the_optimum():
    rng = random.Random(6)
    for _ in range(60):
        sizes = np.array([rng.randint(1, 20) for _ in range(rng.randint(1, 8))])
        optimum = _fewest_bins(sorted(sizes.tolist(), reverse=True), 20)
        bins, offsets, used = packing.best_fit_decreasing(sizes, 20)
        assert packing.lower_bound(sizes, 20) <= optimum <= used <= optimum + 1
        assert all(sizes[bins == b].sum() <= 20 for b in range(used))
    assert packing.lower_bound(np.array([11] * 5 + [9] * 3), 20) == 5


# neighbours


def _brute(rows, k):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % 100 == 0:
            near = sorted((math.dist(v, w), j) for j, w in good if j != i)
            out[i] = [(j, d) for d, j in near[:k]]
    return out


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def test_neighbours_with_every_leaf_searched_are_exact(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 40)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(700)]  # many ties and equal vectors
    rows += [(None, [1.0] * 4), (701, None), (702, [0.0] * 4), (800, [float("nan"), 1.0, 1.0, 1.0]), (900, [1.0, None, 1.0, 1.0]), (703, [float("inf")] * 4), (704, [])]
    found = {}
    for r in nearest.nearest(_vectors(spark, rows), F.col("vec_id") % 100 == 0, share=1.0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = _brute(rows, 10)
    assert found.keys() == expected.keys()
    for q, near in expected.items():
        assert [j for j, _ in found[q]] == [j for j, _ in near]
        assert [d for _, d in found[q]] == pytest.approx([d for _, d in near], abs=1e-12)


def test_few_candidates(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [0.0, 2.0])]
    found = sorted((r.query_id, r.rank, r.vec_id) for r in nearest.nearest(_vectors(spark, rows), F.col("vec_id") % 100 == 0).collect())
    assert found == [(0, 1, 100), (0, 2, 7), (100, 1, 0), (100, 2, 7)]
    assert nearest.nearest(_vectors(spark, rows).limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_queries_of_one_id_have_ranks_of_their_own(spark):
    rows = [(100, [0.0, 1.0]), (100, [10.0, 0.0]), (100, [10.0, 0.0])] + [(i, [float(i), 0.5]) for i in range(1, 13)]
    vectors = _vectors(spark, rows).withColumns({c: F.lit(1) for c in ("key", "vector", "asks", "tree", "query", "rank")})
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest.nearest(vectors, F.col("vec_id") % 100 == 0, share=1.0).collect())
    expected = []
    for at in (0, 1):  # the third row is a candidate of the second, which it equals
        near = sorted((math.dist(rows[at][1], v), j) for k, (j, v) in enumerate(rows) if k != at)[:10]
        expected += [(100, rank, j, round(d, 9)) for rank, (d, j) in enumerate(near, 1)]
    assert found == sorted(expected)


def test_recall_of_the_forest(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    rows = [(i, [float(x) for x in centres[i % 20] + 0.5 * rng.normal(size=16)]) for i in range(3000)]
    found = {}
    for r in nearest.nearest(_vectors(spark, rows), F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    expected = _brute([(i, np.float32(v).astype(float).tolist()) for i, v in rows], 10)
    hits = sum(len(found[q] & {j for j, _ in near}) for q, near in expected.items())
    assert hits >= 9 * len(expected)


def test_kept_text_hash_is_utf8(spark, documents):
    docs = documents([(1, "é\nb")])
    kept = line_dedup.LineIndex.build(docs).drop_common(docs).select(F.sha2("kept_text", 256)).first()[0]
    assert kept == hashlib.sha256("é\nb".encode()).hexdigest()
