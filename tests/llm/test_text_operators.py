"""Operators that judge each text: token counts, language, toxicity, quality rules."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from routelens.llm import bpe_ids, language_id, quality, token_counts, toxicity
from routelens.llm.piece_ids import PieceIds

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "\n\n", " a", "a ", "a\n", "\na", "a b\nc d", "don't we'll", "a  b", "é\nà ", "x <|endoftext|> y", "a\n b", "a\tb c",
    "\x1c\x1d a", "a\x85b", "　a b", "<|endoftext|>", "ab" * 5_000, "日本語 text", "🙂 x",
]


def _random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(" \n\tab'sé1!<") for _ in range(rng.randint(0, 20))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_merges_count_what_the_library_counts(tokenizer):
    texts = ODD + _random_texts(400)
    expected = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    for most in (10, 10**6):  # remembered pieces change nothing
        counts = PieceIds(token_counts.MergeCounter(PATH, most), bpe_ids.SPECIAL, most)
        found = [token_counts.count_tokens(counts, pa.array(texts[at : at + 50], pa.string())) for at in range(0, len(texts), 50)]
        assert np.concatenate(found).tolist() == expected
    assert token_counts.count_tokens(counts, pa.array([], pa.string())).tolist() == []


def test_counting_remembers_no_whole_text():
    counter = token_counts.MergeCounter(PATH)
    counts = PieceIds(counter, bpe_ids.SPECIAL, 10**6)
    rng = random.Random(6)
    words, held = [f"w{i}" for i in range(300)], []
    for _ in range(5):
        texts = ["\n\n".join("  ".join(rng.choices(words, k=12)) for _ in range(30)) + "\n\n" + "é" * rng.randrange(200, 900) for _ in range(100)]
        token_counts.count_tokens(counts, pa.array(texts, pa.string()))
        held.append((counts.held_bytes, counter.held_characters))
    assert held[-1][0] <= 1.05 * held[-2][0] < 100_000 and held[-1][1] <= 1.05 * held[-2][1] < 20_000


def test_token_counts_of_a_table(documents, tokenizer):
    docs = documents([(1, "some words"), (2, None), (3, ""), (3, ""), (None, "x y"), (4, "word " * 600)], extra=["n_tokens"])
    rows = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs).collect()}
    long = len(tokenizer.encode("word " * 600, add_special_tokens=False).ids)
    assert rows == {(1, 10, 2, False), (2, 0, 0, False), (3, 0, 0, False), (None, 3, 2, False), (4, 3000, long, True)}
    assert token_counts.token_counts(docs).count() == 6
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def _gradient_at(weights, codes, truth, key, place, step=1e-3):
    def loss(shift):
        moved = {k: v.astype(np.float64) for k, v in weights.items()}
        moved[key][place] += shift
        model = language_id._finished(("a", "b"), moved)
        total = 0.0
        for row, label in zip(codes.T, truth, strict=True):
            ahead = [s.copy() for _, s in language_id._states(model.forward, row[:, None], None)]
            back = [s.copy() for _, s in language_id._states(model.backward, row[::-1, None], None)][::-1]
            for f, b in zip(ahead, back, strict=True):
                logits = (f @ model.forward.out + b @ model.backward.out + model.bias)[0]
                total += np.log(np.exp(logits).sum()) - logits[label]
        return total / codes.size

    return (loss(step) - loss(-step)) / (2 * step)


def test_backpropagation_through_time_gives_the_slope():
    rng = np.random.default_rng(0)
    weights = language_id._start(rng, 2)
    codes, truth = rng.integers(97, 101, (6, 3)), np.array([0, 1, 1])
    grads = language_id._gradients(weights, codes, truth)
    for key, place in (("fzr", (0, 1, 2)), ("fzr", (1, 2, 3)), ("bn", (3, 1)), ("bzr_in", (0, 98, 1)), ("fn_in", (99, 4)), ("bout", (2, 1))):
        assert grads[key][place] == pytest.approx(_gradient_at(weights, codes, truth, key, place), rel=0.05, abs=2e-4)


def _sentences(language, n, seed):
    stock = {"xx": ["kola", "miru", "tansa", "oke", "rima"], "yy": ["strag", "bundt", "flerk", "hvom", "skrint"]}[language]
    rng = random.Random(seed)
    return [" ".join(rng.choice(stock) for _ in range(rng.randint(5, 60))) for _ in range(n)]


def test_languages_are_told_apart(documents):
    rows = [(i, t, lang, "web") for lang, base in (("xx", 0), ("yy", 1000)) for i, t in enumerate(_sentences(lang, 60, base), base)]
    rows += [(5000, None, "xx", "web"), (5001, "", None, "web"), (5002, "12 34 !", "yy", "web"), (None, "kola miru tansa oke", None, "web")]
    docs = documents(rows, extra=["score"])
    model = language_id.train(docs)
    found = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert len(found) == len(rows)
    held = [r for r in rows if r[0] is not None and r[0] < 5000 and zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert sum(found[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held)
    assert [found[i].lang_pred for i in (5000, 5001, 5002)] == ["und"] * 3
    assert found[None].lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in found.values())
    none = language_id.predict(docs, language_id.train(docs.where("lang = 'zz'")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0


def test_every_language_is_learned(documents):
    rng = random.Random(9)
    rows = []
    for k in range(70):  # the rarest have one text, and one has long texts alone
        words = ["".join(chr(0x4E00 + 40 * k + rng.randrange(40)) for _ in range(3)) for _ in range(6)]
        texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(4 if k < 66 else 1)]
        if k == 3:
            texts = [text * 250 for text in texts]
            assert min(map(len, texts)) > 20_000
        rows += [(100 * k + i, text, f"l{k:02}", "web") for i, text in enumerate(texts)]
    model = language_id.train(documents(rows), 10**6, 10**6)  # no fold is held out
    assert model.languages == tuple(f"l{k:02}" for k in range(70))
    assert model.probabilities(["a b", ""]).shape == (2, 70)


def test_equal_texts_are_drawn_once_and_draws_are_bounded(spark, documents, monkeypatch):
    monkeypatch.setattr(language_id, "TRAINING_DOCUMENTS", 20)
    monkeypatch.setattr(toxicity, "TRAINING_DOCUMENTS", {0: 30, 1: 10})
    monkeypatch.setattr(toxicity, "TRAINING_CHARS", {0: 1500, 1: 60_000})
    seen = {}
    monkeypatch.setattr(language_id, "fit", lambda texts, langs: seen.update(texts=texts, langs=langs))
    monkeypatch.setattr(toxicity, "fit", lambda clean, toxic: seen.update(clean=clean, toxic=toxic))
    rows = [(7, "the same text", "xx", "web")] * 3000 + [(i, f"text {i:05}" + " word" * 15, "yy", "web") for i in range(1000)]
    rows += [(2000, "only one", "zz", "web"), (2001, "word " * 2_000, "zz", "web"), (2002, "two labels", "zz", "web")]
    rows += [(3000 + i, f"toxic {i % 40}", "zz", "web") for i in range(80)]
    docs = documents(rows, extra=["toxic", "__n"])
    language_id.train(docs, 10**6, 10**6)
    assert {k: seen["langs"].count(k) for k in set(seen["langs"])} == {"xx": 1, "yy": 20, "zz": 20}
    assert len(set(seen["texts"])) == 41
    labelled = [(r[0], 0) for r in rows if r[0] < 3000] + [(r[0], 1) for r in rows if r[0] >= 3000] + [(2002, 1)]
    toxicity.train(docs, spark.createDataFrame(labelled, "doc_id long, toxic int"), 10**6, 10**6)
    assert len(seen["toxic"]) == len(set(seen["toxic"])) == 10
    assert 10 <= len(seen["clean"]) <= 30 and sum(map(len, seen["clean"])) <= 1500
    assert "two labels" not in seen["clean"] + seen["toxic"] and max(map(len, seen["clean"])) <= 150
    toxicity.train(docs, spark.createDataFrame(labelled[::-1], "doc_id long, toxic int"), 10**6, 10**6)
    assert len(seen["toxic"]) == 10


def test_long_texts_are_labelled_to_the_end():
    texts = _sentences("xx", 80, 1) + _sentences("yy", 80, 2)
    model = language_id.fit(texts, ["xx"] * 80 + ["yy"] * 80)
    mostly = "kola miru " * 100 + "strag bundt flerk " * 2000
    assert model.languages[model.probabilities([mostly])[0].argmax()] == "yy"


def _toxic_corpus(n, seed):
    rng = random.Random(seed)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(30, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["zwurxel", "quogvex", "xyhhvoz"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxic_documents_are_found(spark, documents):
    rows = _toxic_corpus(500, 3)
    docs = documents([r[:2] for r in rows] + [(9001, None), (9002, ""), (9002, ""), (9003, "x")], extra=["score"])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(9004, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(found[r[0]].predicted == r[2] for r in held) >= 0.95 * len(held)
    assert found[9001].predicted == found[9002].predicted == 0
    assert all(0 <= r.score <= 1 for r in found.values())
    assert toxicity.score(docs, model).count() == docs.count()
    nothing = toxicity.train(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, nothing).collect()} == {0}


def test_one_toxic_passage_at_the_end_of_a_long_text_counts():
    rows = _toxic_corpus(400, 4)
    model = toxicity.fit([r[1] for r in rows if not r[2]], [r[1] for r in rows if r[2]])
    clean = " ".join(r[1] for r in rows[1:100] if not r[2])
    plain, bad = model.scores([clean, clean + " zwurxel so quogvex and xyhhvoz or zwurxel"])
    assert bad > 0.5 > model.scores([rows[1][1]])[0] and bad > plain


def test_long_clean_texts_stay_clean():
    def some(n, seed):  # every twelfth clean text has one toxic word by chance
        stray = ["zwurxel", "quogvex", "xyhhvoz"]
        return [(f"{text} {stray[i % 3]} so" if i % 15 == 1 else text, toxic) for i, text, toxic in _toxic_corpus(n, seed)]

    rows = some(400, 4)
    model = toxicity.fit([text for text, toxic in rows if not toxic], [text for text, toxic in rows if toxic])
    unseen = [text for text, toxic in some(1_500, 8) if not toxic]
    clean = [" ".join(unseen[a : a + n]) for a, n in ((0, 20), (0, 400), (400, 400), (800, 400))]
    assert len(clean[1]) > 200_000
    passage = "zwurxel ka mene quogvex so tupi xyhhvoz pe lagudi zwurxel no quogvex tu bali fesoka xyhhvoz mo zwurxel dipa quogvex"
    bad = [f"{text} {passage}" for text in clean]
    assert model.scores(clean).max() < 0.5 < model.scores(bad).min()


def test_long_texts_are_trained_on(spark, documents):
    rows = _toxic_corpus(150, 5)
    docs = documents([(i, text + " " + "la di da " * 3_000) for i, text, _ in rows])
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert b"zwurxel" in model.toxic and model.weight > 0


def test_windows_cover_every_byte():
    for text in ("", "a", "é" * 100, "word " * 50):
        data, spans, owner = toxicity.windows([text, "other"])
        own = [(a, a + n) for (a, n), o in zip(spans.tolist(), owner, strict=True) if o == 0]
        assert own[0][0] == 0 and own[-1][1] == len((" " + text + " ").encode())
        assert all(b[0] <= a[1] for a, b in zip(own, own[1:], strict=False))


def _measures(text):
    blanks = " \t\n\x0b\x0c\r"
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in blanks:
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines = [x for x in text.split("\n") if x.strip(blanks)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for places in windows.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_match_a_plain_count(documents):
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "a b c d e f g h", "x " * 40, "a b c d e f g h i\n" * 3, "ü é ß # | <", "\x0bq\x0cw\r\n", "w " * 5_000]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) + rng.choice(["", "\n#x\n#x"]) for _ in range(60)]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(0, None)], extra=["n_words", "kept"])
    found = quality.text_measures(docs).collect()
    assert len(found) == len(texts) + 1
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _measures(texts[r.doc_id]), texts[r.doc_id]


def test_the_order_of_rules_changes_no_verdict(documents):
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    texts = [good, good.upper(), good + " ###" * 20, "few words", None, "same " * 50, "1 2 3 4 5 " * 2 + good[:10], good + "\n" + "\n".join(["a line"] * 30)]
    measured = quality.text_measures(documents(list(enumerate(texts))))
    found = quality.estimate(measured)
    assert {e.name for e in found} == {r.name for r in quality.RULES} and all(0 <= e.rejected <= 1 for e in found)
    verdicts = [
        {r.doc_id: r.kept for r in quality.cascade(measured, rules).collect()}
        for rules in (quality.RULES, quality.RULES[::-1], quality.ordered(quality.RULES, found))
    ]
    assert verdicts[0] == verdicts[1] == verdicts[2]
    assert verdicts[0][0] and not any(verdicts[0][i] for i in (1, 2, 3, 4, 5))
    assert quality.estimate(measured.limit(0))[0].rejected == 0


def test_rules_are_ordered_by_rejection_per_cost():
    rules = [quality.Rule(n, None) for n in "abc"]
    seen = [quality.Estimate("a", 1.0, 0.1), quality.Estimate("b", 0.1, 0.1), quality.Estimate("c", 1.0, 0.9)]
    assert [r.name for r in quality.ordered(tuple(rules), seen)] == ["b", "c", "a"]


def test_quality_plan_has_no_python(documents):
    measured = quality.text_measures(documents([(1, "a")]))
    plan = quality.cascade(measured)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fold_is_crc32_of_the_id(spark):
    frame = spark.range(50).select(F.col("id").alias("doc_id"))
    from routelens.llm.common import fold_of

    for r in frame.select("doc_id", fold_of(F.col("doc_id"), 5).alias("f")).collect():
        assert r.f == zlib.crc32(str(r.doc_id).encode()) % 5
