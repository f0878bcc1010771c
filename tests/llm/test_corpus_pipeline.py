"""Stages of the corpus pipeline."""

import random

import corpus_pipeline


def _text(seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))


def test_one_of_each_class_stays_whatever_the_ids(spark, documents):
    a, b, c, d, e = map(_text, range(5))
    rows = [(None, a), (None, b), (None, b.upper()), (5, c), (5, d), (7, e), (8, e + " x"), (9, None), (9, None), (6, "")]
    kept = corpus_pipeline.drop_near_copies(spark, documents(rows, extra=["content", "root", "class_id"]), "")
    found = sorted(((r.doc_id, (r.text or "").lower()) for r in kept.collect()), key=str)
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    assert found == sorted([(None, a), (None, b), (5, c), (5, d), (7, e), (9, ""), (9, ""), (6, "")], key=str)
    assert corpus_pipeline.drop_near_copies(spark, documents(rows).limit(0), "").count() == 0
