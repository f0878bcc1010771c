"""Spelling variants: words one edit apart, found by composing automata, and the form that each word leads to.

Of two words one edit apart, of which the shorter has l code points, either the first l // 2 code points agree or the
rest behind the edit's half does. So each word goes to the partitions of its halves, once as a word of length l and
once as one of length l + 1. Words of a partition have read the same part: they are at one initial state, and only
what is left is made into an acceptor, composed with a one-edit transducer and itself (``one_edit``). A partition with
more words than an acceptor should hold is halved again. Each pair is accepted in one partition, on one path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelens.llm.common import whole_text, written
from routelens.llm.one_edit import Acceptor, one_edit_pairs

#: Letters of words: A to Z, a to z and the upper half of Latin-1.
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT = 5, 3
#: One in so many of all (document, run) pairs is read with a code point missing.
MISSPELT = 97
#: Words of one partition at most; and rows that one task composes, about.
PARTITION_WORDS, TASK_ROWS = 20_000, 40_000


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: runs of letters in all texts, A to Z in lower case, one in ``MISSPELT`` short of a code point.

    Which ones, and of which code point, the checksum of ``<doc_id>:<run>`` says; a null id is the empty text there.
    """
    runs = F.explode(F.regexp_extract_all(whole_text(F.col("text")), F.lit(RUN), F.lit(0)))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    run = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = rows.select("id", run.alias("run")).withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.expr("left(run, int(h % length(run)))"), F.substring("run", at + 2, F.length("run")))
    words = rows.select(F.when(F.col("h") % MISSPELT == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: its free part's first half read (``left`` grows), or its second (``right``)."""
    half = F.expr("int((l - left - right) div 2)")
    left = F.struct((F.col("left") + half).alias("left"), F.col("right").alias("right"))
    right = F.struct(F.col("left").alias("left"), (F.col("l") - F.col("left") - half).alias("right"))
    return rows.withColumn("__side", F.explode(F.array(left, right))).select("word", "n", "l", "__side.left", "__side.right")


def _key() -> list[Column]:
    return [F.col("l"), F.col("left"), F.col("right"), F.expr("left(word, left)").alias("head"), F.expr("right(word, right)").alias("tail")]


def _partitions(words: DataFrame, most: int) -> DataFrame:
    """``word, n, l, left, right``: every word once for each partition it is in, none of which has more than ``most`` words.

    A partition with one free code point left is not halved; its size is bounded by the letters there are.
    """
    length = F.explode(F.array(F.length("word"), F.length("word") - 1))
    state = words.select("word", "n", length.alias("l"), F.lit(0).alias("left"), F.lit(0).alias("right")).where("l > 0")
    state = written(_halved(state), "halves")
    done = None
    while True:
        large = state.where("l - left - right > 1").groupBy(*_key()).agg(F.count("*").alias("size")).where(F.col("size") > most)
        large = written(large, "large")
        if not large.take(1):
            return state if done is None else done.unionByName(state)
        keyed = state.select("word", "n", *_key())
        names = ["l", "left", "right", "head", "tail"]
        small = keyed.join(large, names, "left_anti").select(*state.columns)
        done = small if done is None else done.unionByName(small)
        state = written(_halved(keyed.join(large, names, "left_semi").select(*state.columns)), "halves")


def _pairs_of(key: tuple, words: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    _, left, right, head, tail = key
    counts = dict(words)
    free = Acceptor(word[left : len(word) - right] for word in counts)
    for one, two in one_edit_pairs(free, end_insertions=right == 0):
        one, two = head + one + tail, head + two + tail
        if len(one) == key[0]:  # pairs of two words of length l + 1 are those of class l + 1
            yield one, counts[one], two, counts[two]


def near_words(words: DataFrame, most: int = PARTITION_WORDS) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of ``words`` (``word, n``; each word once) that one edit tells apart."""
    rows = written(_partitions(words, most).select("word", "n", *_key()), "partitions")
    tasks = rows.count() // TASK_ROWS + 1
    key = ["l", "left", "right", "head", "tail"]

    def compose(batches):
        at, held = None, []
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(name).to_pylist() for name in (*key, "word", "n")]
            for *here, word, n in zip(*columns, strict=True):
                if here != at:
                    if len(held) > 1:
                        out += _pairs_of(tuple(at), held)
                    at, held = here, []
                held.append((word, n))
            yield _pair_batch(out)
        if len(held) > 1:
            yield _pair_batch(list(_pairs_of(tuple(at), held)))

    dealt = rows.repartition(tasks, *key).sortWithinPartitions(*key)
    found = dealt.mapInArrow(compose, "word string, n long, near string, near_n long")
    here, there = F.struct("word", "n", "near", "near_n"), F.struct("near", "near_n", "word", "n")
    kind = "struct<word:string,n:bigint,near:string,near_n:bigint>"
    return found.select(F.inline(F.array(here.cast(kind), there.cast(kind))))


def _pair_batch(pairs: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = [pa.array(values, kind) for values, kind in zip(zip(*pairs) if pairs else [()] * 4, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n", "near", "near_n"])


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every ``word, form``: the end of its chain of forms. Chains are followed by doubling, so
    rounds grow with the logarithm of the longest; a form has twice the count of its word, so there are no circles."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = state.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer = written(longer, "roots")
        if not longer.where("moved").take(1):
            return longer.drop("moved")
        state = longer.drop("moved")


def spelling_variants(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, most: int = PARTITION_WORDS
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of at least ``min_letters`` code points and ``min_count`` places.

    ``n_near`` words are one inserted, deleted or replaced code point away. ``form`` is the one of them with the largest n
    (of equals the first in code-point order) if that is twice the word's or more, else null; ``root`` is the last form on the
    way from word to form to its form. Null and empty texts have no words, rows alike count each, and other columns are left out.
    """
    words = written(word_counts(docs, min_letters, min_count), "words")
    near = near_words(words, most)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )
    leads = F.col("near_n") >= 2 * F.col("n")
    rows = written(rows.withColumn("form", F.when(leads, F.col("near"))).withColumn("form_n", F.when(leads, F.col("near_n"))), "forms")
    roots = _roots(rows.where("form IS NOT NULL"))
    found = rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
