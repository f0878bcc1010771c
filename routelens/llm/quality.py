"""Quality rules as a short-circuit cascade, in built-in column expressions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelens.llm.common import BLANKS, in_share, whole_text, words_of

WINDOW = 8
#: Rows that costs and selectivities are estimated on.
SAMPLE_ROWS = 1_000


@dataclass(frozen=True)
class Rule:
    """A text fails if ``rejects`` is true. ``rejects`` gets the column of texts."""

    name: str
    rejects: object


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(whole_text(text), r"[^#*$%&|<>]+", "")).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.array_join(words_of(text), "")).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(whole_text(text), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def n_dup_lines(text: Column) -> Column:
    lines = _lines(text)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _sorted_windows(words: Column) -> Column:
    """Hash and place of every window of ``WINDOW`` words, equal windows side by side; none in shorter texts."""
    places = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - WINDOW + 1)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(places, lambda i: F.struct(F.xxhash64(F.slice(words, i, WINDOW)).alias("h"), i.alias("i")))
    return F.sort_array(windows)


def _repeated_places(windows: Column) -> Column:
    """Places of windows whose hash a neighbour has, ascending, each once."""
    n = F.size(windows)
    pairs = F.zip_with(
        F.slice(windows, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(windows, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    return F.sort_array(F.array_distinct(F.flatten(pairs)))


def _covered(places: Column) -> Column:
    """Words that windows at ascending ``places`` cover together."""
    n = F.size(places)
    steps = F.zip_with(
        F.slice(places, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(places, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    inner = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    return F.when(n > 0, inner + WINDOW).otherwise(F.lit(0).cast("long"))


def once(frame: DataFrame, **columns: Column) -> DataFrame:
    """``frame`` with columns that are computed once a row, even where functions over arrays use them for every element.

    Going through a one-element array keeps the optimizer from copying the expression into its uses.
    """
    value = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select("*", F.inline(F.array(value)))


def text_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` in place of columns so named; no shuffle.

    A null text is an empty one. ``n_repeat_words`` counts the words in windows of ``WINDOW`` words that the text has twice
    or more, the first included; windows are told apart by 64-bit hashes and sorted, so long texts take n log n steps.
    """
    own = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own])
    rows = once(rows, __words=words_of(F.col("text")))
    rows = once(rows, __windows=_sorted_windows(F.col("__words")), __n=F.size("__words"), __c=F.length(F.array_join("__words", "")))
    rows = once(rows.drop("__words"), __places=_repeated_places(F.col("__windows")))
    text = F.col("text")
    rows = rows.withColumns(
        {
            "n_words": F.col("__n").cast("long"),
            "word_chars": F.col("__c").cast("long"),
            "n_symbols": n_symbols(text),
            "n_dup_lines": n_dup_lines(text),
            "n_repeat_words": _covered(F.col("__places")),
        }
    )
    return rows.drop("__windows", "__n", "__c", "__places")


def _share_over(part: Column, whole: Column, percent: int) -> Column:
    return part * 100 > whole * percent


#: Rules over measured rows, see ``text_measures``; every one may be left out or replaced.
MEASURED_RULES = (
    Rule("short", lambda text: F.col("n_words") < 20),
    Rule("repeated", lambda text: _share_over(F.col("n_repeat_words"), F.col("n_words"), 30)),
    Rule("symbols", lambda text: _share_over(F.col("n_symbols"), F.col("n_words"), 10)),
    Rule("repeated_lines", lambda text: _share_over(F.col("n_dup_lines"), F.size(_lines(text)).cast("long"), 40)),
    Rule("word_length", lambda text: ~F.col("word_chars").between(F.col("n_words") * 2, F.col("n_words") * 14)),
)
#: Rules over texts alone.
TEXT_RULES = (
    Rule(
        "shouting",
        lambda text: _share_over(
            F.length(F.regexp_replace(whole_text(text), r"[^\p{Lu}]+", "")),
            F.length(F.regexp_replace(whole_text(text), r"[^\p{L}]+", "")),
            50,
        ),
    ),
    Rule(
        "few_different_words",
        lambda text: _share_over(n_words(text), F.size(F.array_distinct(words_of(text))).cast("long"), 500),
    ),
    Rule(
        "few_letters",
        lambda text: F.length(F.regexp_replace(whole_text(text), r"[^\p{L}]+", "")) * 100
        < F.length(F.translate(whole_text(text), BLANKS, "")) * 40,
    ),
)
RULES = MEASURED_RULES + TEXT_RULES


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def per_cost(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Seconds and share rejected of each rule on about ``rows`` rows of ``docs``, chosen by a hash; what a plain scan takes is taken off."""
    share = min(1.0, rows / max(docs.count(), 1))
    sample = text_measures(docs.where(in_share(share, "doc_id", "text"))).cache()
    try:
        n = max(sample.count(), 1)
        timed = []
        for rule in (Rule("scan", lambda text: F.length("text") < 0), *rules):
            started = time.perf_counter()
            hit = sample.agg(F.sum(F.coalesce(rule.rejects(F.col("text")), F.lit(False)).cast("long"))).first()[0] or 0
            timed.append((rule.name, time.perf_counter() - started, hit / n))
    finally:
        sample.unpersist()
    return [Estimate(name, max(seconds - timed[0][1], 1e-4), share) for name, seconds, share in timed[1:]]


def ordered(rules: tuple[Rule, ...], estimates: list[Estimate]) -> tuple[Rule, ...]:
    """Rules by rejection per cost, the highest first; equal ones as given. The best order for independent rules."""
    value = {e.name: e.per_cost for e in estimates}
    return tuple(sorted(rules, key=lambda rule: -value.get(rule.name, 0.0)))


def cascade(measured: DataFrame, rules: tuple[Rule, ...] = RULES, kept: str = "kept") -> DataFrame:
    """``measured`` with ``kept``: true if no rule rejects. CASE stops at the first rule that does, so later ones are not computed.

    The order of the rules changes the cost and not the result. A rule that is null does not reject.
    """
    verdict = None
    for rule in rules:
        rejects = F.coalesce(rule.rejects(F.col("text")), F.lit(False))
        verdict = F.when(rejects, F.lit(False)) if verdict is None else verdict.when(rejects, F.lit(False))
    return measured.withColumn(kept, verdict.otherwise(F.lit(True)) if verdict is not None else F.lit(True))
