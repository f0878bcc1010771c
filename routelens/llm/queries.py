"""The registered queries of this package, each over a whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelens.llm import (
    collocations, jaccard_join, language_id, line_dedup, mixing, nearest, packing, quality, reference_parse, spelling, suffix_dedup, token_counts, toxicity,
)

#: Rows that Arrow hands to a Python function at once: bounds memory where texts are long.
ARROW_ROWS = "2000"
TOXICITY_FOLDS, LANGUAGE_FOLDS = (5, 0), (4, 2)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), *TOXICITY_FOLDS)
    folds, out = TOXICITY_FOLDS
    held = toxicity.fold_of(F.col("doc_id"), folds) == out
    return toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.repetition_rates(docs))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.LineIndex.build(docs).drop_common(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = quality.text_measures(docs)
    rules = quality.ordered(quality.RULES, quality.estimate(docs))
    base = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    judged = quality.cascade(measured, rules).withColumn("base_failed", base)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (F.col("kept") & ~base).alias("kept")
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).drop("content", "root")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut_documents(table(spark, sf_dir, "documents")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.train(docs, *LANGUAGE_FOLDS))
    folds, out = LANGUAGE_FOLDS
    return found.withColumn("held_out", language_id.fold_of(F.col("doc_id"), folds) == out)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_reference_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = reference_parse.drop_repeated_words(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_mix_sources, op3_repeated_passages, op4_line_dedup, op5_quality_rules, op6_jaccard_join,
        op7_best_fit_packing, op8_token_counts, op9_language_id, op10_nearest,
        op11_reference_parse, op12_collocations, op13_spelling_variants,
    )
}

MIX_SQL = """
WITH sources AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5) AS weight FROM documents GROUP BY source),
rates AS (SELECT source, weight * ((SELECT sum(n) FROM sources) / (SELECT sum(weight) FROM sources)) / n AS rate FROM sources),
steps AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS step
  FROM (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1.0)) AS p
        FROM (SELECT source, rate, unnest(range(0, CAST(rate + 12 * sqrt(rate) + 41 AS BIGINT))) AS k FROM rates))),
drawn AS (
  SELECT d.*, (concat('0x', substr(md5(concat('mix:', coalesce(doc_id::VARCHAR, ''))), 1, 13)))::BIGINT / 4503599627370496.0 AS u
  FROM documents d),
counted AS (
  SELECT doc_id, text, lang, d.source AS source, n_chars,
    (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.step <= d.u) AS n
  FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INTEGER AS copy FROM counted
"""

_BARE = r"translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LINES_SQL = f"""
WITH lines AS (
  SELECT r, doc_id, l, place, {_BARE} AS k
  FROM (SELECT r, doc_id, unnest(a) AS l, generate_subscripts(a, 1) AS place
        FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))),
common AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE l END, chr(10) ORDER BY place), '')) AS kept_sha256
FROM (SELECT *, k IN (SELECT k FROM common) AS gone FROM lines) GROUP BY r, doc_id
"""

WINDOWS_SQL = r"""
WITH words AS (
  SELECT r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS a
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
windows AS (
  SELECT r, doc_id, p, list_slice(a, p, p + 19) AS w
  FROM (SELECT r, doc_id, a, unnest(range(1, len(a) - 18)) AS p FROM words WHERE len(a) >= 20)),
firsts AS (
  SELECT r, p, doc_id IS DISTINCT FROM first_value(doc_id) OVER w OR p <> first_value(p) OVER w AS later
  FROM (SELECT r, doc_id, p, md5(array_to_string(w, ' ')) AS h FROM windows)
  WINDOW w AS (PARTITION BY h ORDER BY doc_id NULLS LAST, p)),
covered AS (SELECT DISTINCT r, unnest(range(p, p + 20)) AS place FROM firsts WHERE later),
kept AS (
  SELECT words.r, words.doc_id, words.place, words.word, covered.place IS NOT NULL AS gone
  FROM (SELECT r, doc_id, unnest(a) AS word, generate_subscripts(a, 1) AS place FROM words) words
  LEFT JOIN covered ON covered.r = words.r AND covered.place = words.place)
SELECT any_value(words.doc_id) AS doc_id, count(kept.place) AS n_words, count(kept.place) FILTER (WHERE kept.gone) AS n_removed,
  sha256(coalesce(string_agg(CASE WHEN kept.gone THEN NULL ELSE kept.word END, ' ' ORDER BY kept.place), '')) AS kept_sha256
FROM words LEFT JOIN kept ON kept.r = words.r GROUP BY words.r
"""

PHRASES_SQL = """
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, string_split_regex(piece, '[\\x20\\x09]+') AS a
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
clean AS (SELECT lang, p, list_filter(a, lambda w: w <> '') AS a FROM pieces),
ones AS (SELECT lang, unnest(a) AS w, count(*) AS f FROM clean GROUP BY lang, w),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
twos AS (
  SELECT lang, a[i] AS w1, a[i + 1] AS w2, count(*) AS f
  FROM (SELECT lang, a, unnest(range(1, len(a))) AS i FROM clean) GROUP BY ALL),
threes AS (
  SELECT lang, a[i] AS w1, a[i + 1] AS w2, a[i + 2] AS w3, count(*) AS f
  FROM (SELECT lang, a, unnest(range(1, len(a) - 1)) AS i FROM clean) GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, w1, w2, max(f) AS longest
  FROM (SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL),
cuts AS (
  SELECT t.lang, concat(t.w1, ' ', t.w2) AS phrase, 1 AS k, t.f AS a, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w = t.w1 JOIN ones y ON y.lang = t.lang AND y.w = t.w2
  LEFT JOIN longer g ON g.lang = t.lang AND g.w1 = t.w1 AND g.w2 = t.w2
  WHERE t.f >= 10 AND (longest IS NULL OR 100 * longest < 50 * t.f)
  UNION ALL
  SELECT t.lang, concat(t.w1, ' ', t.w2, ' ', t.w3), 1, t.f, x.f, y.f
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.w = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, concat(t.w1, ' ', t.w2, ' ', t.w3), 2, t.f, x.f, y.f
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w = t.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM weakest WHERE place = 1)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes ON sizes.lang = ranked.lang WHERE rank <= 2000
"""

SPELLING_SQL = """
WITH RECURSIVE codes AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps),
runs AS (
  SELECT id, run, count(*) AS times
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY id, run),
hashed AS (
  SELECT run, times, xor(list_reduce([4294967295] || flatten(list_transform(string_split(concat(id, ':', run), ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END)),
    lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM runs, codes),
words AS (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0 THEN concat(left(run, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
short AS (
  SELECT word, n, i, concat(left(word, i - 1), substr(word, i + 1)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM short a JOIN short b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM short a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM short a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place
  FROM pairs),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 2 * words.n THEN near END AS form, CASE WHEN near_n >= 2 * words.n THEN near_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word AND place = 1),
ways AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT ways.word, forms.word, forms.form FROM ways JOIN forms ON forms.word = ways.next)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN ways ON ways.word = forms.word AND ways.next IS NULL
"""

ORACLE_SQL = {
    "op2_mix_sources": MIX_SQL,
    "op4_line_dedup": LINES_SQL,
    "op11_reference_parse": WINDOWS_SQL,
    "op12_collocations": PHRASES_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}
