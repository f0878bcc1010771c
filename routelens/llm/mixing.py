"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelens.llm.common import written

#: The default target weight of a source is its number of rows to this power.
TEMPERATURE = 0.5
SALTS = 8


def poisson_steps(rate: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, as far as 53 bits of a uniform number reach."""
    steps, total = [], 0.0
    last = int(rate + 12 * math.sqrt(rate) + 40)
    for k in range(last + 1):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate > 0 else float(k == 0)
        steps.append(total)
        if total >= 1 - 1e-16:
            break
    return steps


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) by the first 52 bits of md5 over the seed and the parts."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def repetition_rates(
    docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, temperature: float = TEMPERATURE
) -> DataFrame:
    """``source, rate``: how often a row of the source is to be seen on average.

    The mix has ``epochs`` times as many rows as ``docs``; each source's share of them is its weight over the sum of the weights of
    the sources present. Sources that ``weights`` leaves out have weight 0. A null source is a source.
    """
    counts = docs.groupBy(F.col("source").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    counts = written(counts.withColumn("weight", weight), "sources")
    totals = counts.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights")).first()
    rows, total = totals["rows"] or 0, totals["weights"] or 0.0
    rate = F.col("weight") * F.lit(epochs * rows / total if total else 0.0) / F.col("n")
    return counts.select("source", rate.alias("rate"))


def mix(docs: DataFrame, rates: DataFrame, seed: str = "mix") -> DataFrame:
    """Each row as often as a Poisson variable of its source's rate says, in a random order, with ``copy`` from 1.

    The variable is inverted at a uniform number hashed from the seed and doc_id, or the text where there is no id, so a run can
    be repeated; rows with the same id have the same number. A row of a source without a rate goes. The order is that of a hash
    over all rows: rows are dealt to partitions by it and sorted in each. An input column ``copy`` is replaced.
    Sources' rates are joined by source and a salt, so that one large source meets many tasks.
    """

    @F.pandas_udf("array<double>")
    def steps(rate: pd.Series) -> pd.Series:
        return rate.map(poisson_steps)

    salted = rates.select("source", steps("rate").alias("__steps")).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    table = written(salted.select(F.col("source").alias("__source"), "__salt", "__steps"), "rates")
    columns = [c for c in docs.columns if c != "copy"]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns]).withColumn("__u", uniform(seed, F.coalesce(F.col("doc_id").cast("string"), F.col("text"))))
    rows = rows.withColumn("__s", F.floor(F.col("__u") * 1_000_003).cast("long") % SALTS)
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("__s") == F.col("__salt"))
    drawn = rows.join(table, same).withColumn("__n", F.size(F.filter("__steps", lambda step: step <= F.col("__u"))))
    copies = drawn.where("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    place = F.xxhash64(F.lit(seed), "doc_id", "copy", "text")
    placed = copies.select(*[F.col(f"`{c}`") for c in columns], "copy", place.alias("__place"))
    return placed.repartition("__place").sortWithinPartitions("__place").drop("__place")
