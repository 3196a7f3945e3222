"""Multinomial naive Bayes over the words of free texts, as grouped counts.

Words are told apart by a hash into ``buckets`` places, so what is learned has ``buckets``
rows whatever the vocabulary, and scoring needs no shuffle of words: it joins a table of
that known size and sums per text. Weights are fixed-point numbers, so a text's sums do
not depend on the order in which tasks add them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .textops import words

#: Places that words are hashed into; 28 bits at most.
BUCKETS = 1 << 14
#: Weights are natural logarithms in this many parts.
UNIT = 1_000_000


def word_bucket(word: Column, buckets: int) -> Column:
    """Place of a word: the first 28 bits of its MD5, modulo ``buckets``."""
    return F.conv(F.substring(F.md5(word), 1, 7), 16, 10).cast("int") % buckets


def _weight(share: Column) -> Column:
    return F.round(F.log(share) * UNIT).cast("bigint")


class NaiveBayes:
    """Classes with their prior, and a row per bucket with a weight for each class."""

    def __init__(self, classes: list, priors: list[int], weights: DataFrame, buckets: int):
        self.classes, self.priors, self.weights, self.buckets = classes, priors, weights, buckets

    def classify(self, df: DataFrame, key: str, text: str, out: str = "classe") -> DataFrame:
        """``key``, the likeliest class (the smaller one on a tie) and ``p``, an array in the order of ``classes``.

        One row per key; rows that share a key count as one text. A NULL text or one
        without words takes the priors.
        """
        spoken = df.select(key, F.explode_outer(words(F.col(text))).alias("_w"))
        placed = spoken.select(key, word_bucket(F.col("_w"), self.buckets).alias("bucket"))
        # ``buckets`` rows, a parameter
        joined = placed.join(F.broadcast(self.weights), "bucket", "left")
        sums = joined.groupBy(key).agg(*[(F.coalesce(F.sum(f"w{i}"), F.lit(0)) + prior).alias(f"s{i}") for i, prior in enumerate(self.priors)])
        score = [F.col(f"s{i}") for i in range(len(self.classes))]
        best = F.array_max(F.array(*score))
        likely = [F.exp((s - F.col("_best")) / UNIT) for s in score]
        shares = F.array(*likely)
        total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
        at = F.array_position(F.array(*score), F.col("_best")).cast("int")
        return sums.withColumn("_best", best).select(
            key, F.element_at(F.array(*map(F.lit, self.classes)), at).alias(out), F.transform(shares, lambda x: x / total).alias("p")
        )


def naive_bayes(df: DataFrame, text: str, label: str, buckets: int = BUCKETS) -> NaiveBayes:
    """Learn from every labelled row: word counts per class, one added to each bucket.

    Rows without a label teach nothing. The classes are what labels there are, a few by
    the nature of a classifier; a table without labels is refused.
    """
    known = df.where(F.col(label).isNotNull())
    sizes = known.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label).collect()  # a row per class
    if not sizes:
        raise ValueError("no labelled rows to learn from")
    rows = sum(r["n"] for r in sizes)
    classes = [r[label] for r in sizes]
    spark = df.sparkSession
    priors = spark.range(1).select(*[_weight(F.lit(float(r["n"])) / float(rows)).alias(f"p{i}") for i, r in enumerate(sizes)]).first()
    spoken = known.select(F.col(label).alias("_label"), F.explode(words(F.col(text))).alias("_w"))
    counts = (
        spoken.groupBy("_label", word_bucket(F.col("_w"), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket").agg(*[F.coalesce(F.sum(F.when(F.col("_label") == F.lit(c), F.col("n"))), F.lit(0)).alias(f"n{i}") for i, c in enumerate(classes)])
    )
    # every bucket has a weight, so words that no labelled text holds count too
    cells = stage(spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0), "cells")
    totals = cells.agg(*[F.sum(f"n{i}").alias(f"t{i}") for i in range(len(classes))]).first()
    weights = cells.select("bucket", *[_weight((F.col(f"n{i}") + 1.0) / float(totals[i] + buckets)).alias(f"w{i}") for i in range(len(classes))])
    return NaiveBayes(classes, list(priors), stage(weights, "weights"), buckets)
