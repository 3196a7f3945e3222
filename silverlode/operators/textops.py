"""Free-text labels, group concatenation and extractive summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..session import stage
from .windows import top_k_per_group

#: Share of all words from which on a word is common.
COMMON = 2e-5
#: Words of a summary that one task sorts or sums up, about.
PER_TASK = 8_000_000


def words(c: Column) -> Column:
    """Lower-case letter runs of a text."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")


def sentences(c: Column) -> Column:
    return F.transform(F.split(c, r"[.!?\n]+"), lambda s: F.trim(s))


def classify(
    df: DataFrame, text: str, keywords: Mapping[str, Sequence[str]], default: str, out: str = "tipo"
) -> DataFrame:
    """Label whose keywords occur most often; the earlier label on a tie, ``default`` without any.

    Deterministic stand-in for a hosted classifier: same contract (text and labels
    in, one label out), no model call per row.
    """

    def hits(options: Sequence[str]) -> Column:
        return F.size(F.filter("_words", lambda w: w.isin(*options)))

    scored = [
        F.struct(hits(options).alias("hits"), F.lit(-i).alias("rank"), F.lit(label).alias("label"))
        for i, (label, options) in enumerate(keywords.items())
    ]
    best = F.col("_best")
    # never NULL by type too: a later join then adds no null test that would repeat all this
    label = F.coalesce(F.when(best["hits"] > 0, best["label"]), F.lit(default))
    ranked = df.withColumn("_words", words(F.col(text))).withColumn("_best", F.array_max(F.array(*scored)))
    return ranked.withColumn(out, label).drop("_words", "_best")


def concat_parts(
    df: DataFrame, group: str, text: str, key: str, per_part: int = 64, sep: str = " | "
) -> DataFrame:
    """All texts of a group in key order, as consecutive parts.

    One value holding a whole group could not be built for a group of any size, so
    a part covers ``per_part`` consecutive integer keys; the parts of a group in
    order are its full text, nothing is left out.
    """
    part = F.floor(F.col(key) / per_part).cast("bigint")
    ordered = F.array_sort(F.collect_list(F.struct(key, text)))
    return df.groupBy(group, part.alias("parte")).agg(
        F.count(text).alias("textos"), F.array_join(F.transform(ordered, lambda x: x[text]), sep).alias("texto")
    )


def extractive_summary(df: DataFrame, group: str, text: str, key: str, k: int = 2) -> DataFrame:
    """The ``k`` most typical sentences per group: highest mean frequency of their words.

    The words are written once with their sentence. Totals of common words, at most
    1 / ``COMMON`` of them, travel to the words; only rarer words meet theirs in a shuffle,
    so no word gathers more than ``COMMON`` of all rows in a task. A winner's sentence is
    cut from its own text, which is fetched by key.
    """
    split = df.select(group, key, F.posexplode(sentences(F.col(text))).alias("pos", "frase"))
    spoken = stage(split.select(group, key, "pos", F.explode(words(F.col("frase"))).alias("w")), "words")
    totals = stage(spoken.groupBy(group, "w").agg(F.count(F.lit(1)).alias("tf")), "totals")
    n = totals.agg(F.coalesce(F.sum("tf"), F.lit(0))).first()[0]
    common = F.broadcast(totals.where(F.col("tf") > COMMON * n))
    rest, rarer = spoken.join(common, [group, "w"], "left_anti"), totals.where(F.col("tf") <= COMMON * n)
    rare = _spread(rest, n, group, "w").join(_spread(rarer, n, group, "w").hint("merge"), [group, "w"])
    sentence = [group, key, "pos"]
    known = spoken.join(common, [group, "w"]).select(*sentence, "tf").unionByName(rare.select(*sentence, "tf"))
    scores = (
        _spread(known, n, group, key)
        .groupBy(*sentence)
        .agg((F.sum("tf").cast("double") / F.count(F.lit(1))).alias("score"))
    )
    winners = top_k_per_group(scores, [group], [F.desc("score"), F.col(key), F.col("pos")], k)
    cut = F.get(sentences(F.col(text)), F.col("pos")).alias("frase")
    return winners.join(df.select(key, text), key).select(
        group, "posicao", key, "pos", round_to(F.col("score"), 4).alias("score"), cut
    )


def _spread(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``df`` in as many parts as ``rows`` ask for, where the session's number of them is too small."""
    parts = -(-rows // PER_TASK)
    return df.repartition(parts, *by) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
