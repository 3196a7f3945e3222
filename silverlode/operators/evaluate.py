"""Threshold analysis of scored rows: (key, proba, real)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_to
from ..session import stage
from .ordering import order_cuts, range_bucket

# Cost of a missed default and of a needless review.
COST_FALSE_NEGATIVE = 10_000
COST_FALSE_POSITIVE = 1_000
THRESHOLDS = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7)
REVIEW, APPROVE = "revisar", "aprovar"


def mean_risk(c: str = "proba", places: int = 3) -> Column:
    """Mean of probabilities kept with four digits, independent of summation order."""
    return round_to(ratio(F.sum(F.col(c).cast("decimal(18,4)")), F.count(c)), places)


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Confusion cells per threshold (``proba >= t`` is positive) from one scan.

    Counting every threshold in one aggregate avoids multiplying the rows by the
    parameter list.
    """
    bad, good = F.col("real") == 1, F.col("real") == 0
    row = scored.agg(
        F.count_if(bad & F.col("proba").isNotNull()).alias("_bad"),
        F.count_if(good & F.col("proba").isNotNull()).alias("_good"),
        *[F.count_if((F.col("proba") >= t) & bad).alias(f"_tp{i}") for i, t in enumerate(thresholds)],
        *[F.count_if((F.col("proba") >= t) & good).alias(f"_fp{i}") for i, t in enumerate(thresholds)],
    )
    lines = [
        F.struct(
            F.lit(float(t)).alias("t"),
            F.col(f"_tp{i}").alias("tp"),
            F.col(f"_fp{i}").alias("fp"),
            (F.col("_bad") - F.col(f"_tp{i}")).alias("fn"),
            (F.col("_good") - F.col(f"_fp{i}")).alias("tn"),
        )
        for i, t in enumerate(thresholds)
    ]
    return row.select(F.inline(F.array(*lines)))


def confusion(scored: DataFrame, t: float = 0.5) -> DataFrame:
    return threshold_sweep(scored, [t]).drop("t")


def precision_recall(cells: DataFrame) -> DataFrame:
    """NULL where a denominator is zero."""
    return cells.select(
        round_to(ratio(F.col("tp"), F.col("tp") + F.col("fp")), 3).alias("precisao"),
        round_to(ratio(F.col("tp"), F.col("tp") + F.col("fn")), 3).alias("recall"),
    )


def cost_curve(cells: DataFrame, fn: int = COST_FALSE_NEGATIVE, fp: int = COST_FALSE_POSITIVE) -> DataFrame:
    return cells.select("t", "fn", "fp", (F.col("fn") * fn + F.col("fp") * fp).alias("custo_total"))


def best_threshold(costs: DataFrame) -> DataFrame:
    """Cheapest threshold, the smaller one on a tie."""
    return costs.orderBy("custo_total", "t").limit(1)


def auc(scored: DataFrame) -> DataFrame:
    """Exact ROC area: the chance that a positive outranks a negative, ties counting half.

    Rows are first counted per distinct score. The scores are then cut into slices of
    near-equal counts: running counts inside a slice plus the totals of the slices before
    it give every score its rank, and only the slice totals pass through one task.
    """
    per_score = (
        scored.where(F.col("proba").isNotNull() & F.col("real").isNotNull())
        .groupBy("proba")
        .agg(F.count_if(F.col("real") == 1).alias("_p"), F.count_if(F.col("real") == 0).alias("_n"))
    )
    per_score = stage(per_score, "scores")
    cuts = order_cuts(per_score, "proba", int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    per_score = per_score.withColumn("_slice", range_bucket(F.col("proba"), cuts))
    slices = per_score.groupBy("_slice").agg(F.sum("_n").alias("_total"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_slice").orderBy("proba").rowsBetween(Window.unboundedPreceding, -1)
    ranked = per_score.withColumn("_local", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(offsets, "_slice")
    # twice the number of (positive, negative) pairs won, kept whole as a decimal
    won = F.sum(
        F.col("_p").cast("decimal(19,0)") * (2 * (F.col("_before") + F.col("_local")) + F.col("_n")).cast("decimal(19,0)")
    )
    return ranked.agg(
        F.sum("_p").alias("positivos"), F.sum("_n").alias("negativos"), won.cast("double").alias("_won")
    ).select(
        "positivos",
        "negativos",
        round_to(ratio(F.col("_won"), 2.0 * F.col("positivos") * F.col("negativos")), 6).alias("auc"),
    )


def baseline_accuracy(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always answering 0."""
    return df.agg(round_to(ratio(F.count_if(F.col(label) == 0), F.count(label)), 3).alias("acuracia_do_chute"))


def decide(scored: DataFrame, probability: Column, t: float, version: str, day: date | None = None) -> DataFrame:
    """Decision on the unrounded probability, with the model version and score date."""
    when = F.current_date() if day is None else F.lit(day)
    return scored.select(
        "cliente_id",
        round_to(probability, 4).alias("proba"),
        F.when(probability >= t, REVIEW).otherwise(APPROVE).alias("decisao"),
        F.lit(version).alias("versao_modelo"),
        when.alias("data_score"),
    )


def risk_by(scored: DataFrame, by: str) -> DataFrame:
    return scored.groupBy(by).agg(F.count(F.lit(1)).alias("clientes"), mean_risk().alias("risco_medio"))
