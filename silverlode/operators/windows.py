"""Window-style results that stay balanced when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_to


def versus_group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """Each row with its group's mean and the percent distance from it.

    The mean is aggregated and joined back. A window over the group would send all
    of a group to one task; the aggregate holds one row per group, and Spark splits
    a skewed group of the row side at run time.
    """
    means = df.groupBy(F.col(group).alias("_group")).agg(ratio(F.sum(value), F.count(value)).alias("_mean"))
    return df.join(means, F.col(group).eqNullSafe(F.col("_group"))).select(
        *df.columns,
        round_to(F.col("_mean"), 2).alias("media_grupo"),
        round_to(ratio(F.col(value), F.col("_mean")) * 100 - 100, 1).alias("pct_vs_grupo"),
    )


def running_total(df: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """Cumulative sum per group over already aggregated rows (one per group and period)."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def shares(counts: DataFrame, count: str, out: str) -> DataFrame:
    """Share of the total per row of a small table of counts (one row per band)."""
    return counts.withColumn(out, ratio(F.col(count), F.sum(count).over(Window.partitionBy())))


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per group. Spark keeps at most ``k`` per task before the shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("posicao", F.row_number().over(w)).where(F.col("posicao") <= k)
