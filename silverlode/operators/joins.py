"""Joins that enrich or compare tables, and sums over joins that never build the pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_to


def join_sum(
    a: DataFrame, b: DataFrame, key: str, group: str, va: str, vb: str, fan_out: bool = True
) -> DataFrame:
    """Per ``group`` of ``a``: totals of ``va`` and of ``vb`` from ``b`` joined on ``key``.

    ``fan_out=True`` gives exactly what joining the raw rows and summing gives, where
    a value counts once per partner row. It is computed from per-key totals and
    counts, so a hot key costs one row per side instead of a product of rows.
    ``fan_out=False`` counts every value once.
    """
    left = a.groupBy(key, group).agg(F.sum(va).alias("_sa"), F.count(F.lit(1)).alias("_na"))
    right = b.groupBy(key).agg(F.sum(vb).alias("_sb"), F.count(F.lit(1)).alias("_nb"))
    both = left.join(right, key)
    if fan_out:
        sums = (F.col("_sa") * F.col("_nb"), F.col("_sb") * F.col("_na"))
    else:
        sums = (F.col("_sa"), F.col("_sb"))
    return both.groupBy(group).agg(F.sum(sums[0]).alias("receita_total"), F.sum(sums[1]).alias("credito_total"))


def total_by_catalogue(
    facts: DataFrame, catalogue: DataFrame, on: str, attributes: Sequence[str], value: str
) -> DataFrame:
    """Totals per catalogue attributes; facts are summed per key before the join."""
    summed = facts.groupBy(on).agg(F.sum(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    return (
        summed.join(catalogue.select(on, *attributes), on)
        .groupBy(*attributes)
        .agg(F.sum("_v").alias("total_contratado"), F.sum("_n").alias("qtd_contratos"))
    )


def ratio_to_target(actual: DataFrame, targets: DataFrame, on: str, value: str, target: str) -> DataFrame:
    pct = round_to(ratio(F.col(value), F.col(target)) * 100, 1)
    return actual.join(targets, on).select(on, target, value, pct.alias("pct_meta"))


def enrich(df: DataFrame, *lookups: tuple[DataFrame, str, str]) -> DataFrame:
    """Inner-join each ``(table, left key, right key)`` in turn."""
    for other, left_key, right_key in lookups:
        df = df.join(other, df[left_key] == other[right_key])
    return df
