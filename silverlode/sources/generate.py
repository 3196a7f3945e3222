"""Controlled dirt for test tables: a function of a row key, not of partition order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inject_dirt(
    df: DataFrame,
    key: Column,
    nulls: dict[str, tuple[int, int]] | None = None,
    outliers: dict[str, tuple[int, int, float]] | None = None,
    copies: tuple[int, int] | None = None,
) -> DataFrame:
    """Blank values, scale values and repeat rows where ``key % every == rest``.

    ``nulls`` maps a column to (every, rest), ``outliers`` to (every, rest, factor),
    ``copies`` is (every, rest). One narrow pass, no sampling, no shuffle.
    """
    out = df
    for col, (every, rest, factor) in (outliers or {}).items():
        out = out.withColumn(col, F.when(key % every == rest, F.col(col) * factor).otherwise(F.col(col)))
    for col, (every, rest) in (nulls or {}).items():
        out = out.withColumn(col, F.when(key % every != rest, F.col(col)))
    if copies:
        times = F.when(key % copies[0] == copies[1], 2).otherwise(1)
        out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")
    return out
