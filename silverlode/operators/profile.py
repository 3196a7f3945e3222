"""Exploratory profiling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import bands, ratio, round_to
from .clean import iqr_lower, iqr_upper
from .ordering import exact_quantiles


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, minimum, mean and maximum per column from one scan, one row each."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                F.count(c).alias("preenchidas"),
                F.min(c).cast("double").alias("minimo"),
                round_to(ratio(F.sum(F.col(c).cast("decimal(30,4)")), F.count(c)), 4).alias("media"),
                F.max(c).cast("double").alias("maximo"),
            ).alias(f"_{i}")
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))])))


def schema_table(df: DataFrame) -> DataFrame:
    """Column position, name and type as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "posicao long, coluna string, tipo string")


def quantiles(df: DataFrame, col: str, probs: Sequence[float], exact: bool = True) -> DataFrame:
    """One row per probability. ``exact=False`` uses a bounded sketch in one pass."""
    if exact:
        values = exact_quantiles(df, {col: probs})[col]
    else:
        values = df.agg(F.percentile_approx(col, list(probs)).alias("q")).first()["q"]
    return df.sparkSession.createDataFrame(
        [(float(p), float(v)) for p, v in zip(probs, values)], "p double, valor double"
    )


def iqr_outliers(df: DataFrame, col: str) -> DataFrame:
    """Rows strictly outside both fences, and the upper fence."""
    q1, q3 = exact_quantiles(df, {col: [0.25, 0.75]})[col]
    upper, lower = iqr_upper(q1, q3), iqr_lower(q1, q3)
    outside = (F.col(col) > F.lit(upper)) | (F.col(col) < F.lit(lower))
    return df.agg(
        F.count_if(outside).alias("qtd_outliers"), round_to(F.lit(upper), 2).alias("limite_superior")
    )


def correlations(df: DataFrame, cols: Sequence[str], target: str, places: int = 3) -> DataFrame:
    """Pearson correlation of each column with ``target``, all in one aggregate."""
    y = F.col(target).cast("double")
    return df.agg(*[round_to(F.corr(F.col(c).cast("double"), y), places).alias(f"corr_{c}") for c in cols])


def band_rate(
    df: DataFrame, col: str, cuts: list[tuple[float, str]], last: str, target: str
) -> DataFrame:
    """Rows and mean of a 0/1 target per band of ``col``, NULLs left out."""
    banded = df.where(F.col(col).isNotNull()).select(bands(F.col(col), cuts, last).alias("faixa"), target)
    return banded.groupBy("faixa").agg(
        F.count(F.lit(1)).alias("clientes"), round_to(F.avg(target), 3).alias("taxa")
    )


def stack_rows(frames: dict[str, DataFrame], label: str) -> DataFrame:
    """Union of one-row summaries, each tagged with its name."""
    return reduce(DataFrame.unionByName, [df.withColumn(label, F.lit(n)) for n, df in frames.items()])
