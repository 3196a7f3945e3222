"""Data-quality reports and row expectations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named row condition. A NULL outcome counts as a violation.

    ``action`` is ``warn`` (keep the row), ``drop`` (leave it out) or ``fail``
    (publish nothing).
    """

    name: str
    condition: Column
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def holds(self) -> Column:
        return F.coalesce(self.condition, F.lit(False))


class ExpectationFailed(RuntimeError):
    """A ``fail`` rule was violated, so nothing was published."""


def expect_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every ``drop`` rule. A narrow filter, pushed to the scan."""
    drops = [r.holds for r in rules if r.action == "drop"]
    return df.where(reduce(lambda a, b: a & b, drops)) if drops else df


def flag_violations(df: DataFrame, rules: Sequence[Rule], out: str = "violations") -> DataFrame:
    """Every row with the names of the rules it breaks."""
    broken = [F.when(~r.holds, F.lit(r.name)) for r in rules]
    return df.withColumn(out, F.array_compact(F.array(*broken)))


def rule_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with rows checked, passed and failed, from a single scan."""
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(r.holds).alias(f"_ok{i}") for i, r in enumerate(rules)]
    )
    lines = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.action).alias("action"),
            F.col("_rows").alias("checked"),
            F.col(f"_ok{i}").alias("passed"),
            (F.col("_rows") - F.col(f"_ok{i}")).alias("failed"),
        )
        for i, r in enumerate(rules)
    ]
    return row.select(F.inline(F.array(*lines)))


def gate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: how many rows break a ``fail`` rule, and whether to publish."""
    fails = [~r.holds for r in rules if r.action == "fail"]
    bad = reduce(lambda a, b: a | b, fails) if fails else F.lit(False)
    return df.agg(F.count_if(bad).alias("violating_rows")).withColumn(
        "publish", F.col("violating_rows") == 0
    )


def publish_if_clean(df: DataFrame, rules: Sequence[Rule], path: str) -> dict[str, int]:
    """Write the valid rows unless a ``fail`` rule is broken.

    Returns the rows checked under ``rows`` and the violations under each rule name.
    They ride along with the write as observed metrics, so publishing takes one
    pass; only ``fail`` rules need a check before anything is written.
    """
    if any(r.action == "fail" for r in rules) and not gate(df, rules).first()["publish"]:
        raise ExpectationFailed(", ".join(r.name for r in rules if r.action == "fail"))
    seen = Observation()
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(~r.holds).alias(r.name) for r in rules]
    )
    expect_valid(observed, rules).write.mode("overwrite").parquet(path)
    return seen.get


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row with the NULL count of every column, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in cols or df.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("linhas")).where(F.col("linhas") > 1)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies from one grouping pass."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distintas")
    ).withColumn("duplicatas", F.col("total") - F.col("distintas"))


def silver_report(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_distinct("id_lancamento").alias("ids_distintos"),
        F.count_if(F.col("data_lancamento").isNull()).alias("datas_nulas"),
        F.count_if(F.col("valor").isNull()).alias("valores_nulos"),
        # a recoded label has a handful of values: a set per task, no second distinct over all rows
        F.size(F.collect_set("tipo")).cast("bigint").alias("tipos_distintos"),
    )


def fact_key_report(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("linhas_fato"),
        *[F.count_if(F.col(k).isNull()).alias(f"{k}_faltando") for k in keys],
    )


def orphans(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str) -> DataFrame:
    """Fact rows an inner join with ``dim`` would lose without a trace."""
    return fact.join(dim, fact[fact_col] == dim[dim_col], "left_anti")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    lines = [df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(n).alias("camada"), "linhas") for n, df in layers.items()]
    return reduce(DataFrame.unionByName, lines)


def primary_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether ``keys`` are free of NULLs and duplicates, counted exactly."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("linhas"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).alias("chaves_nulas"),
        F.count_if(~any_null & (F.col("_n") > 1)).alias("chaves_duplicadas"),
    ).withColumn("valida", (F.col("chaves_nulas") == 0) & (F.col("chaves_duplicadas") == 0))


def leakage(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys present in both tables; 0 proves the split does not leak."""
    tagged = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    both = tagged.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return both.agg(F.count_if((F.col("_a") == 1) & (F.col("_b") == 1)).alias("chaves_nos_dois"))
