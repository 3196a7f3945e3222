"""Business metrics over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from .star import EXPENSE, INCOME


def kpi(fact: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(12,2)")

    def total(label: str):
        return F.sum(F.when(F.col("tipo") == label, F.col("valor")).otherwise(zero))

    return fact.agg(
        total(INCOME).alias("total_receita"),
        total(EXPENSE).alias("total_despesa"),
        F.sum("valor_sinalizado").alias("resultado_liquido"),
    )


def net_by_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Net result per month. Sums per day first, so only daily rows meet the calendar."""
    daily = fact.groupBy("sk_data").agg(F.sum("valor_sinalizado").alias("_v"))
    return (
        daily.join(dates, "sk_data")
        .groupBy("ano", "mes", "nome_mes")
        .agg(F.sum("_v").alias("resultado_liquido"))
        .orderBy("ano", "mes")
    )


def expense_by_cost_centre(fact: DataFrame, cost_centres: DataFrame) -> DataFrame:
    spent = (
        fact.where(F.col("tipo") == EXPENSE).groupBy("sk_centro_custo").agg(F.sum("valor").alias("total_despesa"))
    )
    return (
        spent.join(cost_centres, "sk_centro_custo")
        .select("nome_centro_custo", "total_despesa")
        .orderBy(F.desc("total_despesa"), "nome_centro_custo")
    )


def top_categories(fact: DataFrame, categories: DataFrame, k: int = 10) -> DataFrame:
    spent = (
        fact.where(F.col("tipo") == EXPENSE)
        .groupBy("sk_categoria")
        .agg(F.sum("valor").alias("total_despesa"), F.count(F.lit(1)).alias("lancamentos"))
    )
    return (
        spent.join(categories, "sk_categoria")
        .select("nome_categoria", "total_despesa", "lancamentos")
        .orderBy(F.desc("total_despesa"), "nome_categoria")
        .limit(k)
    )


def by_month_and_type(fact: DataFrame, dates: DataFrame) -> DataFrame:
    daily = fact.groupBy("sk_data", "tipo").agg(F.sum("valor").alias("_v"))
    return (
        daily.join(dates, "sk_data")
        .groupBy("ano", "mes", "tipo")
        .agg(F.sum("_v").alias("total"))
        .orderBy("ano", "mes", "tipo")
    )


def average_expense(fact: DataFrame) -> DataFrame:
    spent = fact.where(F.col("tipo") == EXPENSE)
    return spent.agg(
        F.sum("valor").alias("total_despesa"),
        F.count(F.lit(1)).alias("lancamentos"),
        round_to(F.sum("valor") / F.count(F.lit(1)), 2).alias("despesa_media"),
    )


def month_growth(monthly: DataFrame, value: str = "resultado_liquido") -> DataFrame:
    """Percent change to the month before; the input holds one row per month."""
    now = F.col(value).cast("double")
    before = F.lag(now).over(Window.orderBy("ano", "mes"))
    return monthly.select(
        "ano",
        "mes",
        value,
        round_to(F.try_divide(now, F.nullif(before, F.lit(0.0))) * 100 - 100, 2).alias("crescimento_pct"),
    )


def top_cost_centres(fact: DataFrame, cost_centres: DataFrame, k: int = 3) -> DataFrame:
    net = fact.groupBy("sk_centro_custo").agg(F.sum("valor_sinalizado").alias("resultado"))
    return (
        net.join(cost_centres, "sk_centro_custo")
        .select("nome_centro_custo", "resultado")
        .orderBy(F.desc("resultado"), "nome_centro_custo")
        .limit(k)
    )
