"""Star schema: dimensions with integer surrogate keys, and the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .ordering import global_row_number

# Which categories form the two named groups; the rest is operational.
REVENUE_CATEGORIES = ("Vendas", "Receita de Servicos", "Juros", "Investimentos")
PEOPLE_CATEGORIES = ("Folha de Pagamento", "Viagens")
INCOME = "Receita"
EXPENSE = "Despesa"


def dimension(
    silver: DataFrame, col: str, key: str, name: str, bounded: bool = False
) -> DataFrame:
    """Distinct non-NULL labels numbered 1..n in ascending order.

    ``bounded`` says the labels come from a fixed recode list, so a plain window
    over the distinct set is safe. Free-text labels are numbered in parallel.
    """
    labels = silver.select(F.col(col).alias(name)).where(F.col(col).isNotNull()).distinct()
    if not bounded:
        return global_row_number(labels, [name], key).select(F.col(key), F.col(name))
    return labels.select(F.row_number().over(Window.orderBy(name)).cast("bigint").alias(key), name)


def category_group(c: Column) -> Column:
    return (
        F.when(c.isin(*REVENUE_CATEGORIES), F.lit("Receita"))
        .when(c.isin(*PEOPLE_CATEGORIES), F.lit("Pessoas"))
        .otherwise(F.lit("Operacional"))
    )


def category_dimension(silver: DataFrame) -> DataFrame:
    return dimension(silver, "categoria", "sk_categoria", "nome_categoria", bounded=True).withColumn(
        "grupo_categoria", category_group(F.col("nome_categoria"))
    )


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def date_dimension(silver: DataFrame, col: str = "data_lancamento") -> DataFrame:
    """Calendar attributes of the dates that occur; the key needs no numbering."""
    day = F.col("data_completa")
    return (
        silver.select(F.col(col).alias("data_completa"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("sk_data"),
            day,
            F.year(day).alias("ano"),
            F.month(day).alias("mes"),
            F.date_format(day, "MMMM").alias("nome_mes"),
            F.quarter(day).alias("trimestre"),
            F.dayofmonth(day).alias("dia"),
            F.date_format(day, "EEEE").alias("dia_semana"),
        )
    )


def build_fact(
    silver: DataFrame, cost_centres: DataFrame, categories: DataFrame, types: DataFrame
) -> DataFrame:
    """One row per ledger entry with surrogate keys and the signed amount.

    Inner joins as in the source model; no hints, so Spark broadcasts a dimension
    only while its measured size is below ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise splits skewed keys at run time.
    """
    cc = cost_centres.withColumnRenamed("nome_centro_custo", "centro_custo")
    cat = categories.select("sk_categoria", F.col("nome_categoria").alias("categoria"))
    signed = F.when(F.col("tipo") == INCOME, F.col("valor")).otherwise(-F.col("valor"))
    return (
        silver.join(cc, "centro_custo")
        .join(cat, "categoria")
        .join(types, "tipo")
        .select(
            "id_lancamento",
            date_key(F.col("data_lancamento")).alias("sk_data"),
            "sk_centro_custo",
            "sk_categoria",
            "sk_tipo",
            "tipo",
            "valor",
            signed.cast("decimal(12,2)").alias("valor_sinalizado"),
            "descricao",
        )
    )


class Star:
    """The silver ledger and the star built from it, each table written once."""

    def __init__(self, silver: DataFrame):
        self.silver = stage(silver, "silver")
        self.cost_centres = dimension(self.silver, "centro_custo", "sk_centro_custo", "nome_centro_custo")
        self.categories = category_dimension(self.silver)
        self.types = dimension(self.silver, "tipo", "sk_tipo", "tipo", bounded=True)
        self.dates = date_dimension(self.silver)

    @property
    def fact(self) -> DataFrame:
        return build_fact(self.silver, self.cost_centres, self.categories, self.types)
