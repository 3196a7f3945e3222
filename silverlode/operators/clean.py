"""Cleaning steps and the two silver tables built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold, money, multi_date, recode, tidy, title
from ..session import stage
from .ordering import exact_quantiles

# Category synonyms (folded) and the label each one is filed under.
CATEGORY_LABELS = {
    "software": "Software",
    "licencas": "Software",
    "impostos": "Impostos",
    "tributos": "Impostos",
    "salarios": "Folha de Pagamento",
    "folha": "Folha de Pagamento",
    "folha de pagamento": "Folha de Pagamento",
    "aluguel": "Aluguel",
    "locacao": "Aluguel",
    "marketing": "Marketing",
    "publicidade": "Marketing",
    "anuncios": "Marketing",
    "viagens": "Viagens",
    "viagem": "Viagens",
    "infraestrutura": "Infraestrutura",
    "infra": "Infraestrutura",
    "cloud": "Infraestrutura",
    "servicos": "Servicos",
    "consultoria": "Servicos",
    "material": "Materiais",
    "materiais": "Materiais",
    "suprimentos": "Materiais",
    "vendas": "Vendas",
    "venda mensal": "Vendas",
    "servicos prestados": "Receita de Servicos",
    "prestacao de servicos": "Receita de Servicos",
    "juros": "Juros",
    "rendimentos": "Juros",
    "investimentos": "Investimentos",
    "aplicacoes": "Investimentos",
}
NO_CATEGORY = "Sem Categoria"
TYPE_LABELS = {"receita": "Receita", "despesa": "Despesa"}
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
SENTINEL_DATE = "1900-01-01"
LEDGER_COLUMNS = (
    "id_lancamento",
    "data_lancamento",
    "centro_custo",
    "categoria",
    "valor",
    "tipo",
    "descricao",
)


def ledger_columns(on_missing_date: str = "drop") -> list[Column]:
    """The cleaned ledger projection, one column per source column."""
    if on_missing_date not in ("drop", "sentinel"):
        raise ValueError("on_missing_date is 'drop' or 'sentinel'")
    fallback = SENTINEL_DATE if on_missing_date == "sentinel" else None
    return [
        F.trim("id_lancamento").alias("id_lancamento"),
        multi_date(F.col("data_lancamento"), DATE_FORMATS, fallback).alias("data_lancamento"),
        title(fold(F.col("centro_custo"))).alias("centro_custo"),
        recode(F.col("categoria"), CATEGORY_LABELS, NO_CATEGORY).alias("categoria"),
        money(F.col("valor")).alias("valor"),
        recode(F.col("tipo"), TYPE_LABELS).alias("tipo"),
        F.initcap(tidy(F.col("descricao"))).alias("descricao"),
    ]


def silver_ledger(bronze: DataFrame, on_missing_date: str = "drop") -> DataFrame:
    """Typed, recoded and exactly deduplicated ledger without unusable rows.

    Everything before the DISTINCT is a narrow projection; the DISTINCT combines
    copies on the map side, so a large group of copies shrinks before the shuffle.
    """
    clean = bronze.select(*ledger_columns(on_missing_date))
    return drop_unusable(clean, ["data_lancamento", "valor"]).distinct()


def drop_unusable(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


def has_map(kind: T.DataType) -> bool:
    """Whether a type holds a map anywhere; such values have no order."""
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(has_map(f.dataType) for f in kind.fields)


def row_print(df: DataFrame, cols: Sequence[str]) -> Column:
    """64-bit print of the columns; maps count by their JSON text."""
    maps = [c for c in cols if has_map(df.schema[c].dataType)]
    rest = [F.col(c) for c in cols if c not in maps]
    return F.xxhash64(*rest, *([F.to_json(F.struct(*maps))] if maps else []), F.lit(0))


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order``, any remaining tie by the row itself.

    Written as an aggregate, not a window, so every map task already reduces a hot
    key to a single row.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    plain = [c for c in rest if not has_map(df.schema[c].dataType)]
    ties = [*map(F.col, plain), *([row_print(df, rest)] if len(plain) < len(rest) else [])]
    best = F.min_by(F.struct(*rest), F.struct(*ranked, *ties)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def iqr_upper(q1: float, q3: float) -> float:
    return q3 + 1.5 * (q3 - q1)


def iqr_lower(q1: float, q3: float) -> float:
    return q1 - 1.5 * (q3 - q1)


def iqr_filter(df: DataFrame, col: str) -> DataFrame:
    """Keep rows up to the upper interquartile fence; the bound is pushed to the scan."""
    q1, q3 = exact_quantiles(df, {col: [0.25, 0.75]})[col]
    return df.where(F.col(col) <= F.lit(iqr_upper(q1, q3)))


def impute_median(df: DataFrame, col: str) -> DataFrame:
    (median,) = exact_quantiles(df, {col: [0.5]})[col]
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(median)))


def silver_customers(raw: DataFrame) -> DataFrame:
    """Credit customers: dedupe, require income, fence, impute, standardise.

    The order matters: the quantiles come from the deduplicated rows with income,
    before the fence removes any. That table is staged because three passes read it.
    """
    kept = stage(drop_unusable(raw.distinct(), ["renda_mensal"]), "customers")
    stats = exact_quantiles(kept, {"renda_mensal": [0.25, 0.75], "score_bureau": [0.5]})
    q1, q3 = stats["renda_mensal"]
    return kept.where(F.col("renda_mensal") <= F.lit(iqr_upper(q1, q3))).select(
        *[
            F.coalesce(F.col(c), F.lit(stats["score_bureau"][0])).alias(c)
            if c == "score_bureau"
            else title(F.col(c)).alias(c)
            if c == "canal"
            else F.col(c)
            for c in kept.columns
        ]
    )
