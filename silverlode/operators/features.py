"""Train/test split and the credit features shared by training, testing and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_to

FEATURES = (
    "score_bureau",
    "atrasos_previos",
    "comprometimento",
    "renda_log",
    "relacionamento_anos",
    "canal_app",
    "canal_web",
    "tem_atraso",
)
LABEL = "inadimplente"


def numeric_bucket(key: str, buckets: int = 5) -> Column:
    """Bucket of a one-letter-prefixed number such as ``C0042``."""
    return F.substr(F.col(key), F.lit(2)).cast("bigint") % buckets


def hash_bucket(key: str, buckets: int = 5) -> Column:
    """Bucket of a key without a number in it; stable across runs and layouts."""
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def sample_rows(df: DataFrame, key: str, share: float, salt: str = "a") -> DataFrame:
    """About ``share`` of the rows, by a hash of the key: the same rows on any layout and in any engine."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return df.where(drawn < int(share * (1 << 32)))


def split(df: DataFrame, bucket: Column, test: int = 2) -> tuple[DataFrame, DataFrame]:
    """(train, test) by bucket number: two filters, the same rows on every run."""
    return df.where(bucket != test), df.where(bucket == test)


def _flag(condition: Column) -> Column:
    """1 or 0; an unknown condition is 0."""
    return F.when(condition, 1).otherwise(0)


def credit_features(df: DataFrame) -> DataFrame:
    """The eight model features, plus the label if the input has one."""
    monthly_due = F.col("renda_mensal") * F.col("prazo_meses") / 12
    return df.select(
        "cliente_id",
        "score_bureau",
        "atrasos_previos",
        round_to(ratio(F.col("valor_emprestimo"), monthly_due), 4).alias("comprometimento"),
        round_to(F.ln(F.nullif(F.col("renda_mensal"), F.lit(0.0))), 4).alias("renda_log"),
        round_to(F.col("tempo_relacionamento_meses") / 12, 2).alias("relacionamento_anos"),
        _flag(F.col("canal") == "App").alias("canal_app"),
        _flag(F.col("canal") == "Web").alias("canal_web"),
        _flag(F.col("atrasos_previos") > 0).alias("tem_atraso"),
        *([LABEL] if LABEL in df.columns else []),
    )


def feature_stats(features: DataFrame) -> DataFrame:
    def mean(c: str) -> Column:
        total = F.sum(F.col(c).cast("decimal(20,4)"))
        return round_to(ratio(total, F.count(c)), 3)

    return features.agg(
        F.count(F.lit(1)).alias("linhas"),
        mean("comprometimento").alias("media_comprometimento"),
        mean("tem_atraso").alias("pct_tem_atraso"),
        mean("renda_log").alias("media_renda_log"),
        (F.sum("canal_app") + F.sum("canal_web")).alias("app_mais_web"),
    )


def fixed_score(features: DataFrame, intercept: float, weights: dict[str, float]) -> Column:
    """Unrounded logistic probability for given coefficients."""
    logit = F.lit(intercept)
    for name, weight in weights.items():
        logit = logit + F.lit(weight) * F.col(name)
    return 1 / (1 + F.exp(-logit))
