"""Shared pieces of the registered queries: table access, portable output, SQL snippets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Output types both engines print alike: decimals as double, dates as text."""

    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.ShortType, T.ByteType, T.IntegerType)):
            return c.cast("bigint").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def sql_initcap(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def sql_round(x: str, places: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {places}) AS DOUBLE)"


def sql_text(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(sql_text(i) for i in items) + "]"


def sql_fold(x: str) -> str:
    return f"translate(lower({x}), 'áéíóúãõâêîôûç', 'aeiouaoaeiouc')"
