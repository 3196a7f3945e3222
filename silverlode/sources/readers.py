"""Scans: raw text, JSON arrays, relational tables, inline rows, file listings."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_raw_csv(
    spark: SparkSession, path: str, columns: Sequence[str], rescue: str | None = "_rescued", header: bool = True
) -> DataFrame:
    """CSV, every column as text, nothing inferred.

    A record that does not fit the columns is kept whole in ``rescue``.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if rescue:
        schema = schema.add(rescue, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", rescue)
    return reader.schema(schema).csv(path)


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType, columns: Sequence[str]) -> DataFrame:
    """Small files that each hold one JSON array of objects, a file a task; ``arrays`` splits large ones."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select(*columns)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition: tuple[str, Any, Any, int] | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """External relational table; credentials arrive in ``properties`` at run time.

    ``partition`` is (column, lower, upper, parts): the scan is then split into
    ``parts`` range queries that executors run in parallel. Filters and columns are
    pushed into the query by Spark.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, partition))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def jdbc_options(url: str, table: str, partition: tuple[str, Any, Any, int] | None) -> dict[str, str]:
    options = {"url": url, "dbtable": table}
    if partition:
        column, lower, upper, parts = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def inline(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of literal rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to text."""
    return df.select(*[F.col(c).cast("string") for c in df.columns])


def with_provenance(df: DataFrame, load_ts: Column | None = None, full_path: bool = True) -> DataFrame:
    """Add source file and load time. ``df`` must come straight from a file scan."""
    origin = F.col("_metadata.file_path" if full_path else "_metadata.file_name")
    return df.select(
        "*",
        origin.alias("_arquivo_origem"),
        (F.current_timestamp() if load_ts is None else load_ts).alias("_carregado_em"),
    )


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and modification time of the files in a landing folder; contents stay unread."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def snapshot_ingest(df: DataFrame, path: str) -> DataFrame:
    """Copy an external table into a bronze folder and continue from the copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
