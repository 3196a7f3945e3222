"""Replace and append sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rewrite the table at ``path``; the new schema replaces the old one."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, name: str) -> None:
    """Catalog form of :func:`write_replace`."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
