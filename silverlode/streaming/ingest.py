"""Incremental ingestion with Structured Streaming file sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import Rule, publish_if_clean


def open_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_ingest(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything not ingested yet to ``target``, then stop.

    The checkpoint remembers consumed files and the file sink commits whole
    batches, so running again reads only new input.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_expectations(stream: DataFrame, rules: Sequence[Rule], target: str, metrics: str, checkpoint: str) -> None:
    """Ingest valid rows and record the violation counts of every micro-batch.

    Each batch owns one folder named after its id and rewrites it, so a batch that
    is retried after a failure replaces its own output instead of repeating it.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        seen = publish_if_clean(batch, rules, f"{target}/batch_id={batch_id}")
        lines = [(r.name, r.action, seen["rows"], seen["rows"] - seen[r.name], seen[r.name]) for r in rules]
        report = batch.sparkSession.createDataFrame(
            lines, "rule string, action string, checked long, passed long, failed long"
        )
        report.coalesce(1).write.mode("overwrite").parquet(f"{metrics}/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def total_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """Violation counts over all batches."""
    return (
        spark.read.parquet(metrics)
        .groupBy("rule", "action")
        .agg(F.sum("checked").alias("checked"), F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
    )
