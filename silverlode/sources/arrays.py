"""JSON array files of any size, read in parallel.

Spark's own reader takes a file with one array as one record of one task. Here the text
source cuts it at every closing brace, which splits like lines do. Whether a brace closes an
object of the array depends on what stands before it: whether a string is open and how
many braces are. Every byte range is summed up for both cases (it starts inside a string
or not), these few numbers per range are added up in file order, and only then does each
range know its braces. Objects that lie in several ranges are put together at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

_RANGE = ["_file", "_start"]


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType, columns: Sequence[str]) -> DataFrame:
    """Chosen columns, a row per object of the arrays in the files below ``path``.

    Files are UTF-8 and hold an array of objects, one object, or objects one after
    another. An object that cannot be parsed, or that the file's end cuts off inside a
    string or a nested object, is a row of NULLs; the others stay. Empty files and arrays
    have no rows. What has to fit a task is a byte range and an object.
    """
    pieces = stage(_pieces(_fragments(spark, path)), "pieces")
    inner = pieces.where("_n > 0 and _closed").select("_text", "_closed")
    # what touches an end of a range: two rows per range
    edges = pieces.where("_n = 0 or not _closed")
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy(*_RANGE).agg(F.count_if("_closed").alias("_ended"))
    numbered = edges.join(counts.withColumn("_object", F.coalesce(F.sum("_ended").over(before), F.lit(0))), _RANGE)
    joined = numbered.groupBy("_file", (F.col("_object") + F.col("_n")).alias("_object")).agg(
        _in_order("_start", "_text").alias("_text"), F.bool_or("_closed").alias("_closed")
    )
    texts = inner.unionByName(joined.select("_text", "_closed"))
    rest = ~F.col("_closed") & F.regexp_replace("_text", r"[\s,\[\]}]+", "").eqNullSafe("")
    bare = F.regexp_replace("_text", r"^[\s,\[]+", "")
    return texts.where(~rest).select(F.from_json(bare, schema).alias("_o")).select(*[F.col(f"_o.`{c}`").alias(c) for c in columns])


def _in_order(place: str, text: str) -> Column:
    return F.concat_ws("", F.array_sort(F.collect_list(F.struct(place, text))).getField(text))


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Texts up to each closing brace with what they change, started outside (0) or inside (1) a string."""

    def count(text: str, char: str) -> Column:
        return F.length(text) - F.length(F.replace(F.col(text), F.lit(char)))

    bare = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))
    raw = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
        F.concat("value", F.lit("}")).alias("_text"),
        bare.alias("_bare"),
    )
    raw = raw.withColumn("_unquoted", F.regexp_replace("_bare", r'"[^"]*("|$)', ""))
    counted = raw.select(*_RANGE, "_at", "_text", count("_bare", '"').alias("_quotes"), count("_bare", "{").alias("_braces"), count("_unquoted", "{").alias("_opened"))

    def deeper(opened: Column, begins_inside: int) -> Column:
        return opened - F.when((F.col("_quotes") + begins_inside) % 2 == 0, 1).otherwise(0)

    # what lies outside strings in one case lies inside in the other
    return counted.select(
        *_RANGE, "_at", "_text", "_quotes",
        deeper(F.col("_opened"), 0).alias("_deeper0"), deeper(F.col("_braces") - F.col("_opened"), 1).alias("_deeper1"),
    )


def _pieces(fragments: DataFrame) -> DataFrame:
    """Runs of fragments between the ends of objects, per byte range: number, text, whether an object ends there."""
    inside = Window.partitionBy(*_RANGE).orderBy("_at")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2
    seen = fragments.withColumn("_flip", flips)
    for g in (0, 1):
        change = F.when((F.col("_flip") + g) % 2 == 0, F.col("_deeper0")).otherwise(F.col("_deeper1"))
        seen = seen.withColumn(f"_change{g}", change)

    totals = seen.groupBy(*_RANGE).agg(*[F.sum(c).alias(c) for c in ("_quotes", "_change0", "_change1")])
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("_in", F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2)
    change = F.when(F.col("_in") == 0, F.col("_change0")).otherwise(F.col("_change1"))
    starts = starts.withColumn("_change", change).select(
        *_RANGE, "_in", F.coalesce(F.sum("_change").over(before), F.lit(0)).alias("_depth")
    )

    placed = seen.join(starts, _RANGE)
    change = F.when(F.col("_in") == 0, F.col("_change0")).otherwise(F.col("_change1"))
    outside = (F.col("_in") + F.col("_flip") + F.col("_quotes")) % 2 == 0
    placed = placed.withColumn("_change", change).withColumn("_outside", outside)
    placed = placed.withColumn("_ends", F.col("_outside") & (F.col("_depth") + F.sum("_change").over(upto) == 0))
    placed = placed.withColumn("_n", F.count_if("_ends").over(earlier))
    return placed.groupBy(*_RANGE, "_n").agg(_in_order("_at", "_text").alias("_text"), F.bool_or("_ends").alias("_closed"))
