"""Shared pieces: input columns, chunked texts inside tasks, bounded word caches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.session import stage


def importable(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver has it.

    Enough where executors see the driver's folders; elsewhere ship it with --py-files.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names.

    Whatever else the input carries, clashing names included, never meets the
    operator's columns.
    """
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def copy_of(text: str) -> Column:
    """Hash of a text that, with the id, tells rows of one id apart; NULL counts as empty."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def without(df: DataFrame, gone: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of ``df`` whose id and text hash are not in ``gone`` (id, copy); all columns as they are.

    ``gone`` is written first, so Spark knows its size when it plans: it is broadcast
    where that is small and meets the rows in a shuffle otherwise.
    """
    mark = "_copy_of_row"
    left = df.withColumn(mark, copy_of(text))
    right = stage(gone.select(F.col("id").alias("_gone_id"), F.col("copy").alias("_gone_copy")).distinct(), "gone")
    return left.join(right, (left[mark] == right["_gone_copy"]) & left[key].eqNullSafe(right["_gone_id"]), "left_anti").drop(mark)


def bounded_sample(df: DataFrame, turn: Column, most: int) -> DataFrame:
    """All rows while there are at most ``most``, else about that many, chosen by a hash of the row.

    No task and no driver sorts for it. The same rows on any layout; only where copies of
    one row exceed the bound does the limit choose among them.
    """
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(turn, F.lit(1 << 30)) < int(0.95 * most / n * (1 << 30))).limit(most)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a NULL counts as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def give_back() -> None:
    """Return free memory to the system: workers wait, idle, while the tasks of later stages need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # C libraries without it keep the memory for later
        ctypes.CDLL(None).malloc_trim(0)


_kept: dict[str, dict] = {}


def kept_for(operator: str) -> dict:
    """What a worker process keeps over the tasks of one operator.

    Workers serve one query or stage after another; the first task of another operator
    drops what the one before has kept and gives the memory back to the system.
    """
    if _kept.keys() - {operator}:
        for other in _kept.keys() - {operator}:
            del _kept[other]
        give_back()
    return _kept.setdefault(operator, {})


class WordCache(dict):
    """What ``make`` returns for a word, kept for the next time; when it is full only the oldest ``stay``.

    Only short words are kept, so the memory has a bound whatever the texts hold.
    """

    def __init__(self, make: Callable[[str], object], most: int = 400_000, longest: int = 48, stay: int = 0):
        super().__init__()
        self.make, self.most, self.longest, self.stay = make, most, longest, stay

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                if not self.stay:
                    self.clear()
                while len(self) > self.stay:
                    self.popitem()
            self[word] = value
        return value


def carried(df: DataFrame, order: list, values: dict[str, Column], fold: Callable[[Column], Column] = F.sum, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with, for each name, the fold of its value over all rows that come before.

    The order is that of the whole table, whatever its keys: Spark's range sort places the
    rows, each partition folds its own, and what the partitions before it hold (one row
    per partition) is added. So a key that owns a third of the rows is still spread out;
    what concerns one key alone is the difference to the key's first row. ``fold`` is
    ``F.sum`` or ``F.bit_xor``; columns in ``drop`` serve the order only and are not kept.
    """
    both = Column.bitwiseXOR if fold is F.bit_xor else Column.__add__
    folded = [f"_fold_{c}" for c in values]
    placed = df.withColumns({f"_fold_{c}": v for c, v in values.items()}).sort(*order).withColumn("_at", F.monotonically_increasing_id()).drop(*drop)
    placed = stage(placed, "carried").withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(*[fold(F.col(c)).alias(c) for c in folded])
    parts_before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(fold(F.col(c)).over(parts_before), F.lit(0)).alias(f"{c}_off") for c in folded])
    within = placed.withColumns({f"{c}_in": F.coalesce(fold(F.col(c)).over(earlier), F.lit(0)) for c in folded})
    out = within.join(offsets, "_part")
    return out.withColumns({c: both(F.col(f"_fold_{c}_in"), F.col(f"_fold_{c}_off")) for c in values}).drop("_part", "_at", *folded, *[f"{c}_in" for c in folded], *[f"{c}_off" for c in folded])
