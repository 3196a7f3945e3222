"""Surrogate keys that stay: a stored map from label to key that loads only append to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from ..sources.buckets import MOST, BucketTable
from .ordering import global_row_number


class KeyMap:
    """Labels below ``root`` and their keys 1..n, in order of load and, within one, of label.

    Keys are never taken back, so the largest one is the number of stored rows and a load
    reads only the buckets its labels fall in. A load that is tried again under its
    version starts from what was before it and gives the same keys.
    """

    def __init__(self, spark: SparkSession, root: str, labels: Sequence[str], key: str, most: int = MOST):
        self.labels, self.key = list(labels), key
        self.stored = BucketTable(spark, root, self.labels, most)

    def load(self, version: int, rows: DataFrame) -> int:
        """Give keys to labels not seen before; the number of new ones. Labels with a NULL part get none."""
        seen = stage(rows.select(*self.labels).dropna().distinct(), "labels")
        known = self.stored.lookup(seen, version)
        new = seen if known is None else seen.join(known.select(*self.labels), self.labels, "left_anti")
        taken = self.stored.layout(version).rows
        numbered = global_row_number(new, self.labels, self.key)
        fresh = stage(numbered.select(*self.labels, (F.col(self.key) + taken).alias(self.key)), "new_keys")
        # appended rows are all new, so the merge has nothing to reduce
        self.stored.apply(version, fresh, lambda merged: merged)
        return fresh.count()

    def read(self) -> DataFrame:
        """Key and labels of all loads so far."""
        held = self.stored.read()
        if held is None:
            raise LookupError(f"nothing was loaded below {self.stored.root}")
        return held.select(self.key, *self.labels)
