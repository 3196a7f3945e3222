"""Materialised aggregates that are refreshed from changes, by counting.

A stored group carries how many rows it stands for, and of each measure the sum and the
number of values. Changes are rows with a sign, +1 for an insert and -1 for a delete; they
are summed per group and added to the groups they touch, whose buckets alone are read and
written. A group whose rows are all gone leaves the view. Base tables are not read again.

Sums must be of whole numbers or decimals: they stay exact however often rows come and go.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from ..sources.buckets import MOST, BucketTable

SIGN = "_sign"


def inserted(df: DataFrame) -> DataFrame:
    return df.withColumn(SIGN, F.lit(1))


def deleted(df: DataFrame) -> DataFrame:
    return df.withColumn(SIGN, F.lit(-1))


def wide_type(df: DataFrame, c: str) -> T.DecimalType:
    """Type of the stored sum: the column's scale with room for any number of rows."""
    kind = df.schema[c].dataType
    return T.DecimalType(34, kind.scale if isinstance(kind, T.DecimalType) else 0)


def _state(changes: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Signed rows as groups: keys, _rows, and per measure its sum and _n_ count."""
    inexact = [c for c in sums.values() if isinstance(changes.schema[c].dataType, (T.FloatType, T.DoubleType))]
    if inexact:
        raise TypeError(f"sums of {inexact} would drift; cast to a decimal")

    def wide(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast(wide_type(changes, c))

    measures = []
    for out, c in sums.items():
        measures.append(F.sum(F.when(F.col(SIGN) > 0, wide(c)).otherwise(-wide(c))).cast(wide_type(changes, c)).alias(out))
        measures.append(F.sum(F.when(F.col(c).isNotNull(), F.col(SIGN)).otherwise(0)).alias(f"_n_{out}"))
    return changes.groupBy(*keys).agg(F.sum(SIGN).alias("_rows"), *measures)


def _added(keys: Sequence[str], sums: Sequence[str]):
    """States of the same groups as one; groups without rows go."""

    def add(states: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in states.schema.fields}
        totals = [F.sum(c).cast(kinds[c]).alias(c) for c in ["_rows", *(x for s in sums for x in (s, f"_n_{s}"))]]
        return states.groupBy(*keys).agg(*totals).where("_rows <> 0")

    return add


def _shown(state: DataFrame, keys: Sequence[str], sums: Sequence[str], count: str | None) -> DataFrame:
    """The view: a sum without values is NULL, as in SQL."""
    values = [F.when(F.col(f"_n_{s}") > 0, F.col(s)).alias(s) for s in sums]
    return state.select(*keys, *values, *([F.col("_rows").alias(count)] if count else []))


class GroupedView:
    """``SELECT keys, sum(...), count(*) GROUP BY keys``, kept below ``root``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], sums: Mapping[str, str], placed_by: Sequence[str] | None = None, most: int = MOST):
        self.keys, self.sums = list(keys), dict(sums)
        self.table = BucketTable(spark, root, placed_by or keys, most)

    def refresh(self, changes: DataFrame, version: int) -> int:
        """Add signed rows; the same version again replaces itself. Number of groups written."""
        return self.add(_state(changes, self.keys, self.sums), version)

    def add(self, state: DataFrame, version: int) -> int:
        return self.table.apply(version, state, _added(self.keys, list(self.sums)))

    def state(self, version: int | None = None, keys: DataFrame | None = None) -> DataFrame | None:
        """Stored groups before ``version``; with ``keys`` only theirs."""
        return self.table.read(version) if keys is None else self.table.lookup(keys, version)

    def read(self, count: str | None = None) -> DataFrame | None:
        state = self.state()
        return None if state is None else _shown(state, self.keys, list(self.sums), count)


class JoinedView:
    """Sums over ``left JOIN right ON key GROUP BY group of left``, refreshed from changes of both sides.

    Each side is kept as groups of its join key, so a change meets one row per partner key
    and a hot key costs one row per side. For the keys that changed, what they gave before
    is taken from the totals and what they give now is added.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, group: str, left: Mapping[str, str], right: Mapping[str, str], most: int = MOST):
        self.key, self.group = key, group
        self.left = GroupedView(spark, f"{root}/left", [key, group], left, [key], most)
        self.right = GroupedView(spark, f"{root}/right", [key], right, None, most)
        self.out = GroupedView(spark, f"{root}/out", [group], {c: c for c in (*left, *right)}, None, most)

    def refresh(self, version: int, left: DataFrame | None = None, right: DataFrame | None = None) -> int:
        """Apply signed rows of either side; number of groups of the view that were written."""
        sides = [(view, _state(x, view.keys, view.sums)) for view, x in ((self.left, left), (self.right, right)) if x is not None]
        new = {id(view): stage(delta, "delta") for view, delta in sides}
        keys = None
        for delta in new.values():
            mine = delta.select(self.key)
            keys = mine if keys is None else keys.union(mine)
        keys = stage(keys.where(F.col(self.key).isNotNull()).distinct(), "changed-keys")
        before, after = [], []
        for view in (self.left, self.right):
            old, delta = view.state(version, keys), new.get(id(view))
            before.append(old)
            both = old if delta is None else delta if old is None else old.unionByName(delta)
            after.append(None if both is None else _added(view.keys, list(view.sums))(both))
        parts = [x for x in (self._joined(*after, 1), self._joined(*before, -1)) if x is not None]
        change = None
        for p in parts:
            change = p if change is None else change.unionByName(p)
        # the view's totals first: the sides of an earlier version are read again when a version is repeated
        written = 0
        if change is not None:
            summed = change.groupBy(self.group).agg(*[F.sum(c).cast(change.schema[c].dataType).alias(c) for c in change.columns if c != self.group])
            written = self.out.add(summed, version)
        for view in (self.left, self.right):
            if id(view) in new:
                view.add(new[id(view)], version)
        return written

    def _joined(self, left: DataFrame | None, right: DataFrame | None, sign: int) -> DataFrame | None:
        if left is None or right is None:
            return None
        r = right.withColumnRenamed("_rows", "_other").withColumnRenamed(self.key, "_key")
        pairs = left.join(r, left[self.key] == r["_key"])

        def part(c: str, by: str, kind: str) -> Column:
            return (F.col(c) * (F.col(by) * sign).cast("decimal(18,0)")).cast(kind).alias(c)

        columns = [(F.col("_rows") * F.col("_other") * sign).cast("long").alias("_rows")]
        for view, by in ((self.left, "_other"), (self.right, "_rows")):
            for c in view.sums:
                kind = (left if view is self.left else right).schema[c].dataType.simpleString()
                columns += [part(c, by, kind), part(f"_n_{c}", by, "long")]
        return pairs.select(self.group, *columns)

    def read(self, count: str | None = None) -> DataFrame | None:
        return self.out.read(count)
