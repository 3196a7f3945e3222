"""A stored table in key buckets that grows by linear hashing.

With ``n`` buckets a key's hash is taken modulo the power of two at or above ``n``; numbers
from ``n`` up fall back to the half of it. Adding bucket ``n`` thus moves rows out of one
older bucket only. The table adds as many buckets as keep ``most`` rows in each on average,
and rewrites those a change touches and those that are split.

A change is one version: a folder of the buckets written, and a small table beside it that
says for every bucket which version holds it. That table is written last and makes the
version visible. A version that is tried again reads what was before it and replaces
itself. The newest two versions can be read; files that only older ones use are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import folder, hadoop_path
from ..session import stage

#: Rows of a bucket, on average at most.
MOST = 500_000


class Layout(NamedTuple):
    """Number of buckets, and of each non-empty one the version that holds it and its rows."""

    buckets: int
    held: dict[int, tuple[int, int]]

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.held.values())


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Linear-hashing number of a key among ``buckets``."""
    whole = 1 << (buckets - 1).bit_length()
    h = F.xxhash64(*keys)
    full = F.pmod(h, F.lit(whole))
    half = F.pmod(h, F.lit(max(1, whole // 2)))
    return F.when(full < buckets, full).otherwise(half).cast("int")


def split_from(bucket: int, buckets: int) -> int:
    """The bucket among the first ``buckets`` that a later one took its rows from."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


class BucketTable:
    """Rows below ``root``, placed by ``keys``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], most: int = MOST):
        self.spark, self.root, self.keys, self.most = spark, root.rstrip("/"), list(keys), most

    def versions(self, before: int | None = None) -> list[int]:
        """Complete versions, ascending."""
        files, home = folder(self.spark, self.root), hadoop_path(self.spark, f"{self.root}/layout")
        if not files.exists(home):
            return []
        names = [s.getPath() for s in files.listStatus(home) if s.getPath().getName().startswith("v=")]
        found = sorted(int(p.getName()[2:]) for p in names if files.exists(hadoop_path(self.spark, f"{p}/_SUCCESS")))
        return [v for v in found if before is None or v < before]

    def layout(self, before: int | None = None) -> Layout:
        known = self.versions(before)
        return self._layout(known[-1]) if known else Layout(1, {})

    def _layout(self, version: int) -> Layout:
        # one row per bucket
        rows = self.spark.read.parquet(f"{self.root}/layout/v={version:010d}").collect()
        return Layout(rows[0]["buckets"], {r["bucket"]: (r["version"], r["n"]) for r in rows if r["bucket"] is not None})

    def read(self, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame | None:
        """All rows of the newest version (before one), or those of some buckets; None without any."""
        at = self.layout(before)
        wanted = at.held if only is None else {b: at.held[b] for b in only if b in at.held}
        paths = [f"{self.root}/rows/v={v:010d}/bucket={b}" for b, (v, _) in sorted(wanted.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame | None:
        """Rows of the given keys; only their buckets are read."""
        at = self.layout(before)
        hit = [r[0] for r in keys.select(bucket_of(self.keys, at.buckets)).distinct().collect()]  # at most a row per bucket
        stored = self.read(before, hit)
        if stored is None:
            return None
        wanted = keys.select(F.struct(*self.keys).alias("_wanted")).distinct()
        return stored.join(wanted, F.struct(*[stored[k] for k in self.keys]) == F.col("_wanted"), "left_semi")

    def apply(self, version: int, rows: DataFrame, reduce: Callable[[DataFrame], DataFrame], replaced: bool = False) -> int:
        """Merge ``rows`` with the stored rows of their buckets by ``reduce``; number of rows written.

        ``replaced`` states that the rows already are what their keys are to hold from now on.
        """
        at = self.layout(version)
        number = bucket_of(self.keys, at.buckets)
        rows = stage(rows, "change")
        touched = {r["b"]: r["n"] for r in rows.groupBy(number.alias("b")).agg(F.count("*").alias("n")).collect()}
        if not touched:
            return 0
        # changes of rows that are there add none; what this misses splits with the next version
        total = at.rows + max(0, sum(touched.values()) - sum(at.held[b][1] for b in touched if b in at.held))
        buckets = max(at.buckets, -(-total // self.most))
        # buckets that a split takes rows from are written anew as well
        written = touched.keys() | {split_from(b, at.buckets) for b in range(at.buckets, buckets)}
        old = self.read(version, sorted(written))
        if old is not None and replaced:
            keys = rows.select(F.struct(*self.keys).alias("_mine")).distinct()
            old = old.join(keys, F.struct(*[old[k] for k in self.keys]) == F.col("_mine"), "left_anti")
        merged = rows if old is None else rows.unionByName(old)
        merged = merged if replaced else reduce(merged)
        path = f"{self.root}/rows/v={version:010d}"
        merged.withColumn("bucket", bucket_of(self.keys, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        found = self.spark.read.parquet(path).groupBy("bucket").agg(F.count("*").alias("n")).collect() if self._any(path) else []
        held = {b: x for b, x in at.held.items() if b not in written} | {r["bucket"]: (version, r["n"]) for r in found}
        lines = [(b, v, n, buckets) for b, (v, n) in held.items()] or [(None, version, 0, buckets)]
        self.spark.createDataFrame(lines, "bucket int, version long, n long, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/layout/v={version:010d}")
        self._forget()
        return sum(r["n"] for r in found)

    def _any(self, path: str) -> bool:
        files = folder(self.spark, path)
        return any(s.getPath().getName().startswith("bucket=") for s in files.listStatus(hadoop_path(self.spark, path)))

    def _forget(self) -> None:
        files, known = folder(self.spark, self.root), self.versions()
        used = {(v, b) for version in known[-2:] for b, (v, _) in self._layout(version).held.items()}
        for s in files.listStatus(hadoop_path(self.spark, f"{self.root}/rows")):
            v = int(s.getPath().getName()[2:])
            if v not in known:
                continue  # being written
            for b in files.listStatus(s.getPath()):
                name = b.getPath().getName()
                if name.startswith("bucket=") and (v, int(name[7:])) not in used:
                    files.delete(b.getPath(), True)
        for v in known[:-2]:
            files.delete(hadoop_path(self.spark, f"{self.root}/layout/v={v:010d}"), True)
