"""Bucket tables that grow, and views refreshed from changes, against full rebuilds."""

import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverlode.operators import joins
from silverlode.operators.maintain import GroupedView, JoinedView, deleted, inserted
from silverlode.sources.buckets import BucketTable, bucket_of, split_from

ROWS = "k int, g string, v decimal(12,2), w int"


def test_linear_hashing_moves_rows_out_of_one_bucket(spark):
    df = spark.range(3000).select("id")
    for n in range(1, 20):
        moved = df.select(bucket_of(["id"], n).alias("a"), bucket_of(["id"], n + 1).alias("b")).where("a <> b").distinct().collect()
        assert {(r.a, r.b) for r in moved} <= {(split_from(n, n), n)}
        assert df.select(bucket_of(["id"], n).alias("a")).where(f"a < 0 or a >= {n}").count() == 0


def test_table_splits_and_keeps_untouched_buckets(spark, tmp_path, rows):
    keep = lambda d: d.groupBy("id").agg(F.max("x").alias("x"))
    table = BucketTable(spark, str(tmp_path / "t"), ["id"], most=100)
    sizes = []
    for version, (lo, hi) in enumerate([(0, 150), (100, 600), (590, 595), (0, 1)]):
        table.apply(version, spark.range(lo, hi).select("id", F.lit(version).alias("x")), keep)
        sizes.append(table.layout().buckets)
    assert sizes == [2, 5, 6, 6]  # grows with the rows, no fixed number
    want = {i: (0 if i < 100 else 1) for i in range(600)} | dict.fromkeys(range(590, 595), 2) | {0: 3}
    assert rows(table.read(), "id", "x") == sorted(want.items())
    at = table.layout().held
    assert sum(v == 3 for v, _ in at.values()) == 1 and sum(n for _, n in at.values()) == 600
    # tried again, a version replaces itself
    table.apply(3, spark.range(5, 6).select("id", F.lit(9).alias("x")), keep)
    assert rows(table.read().where("id in (0, 5)"), "id", "x") == [(0, 0), (5, 9)]
    assert rows(table.lookup(spark.range(3, 5).select("id")), "id") == [(3,), (4,)]


def sample(rnd, n):
    return [(rnd.choice([1, 1, 2, 3, 4, None]), rnd.choice("abc"), rnd.choice([None, Decimal(rnd.randint(-500, 500)) / 100]), rnd.choice([None, 1, 2])) for _ in range(n)]


def test_grouped_view_equals_rebuild_after_appends_and_deletes(spark, tmp_path, rows):
    rnd = random.Random(1)
    view = GroupedView(spark, str(tmp_path / "v"), ["k"], {"total": "v", "pieces": "w"}, most=3)
    now = []
    for version in range(4):
        fresh, gone = sample(rnd, 12 if version < 3 else 0), rnd.sample(now, len(now) // 3 if version < 3 else 0)
        if version == 3:
            gone = [r for r in now if r[0] == 1]  # a whole group goes
        for r in gone:
            now.remove(r)
        now += fresh
        change = inserted(spark.createDataFrame(fresh, ROWS)).union(deleted(spark.createDataFrame(gone, ROWS)))
        for _ in range(1 + (version == 1)):  # a retry changes nothing
            view.refresh(change, version)
        want = spark.createDataFrame(now, ROWS).groupBy("k").agg(F.sum("v").alias("total"), F.sum("w").alias("pieces"), F.count("*").alias("n"))
        assert rows(view.read(count="n"), "k", "total", "pieces", "n") == rows(want)
    assert rows(view.read().where("k = 1")) == []


def test_refresh_reads_no_base_files_and_writes_touched_groups_only(spark, tmp_path, rows):
    base = str(tmp_path / "base")
    spark.range(1000).select((F.col("id") % 200).cast("int").alias("k"), F.lit("a").alias("g"), F.lit(1).cast("decimal(12,2)").alias("v"), F.lit(1).alias("w")).write.parquet(base)
    view = GroupedView(spark, str(tmp_path / "v"), ["k"], {"total": "v"}, most=10)
    view.refresh(inserted(spark.read.parquet(base)), 1)
    for f in glob.glob(f"{base}/*.parquet"):
        with open(f, "wb") as broken:
            broken.write(b"unreadable")
    written = view.refresh(deleted(spark.createDataFrame([(7, "a", Decimal(1), 1)], ROWS)), 2)
    assert written < 40  # the groups of one bucket, not all 200
    assert rows(view.read().where("k in (6, 7)"), "k", "total") == [(6, Decimal(5)), (7, Decimal(4))]
    assert view.read().count() == 200


def test_joined_view_equals_rebuild(spark, tmp_path, rows):
    rnd = random.Random(3)
    view = JoinedView(spark, str(tmp_path / "v"), "k", "g", {"receita_total": "v"}, {"credito_total": "v"}, most=6)
    left, right = [], []
    for version in range(4):
        parts = []
        for now in (left, right):
            fresh, gone = sample(rnd, 10), rnd.sample(now, len(now) // 2)
            if (version, now is right) in ((2, True), (3, False)):
                parts.append(None)  # one side stands still
                continue
            for r in gone:
                now.remove(r)
            now += fresh
            parts.append(inserted(spark.createDataFrame(fresh, ROWS)).union(deleted(spark.createDataFrame(gone, ROWS))))
        for _ in range(1 + (version == 2)):  # once with a retry
            view.refresh(version, *parts)
        want = joins.join_sum(spark.createDataFrame(left, ROWS), spark.createDataFrame(right, ROWS), "k", "g", "v", "v")
        assert rows(view.read(), "g", "receita_total", "credito_total") == rows(want, "g", "receita_total", "credito_total")


def test_inexact_sums_are_refused(spark, tmp_path):
    view = GroupedView(spark, str(tmp_path / "v"), ["k"], {"total": "x"})
    with pytest.raises(TypeError):
        view.refresh(inserted(spark.createDataFrame([(1, 0.5)], "k int, x double")), 1)
    assert view.read() is None and not os.path.exists(tmp_path / "v")
