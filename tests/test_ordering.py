import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlode.operators.ordering import exact_quantiles, global_row_number, order_cuts, range_bucket


def test_global_row_number(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 20), i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(7)
    got = {(r["a"], r["b"]): r["n"] for r in global_row_number(df, ["a", "b"], "n").collect()}
    assert got == {v: i for i, v in enumerate(sorted(data), 1)}


def test_global_row_number_empty(spark):
    df = spark.createDataFrame([], "a int")
    assert global_row_number(df, ["a"], "n").count() == 0


@pytest.mark.parametrize("shape", ["uniform", "hot", "two_values", "between_ties", "heavy_tail"])
def test_quantiles_by_refinement(spark, shape):
    rnd = np.random.default_rng(5)
    values = {
        "uniform": rnd.uniform(-5, 5, 5000),
        "hot": np.where(rnd.uniform(0, 1, 5000) < 0.4, 7.25, rnd.normal(0, 3, 5000)),
        "two_values": np.where(rnd.uniform(0, 1, 5000) < 0.5, 1.0, 2.0),
        # the median lies right behind the edge of a tie that holds almost half of the rows
        "between_ties": np.concatenate([np.full(2498, 1.0), rnd.uniform(1.5, 2.0, 500), np.full(2002, 3.0)]),
        "heavy_tail": rnd.lognormal(8, 2, 5000),
    }[shape]
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
    got = exact_quantiles(df, {"x": probs})["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
    assert exact_quantiles(df.repartition(2), {"x": probs})["x"] == got  # to the last bit, on any layout


def test_quantiles_skip_nan_and_keep_infinities(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(v,) for v in [nan, -inf, 1.0, 2.0, inf, nan, None, inf]], "x double")
    assert exact_quantiles(df, {"x": [0.0, 0.25, 0.5, 0.75, 1.0]})["x"] == [-inf, 1.0, 2.0, inf, inf]


def test_quantiles_of_many_columns_in_the_same_scans(spark):
    """Copies of a column, an empty one and one that is not asked for anything cost no further job."""
    probs = [0.1, 0.5, 0.9]
    base = spark.range(5000).select((F.xxhash64("id") % 1000 / 7).alias("a")).repartition(4)
    wide = base.select("a", *[(F.col("a") * (i + 1)).alias(f"b{i}") for i in range(5)], F.lit(None).cast("double").alias("none")).cache()
    wide.count()

    def jobs(wanted):
        group = f"quantiles {len(wanted)}"
        spark.sparkContext.setJobGroup(group, group)
        got = exact_quantiles(wide, wanted)
        return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    one, few = jobs({"a": probs})
    all_of_them, many = jobs({c: probs if c != "b4" else [] for c in wide.columns})
    assert many == few and all_of_them["a"] == one["a"] and all_of_them["none"] == [None] * 3 and all_of_them["b4"] == []
    values = [r["a"] for r in base.collect()]
    for i in range(4):
        assert all_of_them[f"b{i}"] == pytest.approx(list(np.quantile(np.array(values) * (i + 1), probs)), rel=1e-12)
    assert exact_quantiles(wide, {}) == {}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, {"x": [0.5]})["x"] == [None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40, unique=True), st.lists(st.integers(-60, 60), min_size=1, max_size=10))
def test_range_bucket_counts_cuts_below(spark, cuts, values):
    cuts = sorted(cuts)
    df = spark.createDataFrame([(v,) for v in values], "x int")
    for r in df.select("x", range_bucket(F.col("x"), cuts).alias("b")).collect():
        assert r["b"] == sum(c < r["x"] for c in cuts)


def test_ranges_bound_a_hot_key(spark):
    """A key with a third of all rows is spread over ranges of about rows/parts each."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"))
    cuts = order_cuts(df, "seq", 16)
    top = df.withColumn("r", range_bucket(F.col("seq"), cuts)).groupBy("k", "r").count().agg(F.max("count")).first()[0]
    assert top <= 30_000 / 16 * 1.2
