import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.operators import modeling
from silverlode.operators.logistic import Logistic, fit_logistic


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(3)
    x = np.column_stack([draw.normal(600, 100, 2000), draw.poisson(1.5, 2000), draw.lognormal(8, 1, 2000)])
    odds = -0.01 * (x[:, 0] - 600) + 0.6 * x[:, 1] - 0.0001 * x[:, 2]
    return x, (draw.random(2000) < 1 / (1 + np.exp(-odds))).astype(int)


def frame(spark, x, y):
    return spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "a double, b double, c double, y int").repartition(7)


def plain_fit(x, y):
    """Newton on the whole matrix, without penalty."""
    m = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / x.std(0)])
    w = np.zeros(m.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-m @ w))
        w += np.linalg.solve(m.T @ (m * (p * (1 - p))[:, None]), m.T @ (y - p))
    b = w[1:] / x.std(0)
    return w[0] - b @ x.mean(0), b


def test_equals_plain_newton_and_the_library(spark, rows):
    x, y = rows
    df = frame(spark, x, y)
    model = fit_logistic(df, ["a", "b", "c"], "y")
    intercept, weights = plain_fit(x, y)
    assert model.intercept == pytest.approx(intercept, rel=1e-6)
    assert model.weights == pytest.approx(list(weights), rel=1e-6)
    library = modeling.fit_logistic(df, ["a", "b", "c"], "y").stages[-1]
    assert model.weights == pytest.approx(list(library.coefficients), rel=1e-3)
    assert [r["feature"] for r in model.coefficients(spark).collect()] == ["a", "c", "b"]


def test_stored_model_scores_alike(spark, rows, tmp_path):
    df = frame(spark, *rows)
    model = fit_logistic(df, ["c", "a"], "y")
    model.save(spark, str(tmp_path / "m"))
    again = Logistic.load(spark, str(tmp_path / "m"))
    assert (again.cols, again.intercept, again.weights, again.fills) == (model.cols, model.intercept, model.weights, model.fills)
    assert again.score(df).exceptAll(model.score(df)).count() == 0


def test_missing_values_take_the_median(spark):
    rows = [(1.0, 0), (2.0, 1), (4.0, 0), (9.0, 1), (None, 1), (math.nan, 0), (math.inf, 1), (3.0, None)]
    df = spark.createDataFrame(rows, "a double, y int").withColumn("empty", F.lit(None).cast("double"))
    model = fit_logistic(df, ["a", "empty"], "y")
    assert model.fills == [3.0, 0.0] and model.weights[1] == 0
    scored = model.score(df.withColumn("p", F.lit("before"))).collect()
    assert len(scored) == 8 and all(0 < r["p"] < 1 for r in scored)
    assert len({r["p"] for r in scored[4:]}) == 1


def test_columns_without_a_finite_estimate(spark):
    """Classes a column parts, one class only, a constant and a repeated column."""
    parted = spark.createDataFrame([(float(i), float(i), 5.0, int(i > 4)) for i in range(10)], "a double, a2 double, k double, y int")
    model = fit_logistic(parted, ["a", "a2", "k"], "y")
    assert model.weights[0] == pytest.approx(model.weights[1]) and model.weights[2] == 0
    assert all((r["p"] > 0.5) == (r["y"] == 1) for r in model.score(parted).collect())
    single = fit_logistic(parted.where("y = 1"), ["a"], "y")
    assert min(r["p"] for r in single.score(parted).collect()) > 0.999


def test_far_outlier_does_not_upset_the_steps(spark):
    rows = [(float(i % 10), int(i % 10 > 3 + i % 3)) for i in range(200)] + [(1e6, 0)]
    model = fit_logistic(spark.createDataFrame(rows, "a double, y int"), ["a"], "y")
    x, y = np.array([[r[0]] for r in rows]), np.array([r[1] for r in rows])
    score = lambda b, w: -np.sum(np.logaddexp(0, b + w * x[:, 0]) - y * (b + w * x[:, 0]))
    here = score(model.intercept, model.weights[0])
    around = [score(model.intercept + d, model.weights[0] * s) for d in (-0.05, 0, 0.05) for s in (0.9, 1, 1.1)]
    assert here >= max(around) - 1e-6


@pytest.mark.parametrize("labels", [[None, None], [0, 2], []])
def test_other_labels_are_refused(spark, labels):
    df = spark.createDataFrame([(1.0, v) for v in labels], "a double, y int")
    with pytest.raises(ValueError):
        fit_logistic(df, ["a"], "y")
