"""Logistic regression by Newton steps, each one aggregate over the training rows.

A step needs the gradient, the weighted products of all pairs of columns and the loss.
They are plain sums, so every task reduces its rows to one and a few numbers move,
whatever the size of the table. What the driver solves has a row per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round_to, sigmoid
from ..session import stage
from .ordering import exact_quantiles

#: Penalty per row on the squared intercept and weights of standardised columns: it moves an
#: estimate that exists by about this share, and makes one exist for constant, repeated or
#: separating columns and for a single class.
RIDGE = 1e-8
#: A step this small, in standard deviations of a column, ends the search.
CLOSE = 1e-10

_INTERCEPT = "(intercept)"


def _known(c: str) -> Column:
    """The value as a double; NaN and infinities are missing like NULL."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


class Logistic:
    """Columns with their weights and the values that stand for missing ones."""

    def __init__(self, cols: Sequence[str], intercept: float, weights: Sequence[float], fills: Sequence[float]):
        self.cols, self.intercept = tuple(cols), float(intercept)
        self.weights, self.fills = [float(w) for w in weights], [float(f) for f in fills]

    def log_odds(self) -> Column:
        terms = (F.lit(w) * F.coalesce(_known(c), F.lit(f)) for c, w, f in zip(self.cols, self.weights, self.fills))
        return reduce(lambda a, b: a + b, terms, F.lit(self.intercept))

    def score(self, df: DataFrame) -> DataFrame:
        """Input columns plus ``p``, the unrounded probability, for every row; a column of that name is replaced."""
        return df.withColumn("p", sigmoid(self.log_odds()))

    def transform(self, df: DataFrame) -> DataFrame:
        """Input columns plus the log-odds under the name that Spark's evaluators read."""
        return df.withColumn("rawPrediction", self.log_odds())

    def predictions(self, df: DataFrame, key: str, label: str) -> DataFrame:
        return self.score(df).select(key, round_to(F.col("p"), 4).alias("proba"), F.col(label).alias("real"))

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """A row per column, smallest weight first; weights are per unit of the column."""
        rows = list(zip(self.cols, self.weights))
        return spark.createDataFrame(rows, "feature string, coeficiente double").orderBy("coeficiente", "feature")

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(-1, _INTERCEPT, self.intercept, None), *zip(range(len(self.cols)), self.cols, self.weights, self.fills)]
        spark.createDataFrame(rows, "place int, feature string, weight double, fill double").coalesce(1).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Logistic:
        first, *rest = spark.read.parquet(path).orderBy("place").collect()  # a row per column
        return Logistic([r["feature"] for r in rest], first["weight"], [r["weight"] for r in rest], [r["fill"] for r in rest])


def fit_logistic(df: DataFrame, cols: Sequence[str], label: str, steps: int = 50, ridge: float = RIDGE) -> Logistic:
    """Weights of greatest likelihood for ``label`` in (0, 1), up to the small ``ridge``.

    Missing values take the column's exact median over the labelled rows, 0 for a column
    without any; the model keeps it. Rows without a label teach nothing and a table
    without labelled rows is refused, as is any other label. With one class only, or
    columns that part the classes, the penalty bounds the weights. A step that raises the
    loss is halved.
    """
    known = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), *[_known(c).alias(f"_x{i}") for i, c in enumerate(cols)])
    known = stage(known, "labelled")
    xs = [f"_x{i}" for i in range(len(cols))]
    medians = exact_quantiles(known, {x: [0.5] for x in xs})
    fills = [0.0 if medians[x][0] is None else medians[x][0] for x in xs]
    filled = known.select("_y", *[F.coalesce(x, F.lit(f)).alias(x) for x, f in zip(xs, fills)])
    shape = filled.agg(
        F.count("_y").alias("n"), F.count_if(F.col("_y").isin(0.0, 1.0)).alias("binary"),
        *[f(x).alias(f"{k}{x}") for x in xs for k, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    if not shape["n"] or shape["binary"] < shape["n"]:
        raise ValueError("labels must be 0 or 1, and there must be one at least")
    centre = [shape[f"m{x}"] for x in xs]
    spread = [shape[f"s{x}"] or 1.0 for x in xs]
    columns = [F.lit(1.0), *[(F.col(x) - m) / s for x, m, s in zip(xs, centre, spread)]]

    penalty = np.full(len(columns), ridge * shape["n"])
    at, step, best = np.zeros(len(columns)), None, np.inf
    for _ in range(steps):
        loss, gradient, curvature = _sums(filled, columns, at)
        loss += penalty @ at**2 / 2
        if step is not None and loss > best + 1e-9 * abs(best):
            step = step / 2
            at = at - step
        else:
            best = loss
            step = np.linalg.solve(curvature + np.diag(penalty), gradient - penalty * at)
            at = at + step
        if np.abs(step).max() < CLOSE:
            break
    weights = at[1:] / spread
    return Logistic(cols, at[0] - weights @ np.array(centre), weights, fills)


def _sums(rows: DataFrame, columns: Sequence[Column], at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient of the likelihood and its negative curvature at the weights ``at``, in one scan."""
    z = reduce(lambda a, b: a + b, (F.lit(float(w)) * c for w, c in zip(at, columns)))
    size = len(columns)
    named = [c.alias(f"_c{i}") for i, c in enumerate(columns)]
    # two projections, so that no sum computes a column or the probability again
    seen = rows.select("_y", z.alias("_z"), *named).select("*", sigmoid(F.col("_z")).alias("_p"))
    seen = seen.withColumn("_w", F.col("_p") * (1 - F.col("_p")))
    # log(1 + exp(z)) without overflow
    loss = F.sum(F.log1p(F.exp(-F.abs("_z"))) + F.greatest(F.col("_z"), F.lit(0.0)) - F.col("_y") * F.col("_z"))
    slopes = [F.sum((F.col("_y") - F.col("_p")) * F.col(f"_c{i}")) for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    bends = [F.sum(F.col("_w") * F.col(f"_c{i}") * F.col(f"_c{j}")) for i, j in pairs]
    found = list(seen.agg(*[s.alias(f"s{k}") for k, s in enumerate([loss, *slopes, *bends])]).first())
    curvature = np.zeros((size, size))
    for (i, j), value in zip(pairs, found[size + 1 :]):
        curvature[i, j] = curvature[j, i] = value
    return found[0], np.array(found[1 : size + 1]), curvature
