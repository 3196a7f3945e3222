"""Training, comparing and applying Spark ML models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline as Stages
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round_to


def _fit(df: DataFrame, cols: Sequence[str], estimator) -> PipelineModel:
    """Missing features take the training median, which the model keeps, so every row gets a score.

    A feature without any training value is filled with 0.
    """
    known = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    empty = [c for c in cols if not known[c]]
    if empty:
        df = df.fillna(0, subset=empty)
    filled = [f"_filled_{c}" for c in cols]
    fill = Imputer(strategy="median", inputCols=list(cols), outputCols=filled)
    gather = VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="error")
    return Stages(stages=[fill, gather, estimator]).fit(df)


def fit_logistic(df: DataFrame, cols: Sequence[str], label: str, max_iter: int = 100) -> PipelineModel:
    return _fit(df, cols, LogisticRegression(labelCol=label, maxIter=max_iter))


def fit_forest(df: DataFrame, cols: Sequence[str], label: str, trees: int = 200, seed: int = 42) -> PipelineModel:
    return _fit(df, cols, RandomForestClassifier(labelCol=label, numTrees=trees, seed=seed))


def probability() -> Column:
    """Probability of class 1 from a scored table."""
    return vector_to_array(F.col("probability"))[1]


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns plus ``p``, the unrounded probability. Runs on the executors."""
    return model.transform(df).select(*df.columns, probability().alias("p"))


def prediction_table(model: PipelineModel, df: DataFrame, key: str, label: str) -> DataFrame:
    return score(model, df).select(key, round_to(F.col("p"), 4).alias("proba"), F.col(label).alias("real"))


def compare(models: dict[str, PipelineModel], test: DataFrame, label: str) -> DataFrame:
    """Area under the ROC curve of each model on the same rows, best first."""
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    rows = [(name, float(judge.evaluate(m.transform(test)))) for name, m in models.items()]
    return test.sparkSession.createDataFrame(rows, "modelo string, auc double").orderBy(F.desc("auc"), "modelo")


def _weights(spark: SparkSession, cols: Sequence[str], values, name: str) -> DataFrame:
    return spark.createDataFrame([(c, float(v)) for c, v in zip(cols, values)], f"feature string, {name} double")


def importances(spark: SparkSession, model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    return _weights(spark, cols, values, "importancia").orderBy(F.desc("importancia"), "feature")


def coefficients(spark: SparkSession, model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    return _weights(spark, cols, model.stages[-1].coefficients.toArray(), "coeficiente").orderBy("coeficiente")
