import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from silverlode.operators import evaluate, modeling
from silverlode.operators.features import FEATURES, LABEL, credit_features
from silverlode.session import stage


@pytest.fixture(scope="module")
def sets(spark):
    k = F.col("id")
    draw = lambda i: (F.xxhash64(k, F.lit(i)) % 1000 + 1000) % 1000 / 1000
    raw = spark.range(3000).select(
        F.concat(F.lit("C"), k.cast("string")).alias("cliente_id"),
        (300 + 600 * draw(1)).alias("score_bureau"), F.floor(4 * draw(2) ** 2).alias("atrasos_previos"),
        (1000 + 9000 * draw(3)).alias("renda_mensal"), (5000 + 40000 * draw(4)).alias("valor_emprestimo"),
        F.lit(24).alias("prazo_meses"), F.floor(240 * draw(5)).alias("tempo_relacionamento_meses"),
        F.element_at(F.array(*map(F.lit, ["App", "Web", "Agencia"])), (k % 3 + 1).cast("int")).alias("canal"), draw(6).alias("u"),
    )
    risk = (900 - F.col("score_bureau")) / 1500 * (1 + F.col("atrasos_previos")) / 2
    ready = stage(credit_features(raw.withColumn(LABEL, (F.col("u") < risk).cast("int"))), "ready")
    part = F.pmod(F.xxhash64("cliente_id"), F.lit(5))
    return ready.where(part != 2), ready.where(part == 2)


def test_train_compare_explain(spark, sets):
    train, test = sets
    logistic = modeling.fit_logistic(train, FEATURES, LABEL)
    forest = modeling.fit_forest(train, FEATURES, LABEL, trees=10)
    table = {r["modelo"]: r["auc"] for r in modeling.compare({"logistica": logistic, "floresta": forest}, test, LABEL).collect()}
    assert table["logistica"] > 0.7 and table["floresta"] > 0.6
    preds = modeling.prediction_table(logistic, test, "cliente_id", LABEL)
    assert preds.count() == test.count()
    assert evaluate.auc(preds).first()["auc"] == pytest.approx(table["logistica"], abs=0.005)
    weights = {r["feature"]: r["coeficiente"] for r in modeling.coefficients(spark, logistic, FEATURES).collect()}
    assert weights["score_bureau"] < 0 < weights["atrasos_previos"]
    gains = modeling.importances(spark, forest, FEATURES).collect()
    assert sum(r["importancia"] for r in gains) == pytest.approx(1.0) and gains[0]["feature"] == "score_bureau"


def test_stored_model_scores_alike(sets, tmp_path):
    train, test = sets
    model = modeling.fit_logistic(train, FEATURES, LABEL, max_iter=3)
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    before = modeling.score(model, test).select("cliente_id", "p")
    assert before.exceptAll(modeling.score(loaded, test).select("cliente_id", "p")).count() == 0


def test_every_customer_gets_a_score(spark, sets):
    """NULL channel, late count, score and income: flags are 0, features take the training median."""
    train, _ = sets
    rows = [("C1", None, None, None, None, 10, 5, None), ("C2", 700.0, 1, 2000.0, 9000.0, 12, 30, "App"), ("C3", None, 2, 0.0, 1.0, 12, None, None)]
    names = "cliente_id string, score_bureau double, atrasos_previos long, renda_mensal double, valor_emprestimo double, prazo_meses int, tempo_relacionamento_meses int, canal string"
    new = credit_features(spark.createDataFrame(rows, names))
    flags = {r["cliente_id"]: (r["canal_app"], r["canal_web"], r["tem_atraso"]) for r in new.collect()}
    assert flags == {"C1": (0, 0, 0), "C2": (1, 0, 1), "C3": (0, 0, 1)}
    for model in (modeling.fit_logistic(train, FEATURES, LABEL), modeling.fit_forest(train, FEATURES, LABEL, trees=3)):
        scored = modeling.score(model, new).collect()
        assert len(scored) == 3 and all(0 <= r["p"] <= 1 for r in scored)
    holed = train.withColumn("score_bureau", F.lit(None).cast("double"))
    assert modeling.score(modeling.fit_logistic(holed, FEATURES, LABEL, 5), new).count() == 3


def test_portfolio_scores_cover_the_portfolio(spark):
    from silverlode.plans import credit, models

    sf = "/root/testdata/sf0.001"
    scores = models.score_portfolio(spark, sf)
    assert scores.count() == credit.portfolio(spark, sf).count()
    assert scores.where("proba is null").count() == 0
