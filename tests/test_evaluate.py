import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from silverlode.operators import drift, evaluate, features

SCORED = "cliente_id string, proba double, real int"
ROWS = [("a", 0.9, 1), ("b", 0.5, 0), ("c", 0.5, 1), ("d", 0.1, 0), ("e", 0.05, 1)]


def test_confusion_and_ratios(spark, rows):
    df = spark.createDataFrame(ROWS, SCORED)
    assert rows(evaluate.confusion(df, 0.5)) == [(2, 1, 1, 1)]  # exactly t counts as positive
    assert rows(evaluate.precision_recall(evaluate.confusion(df, 0.5))) == [(0.667, 0.667)]
    assert rows(evaluate.precision_recall(evaluate.confusion(df, 0.99))) == [(None, 0.0)]


def test_sweep_cells_sum_to_rows(spark):
    df = spark.createDataFrame(ROWS, SCORED)
    for r in evaluate.threshold_sweep(df).collect():
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(ROWS)


def test_published_cost_arithmetic(spark, rows):
    cells = spark.createDataFrame([(0.2, 33, 60, 8, 84), (0.5, 14, 11, 27, 133)], "t double, tp long, fp long, fn long, tn long")
    costs = evaluate.cost_curve(cells)
    assert rows(costs, "t", "custo_total") == [(0.2, 140_000), (0.5, 281_000)]
    assert evaluate.best_threshold(costs).first()["t"] == 0.2
    tie = spark.createDataFrame([(0.6, 1, 1, 5), (0.3, 1, 1, 5)], "t double, fn long, fp long, custo_total long")
    assert evaluate.best_threshold(tie).first()["t"] == 0.3


def test_auc_counts_ties_as_half(spark):
    rnd = random.Random(2)
    data = [(str(i), round(rnd.random(), 2), int(rnd.random() < 0.4)) for i in range(400)]
    pos = [p for _, p, y in data if y]
    neg = [p for _, p, y in data if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    got = evaluate.auc(spark.createDataFrame(data, SCORED)).first()
    assert got["auc"] == pytest.approx(want, abs=1e-6)
    assert (got["positivos"], got["negativos"]) == (len(pos), len(neg))


def test_auc_without_negatives_is_null(spark):
    assert evaluate.auc(spark.createDataFrame([("a", 0.3, 1)], SCORED)).first()["auc"] is None


def test_decision_uses_unrounded_probability(spark, rows):
    df = spark.createDataFrame([("a", 0.19996), ("b", 0.2)], "cliente_id string, p double")
    got = evaluate.decide(df, F.col("p"), 0.2, "v1", date(2026, 1, 1))
    assert rows(got, "cliente_id", "proba", "decisao") == [("a", 0.2, "aprovar"), ("b", 0.2, "revisar")]


def test_split_and_features(spark, rows):
    df = spark.createDataFrame(
        [(f"C{i:04d}", 600.0, i % 3, 1200.0, 1000.0, 12, 18, "App", 0) for i in range(10)]
        + [("C0099", 600.0, 0, 1200.0, 0.0, 12, 18, "Agencia", 1)],
        "cliente_id string, score_bureau double, atrasos_previos int, valor_emprestimo double, renda_mensal double, "
        "prazo_meses int, tempo_relacionamento_meses int, canal string, inadimplente int",
    )
    train, test = features.split(df, features.numeric_bucket("cliente_id"))
    assert train.count() + test.count() == df.count() and rows(test, "cliente_id") == [("C0002",), ("C0007",)]
    out = {r["cliente_id"]: r for r in features.credit_features(df).collect()}
    assert out["C0001"]["comprometimento"] == 1.2 and out["C0001"]["relacionamento_anos"] == 1.5
    assert out["C0001"]["tem_atraso"] == 1 and out["C0000"]["tem_atraso"] == 0 and out["C0001"]["canal_app"] == 1
    assert out["C0099"]["comprometimento"] is None and out["C0099"]["renda_log"] is None  # zero income
    assert "inadimplente" not in features.credit_features(df.drop("inadimplente")).columns
    buckets = df.select(features.hash_bucket("cliente_id").alias("b")).distinct().collect()
    assert {r["b"] for r in buckets} <= set(range(5))


def test_drift_with_an_empty_band(spark, rows):
    ref = spark.createDataFrame([(v,) for v in [400.0] * 4 + [600.0] * 4 + [850.0] * 2], "score_bureau double")
    new = spark.createDataFrame([(v,) for v in [400.0] * 8 + [700.0] * 2], "score_bureau double")
    band = drift.score_band(F.col("score_bureau"))
    assert rows(drift.band_pairs(ref, new, band)) == [("300-500", 0.4, 0.8), ("501-650", 0.4, 0.0), ("801-900", 0.2, 0.0)]
    assert drift.band_pairs(ref, new, band, "full").count() == 4
    psi = drift.stability_index(drift.band_pairs(ref, new, band))
    assert rows(drift.drift_status(psi, "score")) == [("score", 3.722, "ALERTA_RETREINAR")]
    same = drift.stability_index(drift.band_pairs(ref, ref, band))
    assert rows(drift.drift_status(same, "score")) == [("score", 0.0, "OK")]


def test_status_limits_are_exclusive(spark, rows):
    psi = spark.createDataFrame([(0.25,), (0.251,), (0.1,), (0.101,)], "psi double")
    assert rows(drift.drift_status(psi, "x"), "psi", "status") == [
        (0.1, "OK"), (0.101, "ATENCAO"), (0.25, "ATENCAO"), (0.251, "ALERTA_RETREINAR"),
    ]


def test_quartile_bands_come_from_the_reference(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    new = spark.createDataFrame([(1000.0,)] * 10, "x double")
    pairs = {r["faixa"]: (r["p"], r["q"]) for r in drift.quartile_pairs(ref, new, "x").collect()}
    assert pairs == {"q1": (0.25, 0.0), "q2": (0.25, 0.0), "q3": (0.25, 0.0), "q4": (0.25, 1.0)}
