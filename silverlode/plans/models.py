"""Models on the credit features and the texts: train, compare, explain, store, score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..operators import bayes, evaluate, logistic, modeling
from ..operators.features import FEATURES, LABEL, credit_features
from ..session import scratch_path, stage
from .comments import SQL_WORDS
from .common import portable, sql_round, table
from .credit import SCORE_DATE, SQL_NEW, SQL_SPLIT, portfolio, sql_features, train_test


def feature_sets(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Train and test features, written once because training reads them repeatedly."""
    train, test = train_test(spark, sf_dir)
    return stage(credit_features(train), "features_train"), stage(credit_features(test), "features_test")


def ml_logistic_scores(spark, sf_dir):
    train, test = feature_sets(spark, sf_dir)
    return logistic.fit_logistic(train, FEATURES, LABEL).predictions(test, "cliente_id", LABEL)


def ml_forest_scores(spark, sf_dir):
    train, test = feature_sets(spark, sf_dir)
    return modeling.prediction_table(modeling.fit_forest(train, FEATURES, LABEL), test, "cliente_id", LABEL)


def ml_compare(spark, sf_dir):
    train, test = feature_sets(spark, sf_dir)
    models = {
        "logistica": logistic.fit_logistic(train, FEATURES, LABEL),
        "floresta": modeling.fit_forest(train, FEATURES, LABEL),
    }
    return modeling.compare(models, test, LABEL)


def ml_importances(spark, sf_dir):
    train, _ = feature_sets(spark, sf_dir)
    return modeling.importances(spark, modeling.fit_forest(train, FEATURES, LABEL), FEATURES)


def ml_coefficients(spark, sf_dir):
    train, _ = feature_sets(spark, sf_dir)
    weights = logistic.fit_logistic(train, FEATURES, LABEL).coefficients(spark)
    return weights.withColumn("coeficiente", round_to(weights["coeficiente"], 8))


def score_portfolio(spark, sf_dir):
    """New customers scored by the stored model, as a later job would load it."""
    train, _ = feature_sets(spark, sf_dir)
    path = scratch_path(spark, "model")
    logistic.fit_logistic(train, FEATURES, LABEL).save(spark, path)
    scored = logistic.Logistic.load(spark, path).score(credit_features(portfolio(spark, sf_dir)))
    return portable(evaluate.decide(scored, F.col("p"), 0.2, "logistica", SCORE_DATE))


def text_classify_ml(spark, sf_dir):
    """Quality label of every document from a model trained on the labelled ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = bayes.naive_bayes(stage(docs.join(labels, "doc_id"), "labelled"), "text", "quality")
    shown = F.round(F.col("p")[model.classes.index(1)] if 1 in model.classes else F.lit(0.0), 4)
    return model.classify(docs, "doc_id", "text").select("doc_id", F.col("classe").cast("bigint").alias("quality_previsto"), shown.alias("proba"))


QUERIES = {
    f.__name__: f
    for f in (
        ml_logistic_scores, ml_forest_scores, ml_compare, ml_importances, ml_coefficients,
        score_portfolio, text_classify_ml,
    )
}

_D = len(FEATURES) + 1


def _eliminated(rows: str) -> str:
    """Gauss-Jordan elimination of the column ``m``, a list of rows, one nested query per pivot."""
    for k in range(1, _D + 1):
        rows = f"""(SELECT i, w, list_transform(m, lambda r, n: CASE WHEN n = {k} THEN list_transform(r, lambda v: v / m[{k}][{k}])
          ELSE list_transform(r, lambda v, c: v - r[{k}] * m[{k}][c] / m[{k}][{k}]) END) AS m FROM {rows})"""
    return rows


def _sql_fit() -> str:
    """CTE ``modelo``: the weights ``b`` per unit (the intercept first) after 20 Newton steps, and the fills."""
    at = range(_D)
    odds = " + ".join(f"w[{a + 1}] * z{a}" for a in at)
    system = ", ".join(
        f"""[{", ".join(f"sum(p * (1 - p) * z{a} * z{b}){f' + {logistic.RIDGE} * count(*)' if a == b else ''}" for b in at)},
          sum((y - p) * z{a}) - {logistic.RIDGE} * count(*) * any_value(w)[{a + 1}]]"""
        for a in at
    )
    named = list(enumerate(FEATURES, 1))
    return f"""{SQL_SPLIT}, ft AS ({sql_features("treino", True)}),
        meds AS (SELECT {", ".join(f"coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0) AS f{a}" for a, c in named)} FROM ft WHERE {LABEL} IS NOT NULL),
        xs AS (SELECT CAST({LABEL} AS DOUBLE) AS y, {", ".join(f"coalesce(CAST({c} AS DOUBLE), f{a}) AS x{a}" for a, c in named)} FROM ft, meds WHERE {LABEL} IS NOT NULL),
        forma AS (SELECT {", ".join(f"avg(x{a}) AS m{a}, coalesce(nullif(stddev_pop(x{a}), 0), 1) AS s{a}" for a, _ in named)} FROM xs),
        zs AS (SELECT y, 1.0::DOUBLE AS z0, {", ".join(f"(x{a} - m{a}) / s{a} AS z{a}" for a, _ in named)} FROM xs, forma),
        passos AS (SELECT 0 AS i, CAST([{", ".join("0" for _ in at)}] AS DOUBLE[]) AS w UNION ALL
          SELECT i + 1, list_transform(w, lambda v, c: v + m[c][{_D + 1}]) FROM {_eliminated(
            f"(SELECT i, any_value(w) AS w, [{system}] AS m FROM (SELECT *, 1 / (1 + exp(-({odds}))) AS p FROM passos, zs WHERE i < 20) GROUP BY i)")}),
        modelo AS (SELECT [w[1]{"".join(f" - w[{a + 1}] / s{a} * m{a}" for a, _ in named)}, {", ".join(f"w[{a + 1}] / s{a}" for a, _ in named)}] AS b, meds.*
          FROM passos, forma, meds WHERE i = 20)"""


_FIT = _sql_fit()
_P = "1 / (1 + exp(-(b[1]" + "".join(f" + b[{a + 1}] * coalesce(CAST({c} AS DOUBLE), f{a})" for a, c in enumerate(FEATURES, 1)) + ")))"
_B, _U = bayes.BUCKETS, bayes.UNIT
ORACLE = {
    "ml_logistic_scores": f"""WITH RECURSIVE {_FIT}, fs AS ({sql_features("teste", True)})
        SELECT cliente_id, {sql_round(_P, 4)} AS proba, {LABEL} AS real FROM fs, modelo""",
    "ml_coefficients": f"""WITH RECURSIVE {_FIT} SELECT unnest([{", ".join(f"'{c}'" for c in FEATURES)}]) AS feature,
        unnest([{", ".join(sql_round(f"b[{a}]", 8) for a in range(2, _D + 1))}]) AS coeficiente FROM modelo""",
    "score_portfolio": f"""WITH RECURSIVE {_FIT}, {SQL_NEW}, fn AS ({sql_features("carteira", False)})
        SELECT cliente_id, {sql_round(_P, 4)} AS proba, CASE WHEN {_P} >= 0.2 THEN 'revisar' ELSE 'aprovar' END AS decisao,
          'logistica' AS versao_modelo, '{SCORE_DATE}' AS data_score FROM fn, modelo""",
    "text_classify_ml": f"""WITH w0 AS (SELECT doc_id, unnest({SQL_WORDS.format(x="text")}) AS w FROM documents),
        w AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 7) AS INTEGER) % {_B} AS b, count(*) AS n FROM w0 GROUP BY 1, 2),
        rotulos AS (SELECT quality AS c, count(*) AS docs FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1),
        vistos AS (SELECT quality AS c, b, sum(n) AS n FROM w JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1, 2),
        totais AS (SELECT c, docs, coalesce(sum(n), 0) AS t FROM rotulos LEFT JOIN vistos USING (c) GROUP BY 1, 2),
        pesos AS (SELECT totais.c, g.b, CAST(round(ln((coalesce(n, 0) + 1.0) / CAST(t + {_B} AS DOUBLE)) * {_U}) AS BIGINT) AS peso
          FROM totais CROSS JOIN (SELECT unnest(range({_B})) AS b) g LEFT JOIN vistos ON vistos.c = totais.c AND vistos.b = g.b),
        prior AS (SELECT c, CAST(round(ln(CAST(docs AS DOUBLE) / sum(docs) OVER ()) * {_U}) AS BIGINT) AS peso FROM totais),
        somas AS (SELECT doc_id, c, sum(n * pesos.peso) AS s FROM w JOIN pesos USING (b) GROUP BY 1, 2),
        nota AS (SELECT doc_id, c, coalesce(s, 0) + prior.peso AS s FROM (SELECT DISTINCT doc_id FROM documents) CROSS JOIN prior LEFT JOIN somas USING (doc_id, c)),
        melhor AS (SELECT *, max(s) OVER (PARTITION BY doc_id) AS m FROM nota)
        SELECT doc_id, CAST(min(c) FILTER (s = m) AS BIGINT) AS quality_previsto,
          round(coalesce(sum(exp(CAST(s - m AS DOUBLE) / {_U})) FILTER (c = 1), 0) / sum(exp(CAST(s - m AS DOUBLE) / {_U})), 4) AS proba
        FROM melhor GROUP BY 1""",
}
