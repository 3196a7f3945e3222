"""Free text: labels, counts, risk per label, concatenation and summaries over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate, textops
from .common import sql_list, sql_round, table
from .credit import SQL_DECIDED, SQL_LATE, SQL_MEAN, SQL_NEW, decided_portfolio

# Keywords per label for the multilingual documents.
KEYWORDS = {
    "elogio": ["the", "is", "und", "le"],
    "reclamacao": ["of", "in", "der", "la"],
    "duvida": ["and", "to", "die", "que"],
}
DEFAULT = "duvida"


def classified(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return textops.classify(docs, "text", KEYWORDS, DEFAULT)


SQL_WORDS = r"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}]+'), lambda w: w <> '')"
_HITS = {k: f"len(list_filter(ws, lambda w: list_contains({sql_list(v)}, w)))" for k, v in KEYWORDS.items()}
SQL_CLASSIFIED = f"""w AS (SELECT doc_id, text, {SQL_WORDS.format(x="text")} AS ws FROM documents),
hits AS (SELECT doc_id, text, {", ".join(f"{v} AS {k}" for k, v in _HITS.items())} FROM w),
classified AS (SELECT doc_id, text, CASE WHEN greatest(elogio, reclamacao, duvida) = 0 THEN '{DEFAULT}'
  WHEN elogio >= reclamacao AND elogio >= duvida THEN 'elogio'
  WHEN reclamacao >= duvida THEN 'reclamacao' ELSE 'duvida' END AS tipo FROM hits)"""


def text_classify(spark, sf_dir):
    return classified(spark, sf_dir).select("doc_id", "tipo")


def text_class_counts(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("tipo").agg(F.count(F.lit(1)).alias("qtd"))


def risk_by_text_class(spark, sf_dir):
    """Mean risk of the customers behind each kind of comment."""
    comments = classified(spark, sf_dir).select(
        F.concat(F.lit("N"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("cliente_id"), "tipo"
    )
    scored = decided_portfolio(spark, sf_dir).select("cliente_id", "proba")
    return evaluate.risk_by(comments.join(scored, "cliente_id"), "tipo")


def text_concat_by_group(spark, sf_dir):
    return textops.concat_parts(classified(spark, sf_dir), "tipo", "text", "doc_id")


def text_extractive_summary(spark, sf_dir):
    return textops.extractive_summary(classified(spark, sf_dir), "tipo", "text", "doc_id", k=3)


QUERIES = {
    f.__name__: f
    for f in (text_classify, text_class_counts, risk_by_text_class, text_concat_by_group, text_extractive_summary)
}

ORACLE = {
    "text_classify": f"WITH {SQL_CLASSIFIED} SELECT doc_id, tipo FROM classified",
    "text_class_counts": f"WITH {SQL_CLASSIFIED} SELECT tipo, count(*) AS qtd FROM classified GROUP BY 1",
    "risk_by_text_class": f"""WITH {SQL_LATE}, {SQL_NEW}, {SQL_DECIDED}, {SQL_CLASSIFIED}
        SELECT tipo, count(*) AS clientes, {SQL_MEAN} AS risco_medio FROM classified
        JOIN predicoes ON cliente_id = 'N' || lpad(CAST(doc_id AS VARCHAR), 12, '0') GROUP BY 1""",
    "text_concat_by_group": f"""WITH {SQL_CLASSIFIED} SELECT tipo, doc_id // 64 AS parte, count(*) AS textos,
        string_agg(text, ' | ' ORDER BY doc_id) AS texto FROM classified GROUP BY 1, 2""",
    "text_extractive_summary": f"""WITH {SQL_CLASSIFIED},
        s0 AS (SELECT tipo, doc_id, list_transform(regexp_split_to_array(text, '[.!?\\n]+'), lambda s: trim(s)) AS ss FROM classified),
        s AS (SELECT tipo, doc_id, unnest(ss) AS frase, unnest(range(0, len(ss))) AS pos FROM s0),
        w2 AS (SELECT tipo, doc_id, pos, unnest({SQL_WORDS.format(x="frase")}) AS w FROM s),
        tf AS (SELECT tipo, w, count(*) AS tf FROM w2 GROUP BY 1, 2),
        sc AS (SELECT tipo, doc_id, pos, CAST(sum(tf) AS DOUBLE) / count(*) AS score FROM w2 JOIN tf USING (tipo, w) GROUP BY 1, 2, 3),
        r AS (SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY score DESC, doc_id, pos) AS posicao FROM sc)
        SELECT tipo, posicao, doc_id, pos, {sql_round("score", 4)} AS score, frase FROM r JOIN s USING (tipo, doc_id, pos)
        WHERE posicao <= 3""",
}
