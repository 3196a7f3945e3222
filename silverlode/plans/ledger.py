"""Ledger track: messy bronze text derived from orders and customers, up to the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold, money, multi_date, recode, tidy, title
from ..operators import clean, metrics, quality, star
from ..session import stage
from .common import portable, sql_fold, sql_initcap, sql_list, sql_round, sql_text, table

# Spellings the generated ledger cycles through.
RAW_CATEGORIES = [
    "SOFTWARE", "Licenças", "impostos", "Tributos ", "Salários", "folha", "Folha de Pagamento",
    "Aluguel", " LOCAÇÃO", "marketing", "Publicidade", "Anúncios", "VIAGENS", "viagem",
    "Infraestrutura", "infra", "CLOUD", "serviços", "Consultoria", "material", "Materiais",
    "suprimentos", "Vendas", "venda mensal", "Serviços Prestados", "Prestação de Serviços",
    "Juros", "rendimentos", "investimentos", "APLICAÇÕES", " ", "Outros", None,
]
RAW_INCOME = ["Receita", "receita", " RECEITA"]
RAW_EXPENSE = ["Despesa", "DESPESA", "despesa "]


def bronze_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text ledger with mixed formats, gaps, unknown labels and exact copies."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("o_orderkey")
    seg = F.col("c_mktsegment")
    amount = F.col("o_totalprice").cast("decimal(12,2)")
    grouped = F.format_number(amount, 2)
    day = F.col("o_orderdate").cast("date")

    def pick(options: list, by) -> object:
        return F.element_at(F.array(*[F.lit(o) for o in options]), (by % len(options) + 1).cast("int"))

    raw = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("L"), k.cast("string"), F.when(k % 3 == 0, F.lit(" ")).otherwise(F.lit(""))).alias("id_lancamento"),
        F.when(k % 97 == 5, F.lit(None).cast("string"))
        .when(k % 89 == 3, F.lit("sem data"))
        .when(k % 2 == 0, F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
        .alias("data_lancamento"),
        F.when(k % 4 == 0, F.concat(seg, F.lit(" ")))
        .when(k % 4 == 1, F.lower(seg))
        .when(k % 4 == 2, F.translate(F.lower(seg), "aeou", "áéõú"))
        .otherwise(F.concat(F.lit(" "), F.translate(seg, "AEOU", "ÁÉÕÚ")))
        .alias("centro_custo"),
        pick(RAW_CATEGORIES, k).alias("categoria"),
        F.when(k % 101 == 7, F.lit(None).cast("string"))
        .when(k % 4 == 0, F.concat(F.lit("R$ "), grouped))
        .when(k % 4 == 1, amount.cast("string"))
        .when(k % 4 == 2, F.concat(F.lit("  "), grouped, F.lit(" ")))
        .otherwise(F.concat(F.lit("R$"), amount.cast("string")))
        .alias("valor"),
        F.when((F.col("o_orderstatus") == "P") & (k % 50 == 0), F.lit("Estorno"))
        .when(F.col("o_orderstatus") == "F", pick(RAW_INCOME, k))
        .otherwise(pick(RAW_EXPENSE, k))
        .alias("tipo"),
        F.concat(F.lit("  PEDIDO   "), F.col("o_orderpriority"), F.lit("  ")).alias("descricao"),
        F.explode(F.sequence(F.lit(1), F.when(k % 47 == 0, F.lit(2)).otherwise(F.lit(1)))).alias("_copy"),
    )
    return raw.drop("_copy")


_AMOUNT = "CAST(o_totalprice AS DECIMAL(12,2))"
_GROUPED = "format('{:,.2f}', o_totalprice)"


def _sql_pick(options: list) -> str:
    return f"({sql_list(options)})[CAST(o_orderkey % {len(options)} + 1 AS INTEGER)]"


_RAW_SELECT = f"""
  SELECT concat('L', o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE '' END) AS id_lancamento,
    CASE WHEN o_orderkey % 97 = 5 THEN NULL WHEN o_orderkey % 89 = 3 THEN 'sem data'
         WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
         ELSE strftime(o_orderdate, '%d/%m/%Y') END AS data_lancamento,
    CASE o_orderkey % 4 WHEN 0 THEN c_mktsegment || ' ' WHEN 1 THEN lower(c_mktsegment)
         WHEN 2 THEN translate(lower(c_mktsegment), 'aeou', 'áéõú')
         ELSE ' ' || translate(c_mktsegment, 'AEOU', 'ÁÉÕÚ') END AS centro_custo,
    {_sql_pick(RAW_CATEGORIES)} AS categoria,
    CASE WHEN o_orderkey % 101 = 7 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'R$ ' || {_GROUPED}
         WHEN o_orderkey % 4 = 1 THEN CAST({_AMOUNT} AS VARCHAR)
         WHEN o_orderkey % 4 = 2 THEN '  ' || {_GROUPED} || ' '
         ELSE 'R$' || CAST({_AMOUNT} AS VARCHAR) END AS valor,
    CASE WHEN o_orderstatus = 'P' AND o_orderkey % 50 = 0 THEN 'Estorno'
         WHEN o_orderstatus = 'F' THEN {_sql_pick(RAW_INCOME)} ELSE {_sql_pick(RAW_EXPENSE)} END AS tipo,
    '  PEDIDO   ' || o_orderpriority || '  ' AS descricao
  FROM orders JOIN customer ON o_custkey = c_custkey"""
SQL_BRONZE = f"bronze AS ({_RAW_SELECT} UNION ALL {_RAW_SELECT} WHERE o_orderkey % 47 = 0)"

_SQL_CATEGORY = (
    f"CASE trim({sql_fold('categoria')}) "
    + " ".join(f"WHEN {sql_text(k)} THEN {sql_text(v)}" for k, v in clean.CATEGORY_LABELS.items())
    + " ELSE 'Sem Categoria' END"
)
_SQL_TYPE = "CASE lower(trim(tipo)) WHEN 'receita' THEN 'Receita' WHEN 'despesa' THEN 'Despesa' END"
_SQL_DATE = (
    "CAST(coalesce(try_strptime(data_lancamento, '%Y-%m-%d'), "
    "try_strptime(data_lancamento, '%d/%m/%Y')) AS DATE)"
)
_SQL_MONEY = "TRY_CAST(regexp_replace(valor, '[^0-9.]', '', 'g') AS DECIMAL(12,2))"
_SQL_CC = sql_initcap(f"trim({sql_fold('centro_custo')})")
_SQL_TIDY = r"trim(regexp_replace(descricao, '\s+', ' ', 'g'))"
SQL_CLEAN = f"""clean AS (SELECT trim(id_lancamento) AS id_lancamento, {_SQL_DATE} AS data_lancamento,
  {_SQL_CC} AS centro_custo, {_SQL_CATEGORY} AS categoria, {_SQL_MONEY} AS valor, {_SQL_TYPE} AS tipo,
  {sql_initcap(_SQL_TIDY)} AS descricao FROM bronze)"""
SQL_SILVER = f"""{SQL_BRONZE}, {SQL_CLEAN}, silver AS (SELECT DISTINCT * FROM clean
  WHERE data_lancamento IS NOT NULL AND valor IS NOT NULL)"""
SQL_GROUP = (
    f"CASE WHEN categoria IN ({', '.join(map(sql_text, star.REVENUE_CATEGORIES))}) THEN 'Receita' "
    f"WHEN categoria IN ({', '.join(map(sql_text, star.PEOPLE_CATEGORIES))}) THEN 'Pessoas' ELSE 'Operacional' END"
)


def _sql_dim(col: str, key: str, name: str) -> str:
    return (
        f"(SELECT row_number() OVER (ORDER BY {col}) AS {key}, {col} AS {name} "
        f"FROM (SELECT DISTINCT {col} FROM silver WHERE {col} IS NOT NULL))"
    )


SQL_STAR = f"""{SQL_SILVER},
dim_cc AS {_sql_dim("centro_custo", "sk_centro_custo", "nome_centro_custo")},
dim_cat AS {_sql_dim("categoria", "sk_categoria", "nome_categoria")},
dim_type AS {_sql_dim("tipo", "sk_tipo", "tipo")},
dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS sk_data, d AS data_completa,
  year(d) AS ano, month(d) AS mes, strftime(d, '%B') AS nome_mes, quarter(d) AS trimestre, day(d) AS dia,
  strftime(d, '%A') AS dia_semana FROM (SELECT DISTINCT data_lancamento AS d FROM silver)),
fact AS (SELECT id_lancamento, CAST(strftime(data_lancamento, '%Y%m%d') AS BIGINT) AS sk_data,
  sk_centro_custo, sk_categoria, sk_tipo, s.tipo, valor,
  CASE WHEN s.tipo = 'Receita' THEN valor ELSE -valor END AS valor_sinalizado, descricao
  FROM silver s JOIN dim_cc ON centro_custo = nome_centro_custo
  JOIN dim_cat ON categoria = nome_categoria JOIN dim_type t ON s.tipo = t.tipo)"""


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as the stored layer it is: later layers read its files, not its making."""
    return stage(bronze_ledger(spark, sf_dir), "bronze")


def silver(spark: SparkSession, sf_dir: str, on_missing_date: str = "drop") -> DataFrame:
    return clean.silver_ledger(bronze_ledger(spark, sf_dir), on_missing_date)


def gold(spark: SparkSession, sf_dir: str) -> star.Star:
    return star.Star(silver(spark, sf_dir))


def proj_standardise(spark, sf_dir):
    b = bronze_ledger(spark, sf_dir)
    return b.select(
        F.lit("ledger").alias("origem"),
        F.trim("id_lancamento").alias("id"),
        F.trim("valor").alias("valor_texto"),
        F.lower(F.trim("tipo")).alias("tipo_texto"),
    )


def clean_text(spark, sf_dir):
    b = bronze_ledger(spark, sf_dir)
    return b.select(
        F.trim("id_lancamento").alias("id"),
        title(fold(F.col("centro_custo"))).alias("centro_custo"),
        F.trim(fold(F.col("categoria"))).alias("categoria"),
        tidy(F.col("descricao")).alias("descricao"),
        F.initcap(tidy(F.col("descricao"))).alias("descricao_titulo"),
    )


def clean_money(spark, sf_dir):
    b = bronze_ledger(spark, sf_dir)
    return portable(b.select(F.trim("id_lancamento").alias("id"), money(F.col("valor")).alias("valor")))


def clean_date_multi(spark, sf_dir):
    b = bronze_ledger(spark, sf_dir)
    d = F.col("data_lancamento")
    return portable(
        b.select(
            F.trim("id_lancamento").alias("id"),
            multi_date(d, clean.DATE_FORMATS).alias("data"),
            multi_date(d, clean.DATE_FORMATS, clean.SENTINEL_DATE).alias("data_ou_padrao"),
        )
    )


def clean_cast(spark, sf_dir):
    b = bronze_ledger(spark, sf_dir)
    d = multi_date(F.col("data_lancamento"), clean.DATE_FORMATS)
    return b.select(
        F.trim("id_lancamento").alias("id"),
        F.substr(F.trim("id_lancamento"), F.lit(2)).cast("bigint").alias("numero"),
        star.date_key(d).cast("bigint").alias("data_inteira"),
        money(F.col("valor")).cast("string").alias("valor_texto"),
    )


def clean_recode(spark, sf_dir):
    b = bronze_ledger(spark, sf_dir)
    return b.select(
        F.trim("id_lancamento").alias("id"),
        recode(F.col("categoria"), clean.CATEGORY_LABELS, clean.NO_CATEGORY).alias("categoria"),
        recode(F.col("tipo"), clean.TYPE_LABELS).alias("tipo"),
    )


def clean_drop_unusable(spark, sf_dir):
    rows = bronze_ledger(spark, sf_dir).select(*clean.ledger_columns())
    kept = clean.drop_unusable(rows, ["data_lancamento", "valor"])
    return portable(kept.select("id_lancamento", "data_lancamento", "valor"))


def clean_dedupe_exact(spark, sf_dir):
    return bronze_ledger(spark, sf_dir).distinct()


def dedupe_by_key(spark, sf_dir):
    rows = bronze_ledger(spark, sf_dir).select(*clean.ledger_columns())
    one = clean.dedupe_by_key(
        rows.select("categoria", "id_lancamento", "data_lancamento", "valor"),
        ["categoria"],
        [-F.coalesce(F.col("valor"), F.lit(0).cast("decimal(12,2)")), F.col("id_lancamento")],
    )
    return portable(one)


def silver_ledger(spark, sf_dir):
    return portable(silver(spark, sf_dir))


def profile_variants(spark, sf_dir):
    b = bronze_ledger(spark, sf_dir)
    return (
        b.groupBy(F.lower(F.trim("categoria")).alias("variante"))
        .agg(F.count(F.lit(1)).alias("linhas"))
        .orderBy("variante")
    )


def dim_cost_centre(spark, sf_dir):
    return star.dimension(silver(spark, sf_dir), "centro_custo", "sk_centro_custo", "nome_centro_custo")


def dim_category(spark, sf_dir):
    return star.category_dimension(silver(spark, sf_dir))


def dim_type(spark, sf_dir):
    return star.dimension(silver(spark, sf_dir), "tipo", "sk_tipo", "tipo", bounded=True)


def dim_date(spark, sf_dir):
    return portable(star.date_dimension(silver(spark, sf_dir)))


def fact_build(spark, sf_dir):
    return portable(gold(spark, sf_dir).fact)


def metric_kpi(spark, sf_dir):
    return portable(metrics.kpi(gold(spark, sf_dir).fact))


def metric_net_by_month(spark, sf_dir):
    g = gold(spark, sf_dir)
    return portable(metrics.net_by_month(g.fact, g.dates))


def metric_expense_by_cc(spark, sf_dir):
    g = gold(spark, sf_dir)
    return portable(metrics.expense_by_cost_centre(g.fact, g.cost_centres))


def metric_top_categories(spark, sf_dir):
    g = gold(spark, sf_dir)
    return portable(metrics.top_categories(g.fact, g.categories))


def metric_by_month_type(spark, sf_dir):
    g = gold(spark, sf_dir)
    return portable(metrics.by_month_and_type(g.fact, g.dates))


def metric_avg_expense(spark, sf_dir):
    return portable(metrics.average_expense(gold(spark, sf_dir).fact))


def metric_mom_growth(spark, sf_dir):
    g = gold(spark, sf_dir)
    return portable(metrics.month_growth(metrics.net_by_month(g.fact, g.dates)))


def metric_top3_cc(spark, sf_dir):
    g = gold(spark, sf_dir)
    return portable(metrics.top_cost_centres(g.fact, g.cost_centres))


def dq_silver_report(spark, sf_dir):
    return quality.silver_report(silver(spark, sf_dir))


def dq_duplicate_keys(spark, sf_dir):
    ids = bronze_ledger(spark, sf_dir).select(F.trim("id_lancamento").alias("id_lancamento"))
    return quality.duplicate_keys(ids, ["id_lancamento"])


def dq_fact_orphans(spark, sf_dir):
    """Key gaps of the fact plus, for each dimension, the silver rows its inner join loses."""
    g = gold(spark, sf_dir)
    keys = ["sk_centro_custo", "sk_categoria", "sk_data", "sk_tipo"]
    lost = {
        "centro_custo": quality.orphans(g.silver, g.cost_centres, "centro_custo", "nome_centro_custo"),
        "categoria": quality.orphans(g.silver, g.categories, "categoria", "nome_categoria"),
        "tipo": quality.orphans(g.silver, g.types.withColumnRenamed("tipo", "nome_tipo"), "tipo", "nome_tipo"),
    }
    report = quality.fact_key_report(g.fact, keys)
    for name, rows in lost.items():
        report = report.withColumn(f"linhas_sem_{name}", rows.agg(F.count(F.lit(1)).alias("n")).scalar())
    return report


def dq_layer_counts(spark, sf_dir):
    bronze = bronze_table(spark, sf_dir)
    g = star.Star(clean.silver_ledger(bronze))
    return quality.layer_counts(
        {
            "bronze": bronze,
            "silver": g.silver,
            "dim_centro_custo": g.cost_centres,
            "dim_categoria": g.categories,
            "dim_data": g.dates,
            "fato": g.fact,
        }
    )


QUERIES = {
    f.__name__: f
    for f in (
        proj_standardise, clean_text, clean_money, clean_date_multi, clean_cast, clean_recode,
        clean_drop_unusable, clean_dedupe_exact, dedupe_by_key, silver_ledger, profile_variants,
        dim_cost_centre, dim_category, dim_type, dim_date, fact_build, metric_kpi, metric_net_by_month,
        metric_expense_by_cc, metric_top_categories, metric_by_month_type, metric_avg_expense,
        metric_mom_growth, metric_top3_cc, dq_silver_report, dq_duplicate_keys, dq_fact_orphans,
        dq_layer_counts,
    )
}

_MONTHLY = """SELECT ano, mes, nome_mes, sum(valor_sinalizado) AS v FROM fact
  JOIN dim_date USING (sk_data) GROUP BY ano, mes, nome_mes"""

ORACLE = {
    "proj_standardise": f"""WITH {SQL_BRONZE} SELECT 'ledger' AS origem, trim(id_lancamento) AS id,
        trim(valor) AS valor_texto, lower(trim(tipo)) AS tipo_texto FROM bronze""",
    "clean_text": f"""WITH {SQL_BRONZE} SELECT trim(id_lancamento) AS id, {_SQL_CC} AS centro_custo,
        trim({sql_fold("categoria")}) AS categoria, {_SQL_TIDY} AS descricao,
        {sql_initcap(_SQL_TIDY)} AS descricao_titulo FROM bronze""",
    "clean_money": f"WITH {SQL_BRONZE} SELECT trim(id_lancamento) AS id, CAST({_SQL_MONEY} AS DOUBLE) AS valor FROM bronze",
    "clean_date_multi": f"""WITH {SQL_BRONZE} SELECT trim(id_lancamento) AS id, CAST({_SQL_DATE} AS VARCHAR) AS data,
        CAST(coalesce({_SQL_DATE}, DATE '1900-01-01') AS VARCHAR) AS data_ou_padrao FROM bronze""",
    "clean_cast": f"""WITH {SQL_BRONZE} SELECT trim(id_lancamento) AS id,
        CAST(substr(trim(id_lancamento), 2) AS BIGINT) AS numero,
        CAST(strftime({_SQL_DATE}, '%Y%m%d') AS BIGINT) AS data_inteira,
        CAST({_SQL_MONEY} AS VARCHAR) AS valor_texto FROM bronze""",
    "clean_recode": f"""WITH {SQL_BRONZE} SELECT trim(id_lancamento) AS id, {_SQL_CATEGORY} AS categoria,
        {_SQL_TYPE} AS tipo FROM bronze""",
    "clean_drop_unusable": f"""WITH {SQL_BRONZE}, {SQL_CLEAN} SELECT id_lancamento,
        CAST(data_lancamento AS VARCHAR) AS data_lancamento, CAST(valor AS DOUBLE) AS valor
        FROM clean WHERE data_lancamento IS NOT NULL AND valor IS NOT NULL""",
    "clean_dedupe_exact": f"WITH {SQL_BRONZE} SELECT DISTINCT * FROM bronze",
    "dedupe_by_key": f"""WITH {SQL_BRONZE}, {SQL_CLEAN} SELECT categoria, id_lancamento,
        CAST(data_lancamento AS VARCHAR) AS data_lancamento, CAST(valor AS DOUBLE) AS valor FROM (
          SELECT *, row_number() OVER (PARTITION BY categoria
            ORDER BY coalesce(valor, 0) DESC, id_lancamento, data_lancamento) AS rn FROM clean) WHERE rn = 1""",
    "silver_ledger": f"""WITH {SQL_SILVER} SELECT * REPLACE (CAST(data_lancamento AS VARCHAR) AS data_lancamento,
        CAST(valor AS DOUBLE) AS valor) FROM silver""",
    "profile_variants": f"""WITH {SQL_BRONZE} SELECT lower(trim(categoria)) AS variante, count(*) AS linhas
        FROM bronze GROUP BY 1 ORDER BY 1""",
    "dim_cost_centre": f"WITH {SQL_STAR} SELECT * FROM dim_cc",
    "dim_category": f"""WITH {SQL_STAR} SELECT sk_categoria, nome_categoria,
        {SQL_GROUP.replace("categoria IN", "nome_categoria IN")} AS grupo_categoria FROM dim_cat""",
    "dim_type": f"WITH {SQL_STAR} SELECT * FROM dim_type",
    "dim_date": f"WITH {SQL_STAR} SELECT * REPLACE (CAST(data_completa AS VARCHAR) AS data_completa) FROM dim_date",
    "fact_build": f"""WITH {SQL_STAR} SELECT * REPLACE (CAST(valor AS DOUBLE) AS valor,
        CAST(valor_sinalizado AS DOUBLE) AS valor_sinalizado) FROM fact""",
    "metric_kpi": f"""WITH {SQL_STAR} SELECT
        CAST(sum(CASE WHEN tipo = 'Receita' THEN valor ELSE 0 END) AS DOUBLE) AS total_receita,
        CAST(sum(CASE WHEN tipo = 'Despesa' THEN valor ELSE 0 END) AS DOUBLE) AS total_despesa,
        CAST(sum(valor_sinalizado) AS DOUBLE) AS resultado_liquido FROM fact""",
    "metric_net_by_month": f"""WITH {SQL_STAR} SELECT ano, mes, nome_mes, CAST(v AS DOUBLE) AS resultado_liquido
        FROM ({_MONTHLY}) ORDER BY ano, mes""",
    "metric_expense_by_cc": f"""WITH {SQL_STAR} SELECT nome_centro_custo, CAST(sum(valor) AS DOUBLE) AS total_despesa
        FROM fact JOIN dim_cc USING (sk_centro_custo) WHERE tipo = 'Despesa' GROUP BY 1 ORDER BY 2 DESC""",
    "metric_top_categories": f"""WITH {SQL_STAR} SELECT nome_categoria, CAST(sum(valor) AS DOUBLE) AS total_despesa,
        count(*) AS lancamentos FROM fact JOIN dim_cat USING (sk_categoria) WHERE tipo = 'Despesa'
        GROUP BY 1 ORDER BY sum(valor) DESC, 1 LIMIT 10""",
    "metric_by_month_type": f"""WITH {SQL_STAR} SELECT ano, mes, tipo, CAST(sum(valor) AS DOUBLE) AS total FROM fact
        JOIN dim_date USING (sk_data) GROUP BY ano, mes, tipo ORDER BY ano, mes, tipo""",
    "metric_avg_expense": f"""WITH {SQL_STAR} SELECT CAST(sum(valor) AS DOUBLE) AS total_despesa,
        count(*) AS lancamentos, {sql_round("CAST(sum(valor) AS DOUBLE) / count(*)", 2)} AS despesa_media
        FROM fact WHERE tipo = 'Despesa'""",
    "metric_mom_growth": f"""WITH {SQL_STAR}, m AS ({_MONTHLY}), g AS (SELECT ano, mes, CAST(v AS DOUBLE) AS now,
        lag(CAST(v AS DOUBLE)) OVER (ORDER BY ano, mes) AS before FROM m)
        SELECT ano, mes, now AS resultado_liquido,
        {sql_round("now / nullif(before, 0) * 100 - 100", 2)} AS crescimento_pct FROM g""",
    "metric_top3_cc": f"""WITH {SQL_STAR} SELECT nome_centro_custo, CAST(sum(valor_sinalizado) AS DOUBLE) AS resultado
        FROM fact JOIN dim_cc USING (sk_centro_custo) GROUP BY 1 ORDER BY sum(valor_sinalizado) DESC, 1 LIMIT 3""",
    "dq_silver_report": f"""WITH {SQL_SILVER} SELECT count(*) AS linhas, count(DISTINCT id_lancamento) AS ids_distintos,
        count(*) FILTER (data_lancamento IS NULL) AS datas_nulas, count(*) FILTER (valor IS NULL) AS valores_nulos,
        count(DISTINCT tipo) AS tipos_distintos FROM silver""",
    "dq_duplicate_keys": f"""WITH {SQL_BRONZE} SELECT trim(id_lancamento) AS id_lancamento, count(*) AS linhas
        FROM bronze GROUP BY 1 HAVING count(*) > 1""",
    "dq_fact_orphans": f"""WITH {SQL_STAR} SELECT count(*) AS linhas_fato,
        count(*) FILTER (sk_centro_custo IS NULL) AS sk_centro_custo_faltando,
        count(*) FILTER (sk_categoria IS NULL) AS sk_categoria_faltando,
        count(*) FILTER (sk_data IS NULL) AS sk_data_faltando,
        count(*) FILTER (sk_tipo IS NULL) AS sk_tipo_faltando,
        (SELECT count(*) FROM silver WHERE centro_custo IS NULL) AS linhas_sem_centro_custo,
        (SELECT count(*) FROM silver WHERE categoria IS NULL) AS linhas_sem_categoria,
        (SELECT count(*) FROM silver WHERE tipo IS NULL) AS linhas_sem_tipo FROM fact""",
    "dq_layer_counts": f"""WITH {SQL_STAR} SELECT 'bronze' AS camada, count(*) AS linhas FROM bronze
        UNION ALL SELECT 'silver', count(*) FROM silver
        UNION ALL SELECT 'dim_centro_custo', count(*) FROM dim_cc
        UNION ALL SELECT 'dim_categoria', count(*) FROM dim_cat
        UNION ALL SELECT 'dim_data', count(*) FROM dim_date
        UNION ALL SELECT 'fato', count(*) FROM fact""",
}
