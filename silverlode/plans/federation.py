"""Sales, credit contracts and branch transactions: joins, aggregates, views, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import ratio, round_to
from ..operators import joins, keys, maintain, materialize, windows
from ..session import scratch_path
from ..sources.sinks import write_replace
from .common import portable, sql_initcap, sql_round, table

CHANNELS = [spelled for name in ("app", "web", "agencia") for spelled in (name.title(), name.upper())]


def sales(spark, sf_dir) -> DataFrame:
    """venda_id, cidade, cliente_id, valor_venda"""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    joined = joins.enrich(orders, (customer, "o_custkey", "c_custkey"), (nation, "c_nationkey", "n_nationkey"))
    return joined.select(
        F.col("o_orderkey").alias("venda_id"),
        F.col("n_name").alias("cidade"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("valor_venda"),
    )


def contracts(spark, sf_dir) -> DataFrame:
    """One to three credit contracts per customer."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_acctbal", F.explode(F.sequence(F.lit(1), (k % 3 + 1).cast("int"))).alias("n")
    )
    status = F.when((k + F.col("n")) % 3 == 0, "aprovado").when((k + F.col("n")) % 3 == 1, "recusado").otherwise("pendente")
    return rows.select(
        k.alias("cliente_id"),
        F.col("c_mktsegment").alias("tipo_produto"),
        (F.abs(F.col("c_acctbal")).cast("decimal(12,2)") * F.col("n")).cast("decimal(12,2)").alias("valor_contratado"),
        status.alias("status"),
    )


def products(spark, sf_dir) -> DataFrame:
    code = F.col("tipo_produto")
    return (
        table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("tipo_produto")).distinct().select(
            code,
            F.concat(F.lit("Credito "), F.initcap(code)).alias("nome_produto"),
            (F.length(code) * 0.25).cast("decimal(5,2)").alias("taxa_juros_mensal"),
        )
    )


def targets(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").where(k % 7 != 6).select(
        F.col("n_name").alias("cidade"), ((k + 1) * 1000000).cast("decimal(14,2)").alias("meta_receita")
    )


def transactions(spark, sf_dir) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "concluida").when(F.col("o_orderstatus") == "O", "pendente").otherwise("cancelada")
    return table(spark, sf_dir, "orders").select(
        k.alias("transacao_id"),
        F.col("o_custkey").alias("cliente_id"),
        (F.col("o_custkey") % 25).alias("agencia_id"),
        F.col("o_orderdate").cast("date").alias("data_transacao"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("valor"),
        F.element_at(F.array(*map(F.lit, CHANNELS)), (k % 6 + 1).cast("int")).alias("canal"),
        status.alias("status"),
    )


def branches(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("agencia_id"), F.col("n_name").alias("cidade")
    )


def clients(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cliente_id"), F.col("c_name").alias("nome"))


SQL_SALES = """vendas AS (SELECT o_orderkey AS venda_id, n_name AS cidade, o_custkey AS cliente_id,
  CAST(o_totalprice AS DECIMAL(12,2)) AS valor_venda FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""
SQL_CONTRACTS = """contratos AS (SELECT c_custkey AS cliente_id, c_mktsegment AS tipo_produto,
  CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) * n AS DECIMAL(12,2)) AS valor_contratado,
  CASE (c_custkey + n) % 3 WHEN 0 THEN 'aprovado' WHEN 1 THEN 'recusado' ELSE 'pendente' END AS status
  FROM customer, unnest(range(1, c_custkey % 3 + 2)) AS u(n))"""
SQL_PRODUCTS = f"""produtos AS (SELECT tipo_produto, 'Credito ' || {sql_initcap("tipo_produto")} AS nome_produto,
  CAST(length(tipo_produto) * 0.25 AS DECIMAL(5,2)) AS taxa_juros_mensal
  FROM (SELECT DISTINCT c_mktsegment AS tipo_produto FROM customer))"""
SQL_TARGETS = """metas AS (SELECT n_name AS cidade, CAST((n_nationkey + 1) * 1000000 AS DECIMAL(14,2)) AS meta_receita
  FROM nation WHERE n_nationkey % 7 <> 6)"""
SQL_TX = f"""transacoes AS (SELECT o_orderkey AS transacao_id, o_custkey AS cliente_id, o_custkey % 25 AS agencia_id,
  CAST(o_orderdate AS DATE) AS data_transacao, CAST(o_totalprice AS DECIMAL(12,2)) AS valor,
  ({CHANNELS})[CAST(o_orderkey % 6 + 1 AS INTEGER)] AS canal,
  CASE o_orderstatus WHEN 'F' THEN 'concluida' WHEN 'O' THEN 'pendente' ELSE 'cancelada' END AS status FROM orders)"""
SQL_BRANCHES = "agencias AS (SELECT n_nationkey AS agencia_id, n_name AS cidade FROM nation)"
SQL_FANOUT = """resumo AS (SELECT v.cidade, sum(valor_venda) AS receita_total, sum(valor_contratado) AS credito_total
  FROM vendas v JOIN contratos c ON v.cliente_id = c.cliente_id GROUP BY v.cidade)"""
SQL_MONTHLY = """mensal AS (SELECT cidade, date_trunc('month', data_transacao)::DATE AS mes, sum(valor) AS receita_mes,
  count(*) AS qtd FROM transacoes JOIN agencias USING (agencia_id) WHERE status = 'concluida' GROUP BY 1, 2)"""


def summary(spark, sf_dir) -> DataFrame:
    return joins.join_sum(
        sales(spark, sf_dir), contracts(spark, sf_dir), "cliente_id", "cidade", "valor_venda", "valor_contratado"
    )


def staged_completed(tx: DataFrame) -> DataFrame:
    """Completed transactions with a tidy channel and the first day of the month."""
    return tx.where(F.col("status") == "concluida").select(
        "transacao_id", "cliente_id", "agencia_id", "data_transacao",
        F.trunc("data_transacao", "MM").alias("mes"), "valor",
        F.initcap(F.lower("canal")).alias("canal"), "status",
    )


def enriched(tx: DataFrame, people: DataFrame, places: DataFrame) -> DataFrame:
    done = staged_completed(tx)
    return (
        done.join(people, "cliente_id")
        .join(places, "agencia_id")
        .select("transacao_id", "mes", "canal", "valor", F.col("nome").alias("cliente"), "cidade")
    )


def monthly_by_city(tx: DataFrame, places: DataFrame) -> DataFrame:
    """Completed revenue per city and month; summed per branch before the lookup."""
    per_branch = (
        tx.where(F.col("status") == "concluida")
        .groupBy("agencia_id", F.trunc("data_transacao", "MM").alias("mes"))
        .agg(F.sum("valor").alias("_v"), F.count(F.lit(1)).alias("_n"))
    )
    return (
        per_branch.join(places, "agencia_id")
        .groupBy("cidade", "mes")
        .agg(F.sum("_v").alias("receita_mes"), F.sum("_n").alias("qtd"))
    )


def join_fanout_sum(spark, sf_dir):
    return portable(summary(spark, sf_dir))


def join_preagg_sum(spark, sf_dir):
    return portable(
        joins.join_sum(
            sales(spark, sf_dir), contracts(spark, sf_dir), "cliente_id", "cidade",
            "valor_venda", "valor_contratado", fan_out=False,
        )
    )


def target_ratio(spark, sf_dir):
    done = joins.ratio_to_target(
        summary(spark, sf_dir), targets(spark, sf_dir), "cidade", "receita_total", "meta_receita"
    )
    return portable(done)


def agg_by_status(spark, sf_dir):
    c = contracts(spark, sf_dir)
    return portable(
        c.groupBy("status")
        .agg(F.count(F.lit(1)).alias("qtd_contratos"), F.sum("valor_contratado").alias("credito_total"))
        .orderBy(F.desc("credito_total"))
    )


def agg_avg_ticket(spark, sf_dir):
    s = sales(spark, sf_dir)
    return portable(
        s.groupBy("cidade").agg(
            round_to(ratio(F.sum("valor_venda"), F.count("valor_venda")), 2).alias("ticket_medio"),
            F.count(F.lit(1)).alias("qtd_vendas"),
        )
    )


def agg_by_catalogue(spark, sf_dir):
    return portable(
        joins.total_by_catalogue(
            contracts(spark, sf_dir), products(spark, sf_dir), "tipo_produto",
            ["nome_produto", "taxa_juros_mensal"], "valor_contratado",
        )
    )


def enrich_two_way(spark, sf_dir):
    return portable(sales(spark, sf_dir).join(clients(spark, sf_dir), "cliente_id").select("nome", "cidade", "valor_venda"))


def enrich_three_way(spark, sf_dir):
    return portable(enriched(transactions(spark, sf_dir), clients(spark, sf_dir), branches(spark, sf_dir)))


def agg_month_city(spark, sf_dir):
    return portable(monthly_by_city(transactions(spark, sf_dir), branches(spark, sf_dir)))


def window_running_total(spark, sf_dir):
    """Running total per city on top of a refreshed monthly snapshot."""
    monthly = materialize.refresh_snapshot(
        spark, "mv_receita_mensal_cidade", lambda s: monthly_by_city(transactions(s, sf_dir), branches(s, sf_dir))
    )
    return portable(
        windows.running_total(monthly.select("cidade", "mes", "receita_mes"), "cidade", "mes", "receita_mes", "receita_acumulada")
    )


def stg_completed(spark, sf_dir):
    view = materialize.live_view(staged_completed(transactions(spark, sf_dir)), "vendas_completas")
    return portable(view)


def view_global_enriched(spark, sf_dir):
    """Read through another session, which only a global view allows."""
    rows = enriched(transactions(spark, sf_dir), clients(spark, sf_dir), branches(spark, sf_dir))
    materialize.live_view(rows, "vendas_por_canal", scope="global")
    return portable(spark.newSession().table("global_temp.vendas_por_canal").groupBy("cidade", "canal").agg(
        F.sum("valor").alias("total"), F.count(F.lit(1)).alias("qtd")))


def view_live(spark, sf_dir):
    materialize.live_view(sales(spark, sf_dir), "compras")
    materialize.live_view(contracts(spark, sf_dir), "contratos")
    live = materialize.live_view(
        joins.join_sum(spark.table("compras"), spark.table("contratos"), "cliente_id", "cidade",
                       "valor_venda", "valor_contratado"), "vw_resumo_cidade")
    return portable(live)


def _late_rows(bronze: DataFrame) -> DataFrame:
    """A later delivery: corrections of one tenth of the transactions at half the amount."""
    return bronze.where(F.col("transacao_id") % 10 == 0).withColumn("valor", (F.col("valor") / 2).cast("decimal(12,2)"))


def _city_changes(rows: DataFrame, places: DataFrame) -> DataFrame:
    """What the view by city is summed from; ``rows`` carry a sign."""
    return rows.where(F.col("status") == "concluida").join(places, "agencia_id").select("cidade", "valor", maintain.SIGN)


def _snapshot_and_live(spark: SparkSession, sf_dir: str, refresh: bool) -> DataFrame:
    """The base table grows by deliveries; a refresh reads the deliveries it has not seen, nothing else."""
    bronze, places = scratch_path(spark, "bronze_transacoes"), branches(spark, sf_dir)
    write_replace(transactions(spark, sf_dir), f"{bronze}/entrega=1")
    kept = maintain.GroupedView(spark, scratch_path(spark, "mv_receita_cidade"), ["cidade"], {"receita": "valor"})

    def delivered(number: int) -> DataFrame:
        return maintain.inserted(spark.read.parquet(f"{bronze}/entrega={number}"))

    kept.refresh(_city_changes(delivered(1), places), 1)
    write_replace(_late_rows(transactions(spark, sf_dir)), f"{bronze}/entrega=2")
    if refresh:
        kept.refresh(_city_changes(delivered(2), places), 2)
    view = materialize.persistent_view(spark, "vw_transacoes", f"SELECT * FROM parquet.`{bronze}`")
    live = monthly_by_city(view, places).groupBy("cidade").agg(F.sum("receita_mes").alias("receita_viva"))
    return portable(
        live.join(kept.read(), "cidade").select(
            "cidade", "receita_viva", F.col("receita").alias("receita_materializada"),
            (F.col("receita_viva") == F.col("receita")).alias("igual"),
        )
    )


def mv_snapshot_vs_live(spark, sf_dir):
    """The live view sees a late delivery at once, the snapshot does not."""
    return _snapshot_and_live(spark, sf_dir, refresh=False)


def mv_refresh(spark, sf_dir):
    """After a refresh the snapshot equals the live view."""
    return _snapshot_and_live(spark, sf_dir, refresh=True)


def mv_refresh_deletes(spark, sf_dir):
    """A delivery that takes back every seventh transaction and adds late ones; one refresh for both."""
    kept = maintain.GroupedView(spark, scratch_path(spark, "mv_receita_cidade"), ["cidade"], {"receita": "valor"})
    rows, places = transactions(spark, sf_dir), branches(spark, sf_dir)
    kept.refresh(_city_changes(maintain.inserted(rows), places), 1)
    change = maintain.deleted(rows.where(F.col("transacao_id") % 7 == 0)).unionByName(maintain.inserted(_late_rows(rows)))
    kept.refresh(_city_changes(change, places), 2)
    return portable(kept.read(count="qtd"))


def mv_join_refresh(spark, sf_dir):
    """The summary by city over a join, refreshed from new sales, dropped sales and dropped contracts."""
    sold, agreed = sales(spark, sf_dir), contracts(spark, sf_dir)
    late, cancelled = F.col("venda_id") % 5 == 0, F.col("venda_id") % 11 == 0
    kept = maintain.JoinedView(spark, scratch_path(spark, "mv_resumo_cidade"), "cliente_id", "cidade", {"receita_total": "valor_venda"}, {"credito_total": "valor_contratado"})
    kept.refresh(1, maintain.inserted(sold.where(~late)), maintain.inserted(agreed))
    kept.refresh(2, maintain.inserted(sold.where(late)))
    kept.refresh(3, maintain.deleted(sold.where(cancelled)), maintain.deleted(agreed.where("status = 'recusado'")))
    return portable(kept.read())


def dim_customer_keys(spark, sf_dir):
    """Customer keys of two loads: the early buyers keep theirs when all customers follow."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("nome_cliente"))
    early = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit("1995-07-01").cast("timestamp")).select("o_custkey")
    kept = keys.KeyMap(spark, scratch_path(spark, "customer_keys"), ["nome_cliente"], "sk_cliente")
    kept.load(1, customers.join(early, F.col("c_custkey") == F.col("o_custkey"), "left_semi"))
    kept.load(2, customers)
    return kept.read()


QUERIES = {
    f.__name__: f
    for f in (
        join_fanout_sum, join_preagg_sum, target_ratio, agg_by_status, agg_avg_ticket, agg_by_catalogue,
        enrich_two_way, enrich_three_way, agg_month_city, window_running_total, stg_completed,
        view_global_enriched, view_live, mv_snapshot_vs_live, mv_refresh, mv_refresh_deletes, mv_join_refresh,
        dim_customer_keys,
    )
}

_ENRICHED = f"""SELECT transacao_id, date_trunc('month', data_transacao)::DATE AS mes, {sql_initcap("canal")} AS canal,
  valor, c_name AS cliente, cidade FROM transacoes JOIN customer ON cliente_id = c_custkey
  JOIN agencias USING (agencia_id) WHERE status = 'concluida'"""
_RESUMO = "SELECT cidade, CAST(receita_total AS DOUBLE) AS receita_total, CAST(credito_total AS DOUBLE) AS credito_total FROM resumo"
_OLD_NEW = f"""{SQL_TX}, {SQL_BRANCHES}, f AS (SELECT cidade, valor,
  CASE WHEN transacao_id % 10 = 0 THEN CAST(valor * 0.5 AS DECIMAL(12,2)) ELSE 0 END AS tarde
  FROM (SELECT *, NULL FROM transacoes) JOIN agencias USING (agencia_id) WHERE status = 'concluida'),
  t AS (SELECT cidade, sum(valor) AS velho, sum(valor) + sum(tarde) AS novo FROM f GROUP BY cidade)"""

ORACLE = {
    "join_fanout_sum": f"WITH {SQL_SALES}, {SQL_CONTRACTS}, {SQL_FANOUT} {_RESUMO}",
    "join_preagg_sum": f"""WITH {SQL_SALES}, {SQL_CONTRACTS},
        a AS (SELECT cliente_id, cidade, sum(valor_venda) AS v FROM vendas GROUP BY 1, 2),
        b AS (SELECT cliente_id, sum(valor_contratado) AS c FROM contratos GROUP BY 1)
        SELECT cidade, CAST(sum(v) AS DOUBLE) AS receita_total, CAST(sum(c) AS DOUBLE) AS credito_total
        FROM a JOIN b USING (cliente_id) GROUP BY cidade""",
    "target_ratio": f"""WITH {SQL_SALES}, {SQL_CONTRACTS}, {SQL_FANOUT}, {SQL_TARGETS}
        SELECT cidade, CAST(meta_receita AS DOUBLE) AS meta_receita, CAST(receita_total AS DOUBLE) AS receita_total,
        {sql_round("CAST(receita_total AS DOUBLE) / CAST(meta_receita AS DOUBLE) * 100", 1)} AS pct_meta
        FROM resumo JOIN metas USING (cidade)""",
    "agg_by_status": f"""WITH {SQL_CONTRACTS} SELECT status, count(*) AS qtd_contratos,
        CAST(sum(valor_contratado) AS DOUBLE) AS credito_total FROM contratos GROUP BY 1 ORDER BY 3 DESC""",
    "agg_avg_ticket": f"""WITH {SQL_SALES} SELECT cidade,
        {sql_round("CAST(sum(valor_venda) AS DOUBLE) / count(*)", 2)} AS ticket_medio, count(*) AS qtd_vendas
        FROM vendas GROUP BY cidade""",
    "agg_by_catalogue": f"""WITH {SQL_CONTRACTS}, {SQL_PRODUCTS} SELECT nome_produto,
        CAST(taxa_juros_mensal AS DOUBLE) AS taxa_juros_mensal, CAST(sum(valor_contratado) AS DOUBLE) AS total_contratado,
        count(*) AS qtd_contratos FROM contratos JOIN produtos USING (tipo_produto) GROUP BY nome_produto, taxa_juros_mensal""",
    "enrich_two_way": f"""WITH {SQL_SALES} SELECT c_name AS nome, cidade, CAST(valor_venda AS DOUBLE) AS valor_venda
        FROM vendas JOIN customer ON cliente_id = c_custkey""",
    "enrich_three_way": f"""WITH {SQL_TX}, {SQL_BRANCHES} SELECT * REPLACE (CAST(mes AS VARCHAR) AS mes,
        CAST(valor AS DOUBLE) AS valor) FROM ({_ENRICHED})""",
    "agg_month_city": f"""WITH {SQL_TX}, {SQL_BRANCHES}, {SQL_MONTHLY} SELECT cidade, CAST(mes AS VARCHAR) AS mes,
        CAST(receita_mes AS DOUBLE) AS receita_mes, qtd FROM mensal""",
    "window_running_total": f"""WITH {SQL_TX}, {SQL_BRANCHES}, {SQL_MONTHLY} SELECT cidade, CAST(mes AS VARCHAR) AS mes,
        CAST(receita_mes AS DOUBLE) AS receita_mes, CAST(sum(receita_mes) OVER (PARTITION BY cidade ORDER BY mes
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS receita_acumulada FROM mensal""",
    "stg_completed": f"""WITH {SQL_TX} SELECT transacao_id, cliente_id, agencia_id,
        CAST(data_transacao AS VARCHAR) AS data_transacao,
        CAST(date_trunc('month', data_transacao)::DATE AS VARCHAR) AS mes, CAST(valor AS DOUBLE) AS valor,
        {sql_initcap("canal")} AS canal, status FROM transacoes WHERE status = 'concluida'""",
    "view_global_enriched": f"""WITH {SQL_TX}, {SQL_BRANCHES}, e AS ({_ENRICHED})
        SELECT cidade, canal, CAST(sum(valor) AS DOUBLE) AS total, count(*) AS qtd FROM e GROUP BY 1, 2""",
    "view_live": f"WITH {SQL_SALES}, {SQL_CONTRACTS}, {SQL_FANOUT} {_RESUMO}",
    "mv_snapshot_vs_live": f"""WITH {_OLD_NEW} SELECT cidade, CAST(novo AS DOUBLE) AS receita_viva,
        CAST(velho AS DOUBLE) AS receita_materializada, novo = velho AS igual FROM t""",
    "mv_refresh_deletes": f"""WITH {SQL_TX}, {SQL_BRANCHES}, f AS (SELECT agencia_id, valor FROM transacoes
        WHERE status = 'concluida' AND transacao_id % 7 <> 0 UNION ALL SELECT agencia_id, CAST(valor * 0.5 AS DECIMAL(12,2))
        FROM transacoes WHERE status = 'concluida' AND transacao_id % 10 = 0)
        SELECT cidade, CAST(sum(valor) AS DOUBLE) AS receita, count(*) AS qtd FROM f JOIN agencias USING (agencia_id) GROUP BY cidade""",
    "mv_join_refresh": f"""WITH {SQL_SALES}, {SQL_CONTRACTS} SELECT v.cidade, CAST(sum(valor_venda) AS DOUBLE) AS receita_total,
        CAST(sum(valor_contratado) AS DOUBLE) AS credito_total FROM vendas v JOIN contratos c ON v.cliente_id = c.cliente_id
        WHERE venda_id % 11 <> 0 AND status <> 'recusado' GROUP BY v.cidade""",
    "mv_refresh": f"""WITH {_OLD_NEW} SELECT cidade, CAST(novo AS DOUBLE) AS receita_viva,
        CAST(novo AS DOUBLE) AS receita_materializada, true AS igual FROM t""",
    "dim_customer_keys": """WITH nomes AS (SELECT c_name AS nome_cliente, min(CASE WHEN c_custkey IN
          (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01') THEN 1 ELSE 2 END) AS carga
          FROM customer WHERE c_name IS NOT NULL GROUP BY 1)
        SELECT row_number() OVER (ORDER BY carga, nome_cliente) AS sk_cliente, nome_cliente FROM nomes""",
}
