"""Change feed and order stream: CDC in batch and streaming, expectations, gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc, quality
from ..operators.quality import Rule
from ..session import scratch_path
from ..sources.sinks import write_append, write_replace
from ..streaming import cdc as stream_cdc
from ..streaming import ingest
from .common import portable, table

KEYS = ["cliente_id"]
#: Rows in a bucket of the stored target: small, so that the test tables see it split.
TARGET_ROWS = 200


def _deleted():
    return F.col("operacao") == "D"


def feed(spark, sf_dir) -> DataFrame:
    """Customer changes: delete rows carry no payload, as change capture delivers them."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    dead = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("cliente_id"),
        F.when(~dead, F.col("event_type")).alias("nome"),
        F.when(~dead, F.col("value").cast("decimal(12,2)")).alias("valor"),
        op.alias("operacao"),
        F.col("event_id").alias("sequencia"),
    )


SQL_FEED = """feed AS (SELECT user_id AS cliente_id, CASE WHEN event_type <> 'error' THEN event_type END AS nome,
  CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(12,2)) END AS valor,
  CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS operacao,
  event_id AS sequencia FROM events)"""


def orders(spark, sf_dir) -> DataFrame:
    """Order lines with zero and negative quantities, zero prices and missing products."""
    k = F.col("l_orderkey")
    qty = F.when(k % 50 == 0, 0).when(k % 50 == 1, -1).otherwise(F.col("l_quantity").cast("int"))
    price = F.when(k % 53 == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice")).cast("decimal(12,2)")
    return table(spark, sf_dir, "lineitem").select(
        k.alias("id_pedido"),
        F.col("l_linenumber").alias("linha"),
        F.when(k % 59 != 0, F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("produto"),
        F.col("l_returnflag").alias("categoria"),
        qty.alias("quantidade"),
        price.alias("preco_unitario"),
        F.col("l_shipdate").cast("date").alias("data_pedido"),
    )


SQL_ORDERS = """pedidos AS (SELECT l_orderkey AS id_pedido, l_linenumber AS linha,
  CASE WHEN l_orderkey % 59 <> 0 THEN 'P' || l_partkey END AS produto, l_returnflag AS categoria,
  CASE WHEN l_orderkey % 50 = 0 THEN 0 WHEN l_orderkey % 50 = 1 THEN -1 ELSE CAST(l_quantity AS INTEGER) END AS quantidade,
  CAST(CASE WHEN l_orderkey % 53 = 0 THEN 0.0 ELSE l_extendedprice END AS DECIMAL(12,2)) AS preco_unitario,
  CAST(l_shipdate AS DATE) AS data_pedido FROM lineitem)"""
SQL_VALID = """validos AS (SELECT * FROM pedidos
  WHERE produto IS NOT NULL AND quantidade > 0 AND preco_unitario > 0)"""


def order_rules(action: str = "drop") -> list[Rule]:
    return [
        Rule("produto_valido", F.col("produto").isNotNull(), action),
        Rule("quantidade_valida", F.col("quantidade") > 0, action),
        Rule("preco_valido", F.col("preco_unitario") > 0, action),
    ]


def valid_orders(spark, sf_dir) -> DataFrame:
    return quality.expect_valid(orders(spark, sf_dir), order_rules())


def revenue_by_product(valid: DataFrame) -> DataFrame:
    return valid.groupBy("produto", "categoria").agg(
        F.sum("quantidade").alias("qtd_total"),
        F.sum(F.col("quantidade") * F.col("preco_unitario")).alias("receita_total"),
    )


def revenue_by_day(valid: DataFrame) -> DataFrame:
    return valid.groupBy("data_pedido").agg(
        F.sum(F.col("quantidade") * F.col("preco_unitario")).alias("receita_total")
    )


# --- batch ------------------------------------------------------------------


def cdc_scd1(spark, sf_dir):
    return portable(cdc.scd1(feed(spark, sf_dir), KEYS, "sequencia", _deleted(), ["operacao", "sequencia"]))


def cdc_scd2(spark, sf_dir):
    """Event ids are unique, so the feed meets ``unique_sequence``."""
    history = cdc.scd2(
        feed(spark, sf_dir), KEYS, "sequencia", _deleted(), ["operacao", "sequencia"], unique_sequence=True
    )
    return portable(history)


def cdc_out_of_order(spark, sf_dir):
    """The newer half is applied first; the older half arrives late and changes nothing it should not."""
    all_events = feed(spark, sf_dir)
    middle = all_events.agg(((F.min("sequencia") + F.max("sequencia")) / 2).alias("m")).scalar()
    state = cdc.latest_events(all_events.where(F.col("sequencia") > middle), KEYS, "sequencia", _deleted())
    late = all_events.where(F.col("sequencia") <= middle)
    merged = cdc.merge_scd1(state, late, KEYS, "sequencia", _deleted())
    return portable(merged.where(~_deleted()).drop("operacao", "sequencia"))


def expect_drop(spark, sf_dir):
    return portable(valid_orders(spark, sf_dir))


def expect_metrics(spark, sf_dir):
    return quality.rule_metrics(orders(spark, sf_dir), order_rules())


def expect_warn(spark, sf_dir):
    flagged = quality.flag_violations(orders(spark, sf_dir), order_rules("warn"))
    return portable(
        flagged.select("id_pedido", "linha", "produto", "quantidade", "preco_unitario",
                       F.concat_ws(",", "violations").alias("violacoes"))
    )


def expect_fail_gate(spark, sf_dir):
    return quality.gate(orders(spark, sf_dir), order_rules("fail"))


def gold_revenue_by_product(spark, sf_dir):
    return portable(revenue_by_product(valid_orders(spark, sf_dir)))


def gold_revenue_by_day(spark, sf_dir):
    return portable(revenue_by_day(valid_orders(spark, sf_dir)))


# --- streaming --------------------------------------------------------------


def _land(df: DataFrame, name: str, by: str) -> tuple[str, int]:
    """Write a feed as landing files, newest first so order must not matter; (folder, files per batch).

    The files follow the feed's own size: as many ranges as the shuffle makes of it. A
    micro-batch takes a quarter of them.
    """
    path = scratch_path(df.sparkSession, name)
    df.repartitionByRange(F.desc(by)).write.parquet(path)
    landed = df.sparkSession.read.schema(df.schema).parquet(path).select(F.col("_metadata.file_path")).distinct().count()
    return path, max(1, -(-landed // 4))


def stream_ingest(spark, sf_dir):
    """Two deliveries, two runs over one checkpoint: the second run reads only the second delivery."""
    rows = feed(spark, sf_dir)
    landing, target, checkpoint = (scratch_path(spark, n) for n in ("landing", "bronze", "offsets"))
    for part in (F.col("cliente_id") % 2 == 0, F.col("cliente_id") % 2 == 1):
        write_append(rows.where(part), landing)
        ingest.run_ingest(ingest.open_stream(spark, landing, rows.schema), target, checkpoint)
    return portable(spark.read.parquet(target))


def _ingested_orders(spark, sf_dir) -> tuple[DataFrame, str]:
    rows = orders(spark, sf_dir)
    landing, per_batch = _land(rows, "orders", "data_pedido")
    target, metrics, checkpoint = (scratch_path(spark, n) for n in ("silver", "metrics", "offsets"))
    stream = ingest.open_stream(spark, landing, rows.schema, files_per_batch=per_batch)
    ingest.run_expectations(stream, order_rules(), target, metrics, checkpoint)
    return spark.read.parquet(target).drop("batch_id"), metrics


def stream_expect_drop(spark, sf_dir):
    return portable(_ingested_orders(spark, sf_dir)[0])


def stream_expect_metrics(spark, sf_dir):
    return ingest.total_metrics(spark, _ingested_orders(spark, sf_dir)[1])


def stream_gold_by_product(spark, sf_dir):
    """Recomputed aggregate over the table a stream has filled."""
    return portable(revenue_by_product(_ingested_orders(spark, sf_dir)[0]))


def _stream_cdc(spark: SparkSession, sf_dir: str, scd_type: int, runs: int = 1) -> DataFrame:
    rows = feed(spark, sf_dir)
    landing, per_batch = _land(rows, "feed", "sequencia")
    flow = stream_cdc.Flow(KEYS, "sequencia", _deleted(), scd_type, ["operacao", "sequencia"])
    for _ in range(runs):  # a full refresh is a new target and a new checkpoint over the same input
        target, checkpoint = scratch_path(spark, "target"), scratch_path(spark, "offsets")
        stream_cdc.run_cdc(ingest.open_stream(spark, landing, rows.schema, files_per_batch=per_batch), flow, target, checkpoint, most=TARGET_ROWS)
    return portable(stream_cdc.read_target(spark, flow, target))


def stream_cdc_scd1(spark, sf_dir):
    return _stream_cdc(spark, sf_dir, 1)


def stream_cdc_scd2(spark, sf_dir):
    return _stream_cdc(spark, sf_dir, 2)


def stream_full_refresh(spark, sf_dir):
    return _stream_cdc(spark, sf_dir, 1, runs=2)


# --- sinks ------------------------------------------------------------------


def sink_overwrite_roundtrip(spark, sf_dir):
    """The second write replaces rows and schema of the first."""
    path = scratch_path(spark, "replace")
    write_replace(feed(spark, sf_dir), path)
    by_day = revenue_by_day(valid_orders(spark, sf_dir)).withColumn("ano", F.year("data_pedido"))
    write_replace(by_day, path, ["ano"])
    return portable(spark.read.parquet(path).drop("ano"))


def sink_append_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "append")
    for op in ("I", "U", "D"):
        write_append(feed(spark, sf_dir).where(F.col("operacao") == op), path)
    return portable(spark.read.parquet(path))


QUERIES = {
    f.__name__: f
    for f in (
        cdc_scd1, cdc_scd2, cdc_out_of_order, expect_drop, expect_metrics, expect_warn, expect_fail_gate,
        gold_revenue_by_product, gold_revenue_by_day, stream_ingest, stream_expect_drop,
        stream_expect_metrics, stream_gold_by_product, stream_cdc_scd1, stream_cdc_scd2,
        stream_full_refresh, sink_overwrite_roundtrip, sink_append_roundtrip,
    )
}

_SCD1 = f"""WITH {SQL_FEED} SELECT cliente_id, nome, CAST(valor AS DOUBLE) AS valor FROM (
  SELECT *, row_number() OVER (PARTITION BY cliente_id ORDER BY sequencia DESC) AS rn FROM feed)
  WHERE rn = 1 AND operacao <> 'D'"""
_SCD2 = f"""WITH {SQL_FEED} SELECT cliente_id, nome, CAST(valor AS DOUBLE) AS valor, sequencia AS "__START_AT",
  proximo AS "__END_AT" FROM (
  SELECT *, lead(sequencia) OVER (PARTITION BY cliente_id ORDER BY sequencia) AS proximo FROM feed)
  WHERE operacao <> 'D'"""
_VALID = f"""WITH {SQL_ORDERS}, {SQL_VALID} SELECT * REPLACE (CAST(preco_unitario AS DOUBLE) AS preco_unitario,
  CAST(data_pedido AS VARCHAR) AS data_pedido) FROM validos"""
_METRICS = f"""WITH {SQL_ORDERS}, m AS (SELECT count(*) AS n, count(*) FILTER (produto IS NOT NULL) AS a,
  count(*) FILTER (quantidade > 0) AS b, count(*) FILTER (preco_unitario > 0) AS c FROM pedidos)
  SELECT rule, 'drop' AS action, n AS checked, ok AS passed, n - ok AS failed FROM (
  SELECT 'produto_valido' AS rule, n, a AS ok FROM m UNION ALL SELECT 'quantidade_valida', n, b FROM m
  UNION ALL SELECT 'preco_valido', n, c FROM m)"""
_BY_PRODUCT = f"""WITH {SQL_ORDERS}, {SQL_VALID} SELECT produto, categoria, CAST(sum(quantidade) AS BIGINT) AS qtd_total,
  CAST(sum(quantidade * preco_unitario) AS DOUBLE) AS receita_total FROM validos GROUP BY 1, 2"""
_BY_DAY = f"""WITH {SQL_ORDERS}, {SQL_VALID} SELECT CAST(data_pedido AS VARCHAR) AS data_pedido,
  CAST(sum(quantidade * preco_unitario) AS DOUBLE) AS receita_total FROM validos GROUP BY data_pedido"""
_FEED = f"WITH {SQL_FEED} SELECT * REPLACE (CAST(valor AS DOUBLE) AS valor) FROM feed"

ORACLE = {
    "cdc_scd1": _SCD1,
    "cdc_scd2": _SCD2,
    "cdc_out_of_order": _SCD1,
    "expect_drop": _VALID,
    "expect_metrics": _METRICS,
    "expect_warn": f"""WITH {SQL_ORDERS} SELECT id_pedido, linha, produto, quantidade,
        CAST(preco_unitario AS DOUBLE) AS preco_unitario, concat_ws(',',
          CASE WHEN produto IS NULL THEN 'produto_valido' END, CASE WHEN quantidade <= 0 THEN 'quantidade_valida' END,
          CASE WHEN preco_unitario <= 0 THEN 'preco_valido' END) AS violacoes FROM pedidos""",
    "expect_fail_gate": f"""WITH {SQL_ORDERS} SELECT n AS violating_rows, n = 0 AS publish FROM (SELECT count(*) AS n
        FROM pedidos WHERE produto IS NULL OR quantidade <= 0 OR preco_unitario <= 0)""",
    "gold_revenue_by_product": _BY_PRODUCT,
    "gold_revenue_by_day": _BY_DAY,
    "stream_ingest": _FEED,
    "stream_expect_drop": _VALID,
    "stream_expect_metrics": _METRICS,
    "stream_gold_by_product": _BY_PRODUCT,
    "stream_cdc_scd1": _SCD1,
    "stream_cdc_scd2": _SCD2,
    "stream_full_refresh": _SCD1,
    "sink_overwrite_roundtrip": _BY_DAY,
    "sink_append_roundtrip": _FEED,
}
