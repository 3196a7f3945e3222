"""Sources and sinks over files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile
from ..operators.clean import LEDGER_COLUMNS
from ..session import scratch_path
from ..sources import arrays, readers
from .common import portable, table
from .ledger import SQL_BRONZE, bronze_ledger
from .matching import JSON_SCHEMA, SQL_XREF, registry_b

LOAD_TIME = "2026-01-31 06:00:00"
# objects of one array file: a few megabytes, so a billion rows make some ten thousand files
JSON_OBJECTS = 50_000


def src_csv_raw(spark, sf_dir):
    """The messy ledger written as CSV and scanned back as text."""
    path = scratch_path(spark, "csv")
    bronze_ledger(spark, sf_dir).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return readers.read_raw_csv(spark, path, LEDGER_COLUMNS, rescue=None)


def src_rescue(spark, sf_dir):
    """Records with a surplus field keep their whole text in the rescue column."""
    k = F.col("o_orderkey")
    extra = F.when(k % 11 == 0, F.lit(",sobra")).otherwise(F.lit(""))
    line = F.concat(F.concat_ws(",", k.cast("string"), "o_orderstatus", "o_orderpriority"), extra)
    path = scratch_path(spark, "rescue")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return readers.read_raw_csv(spark, path, ["id", "status", "prioridade"], header=False)


def src_json(spark, sf_dir):
    """A registry written as JSON array files of bounded size and scanned back."""
    path = scratch_path(spark, "json")
    part = F.floor(F.col("customer_id") / JSON_OBJECTS)
    item = F.struct("nome", "email", "phone", "address")
    files = registry_b(spark, sf_dir).groupBy(part.alias("parte")).agg(F.to_json(F.collect_list(item)).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return arrays.read_json_array(spark, path, JSON_SCHEMA, ["nome", "email", "phone", "address"])


def src_cast_raw(spark, sf_dir):
    return readers.as_text(table(spark, sf_dir, "customer"))


def src_provenance(spark, sf_dir):
    rows = readers.with_provenance(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"), F.lit(LOAD_TIME).cast("timestamp"), full_path=False
    )
    return portable(rows)


def src_snapshot(spark, sf_dir):
    """An external table copied into bronze and read from the copy."""
    return readers.snapshot_ingest(table(spark, sf_dir, "customer"), scratch_path(spark, "bronze_clientes"))


def src_values(spark, sf_dir):
    """A literal lookup of delivery promises joined to every order."""
    promises = readers.inline(
        spark,
        [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 4), ("4-NOT SPECIFIED", 7), ("5-LOW", 10)],
        "o_orderpriority string, dias long",
    )
    counted = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("pedidos"))
    return counted.join(promises, "o_orderpriority").select(
        F.col("o_orderpriority").alias("prioridade"), "dias", "pedidos", (F.col("dias") * F.col("pedidos")).alias("dias_total")
    )


def src_file_inventory(spark, sf_dir):
    return readers.file_inventory(spark, sf_dir).select(
        F.substring_index("path", "/", -1).alias("arquivo"), F.col("length").alias("tamanho")
    )


def profile_schema(spark, sf_dir):
    return profile.schema_table(table(spark, sf_dir, "lineitem"))


def topk_total_order(spark, sf_dir):
    """A repeatable peek: without a unique tie-break the rows shown would vary."""
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice", "o_orderstatus")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(20)
    )


QUERIES = {
    f.__name__: f
    for f in (
        src_csv_raw, src_rescue, src_json, src_cast_raw, src_provenance, src_snapshot, src_values,
        src_file_inventory, profile_schema, topk_total_order,
    )
}

ORACLE = {
    "src_csv_raw": f"WITH {SQL_BRONZE} SELECT * FROM bronze",
    "src_rescue": """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_orderpriority AS prioridade,
        CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',sobra' END AS _rescued
        FROM orders""",
    "src_json": f"WITH {SQL_XREF} SELECT nome, email, phone, address FROM rb",
    "src_cast_raw": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
        CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    "src_provenance": f"""SELECT c_custkey, c_name, 'customer.parquet' AS _arquivo_origem, '{LOAD_TIME}' AS _carregado_em FROM customer""",
    "src_snapshot": "SELECT * FROM customer",
    "src_values": """SELECT o_orderpriority AS prioridade, dias, count(*) AS pedidos, dias * count(*) AS dias_total
        FROM orders JOIN (VALUES ('1-URGENT', 1::BIGINT), ('2-HIGH', 2), ('3-MEDIUM', 4), ('4-NOT SPECIFIED', 7), ('5-LOW', 10)) v(p, dias)
        ON o_orderpriority = p GROUP BY 1, 2""",
    "profile_schema": """SELECT ordinal_position - 1 AS posicao, column_name AS coluna, CASE data_type WHEN 'BIGINT' THEN 'bigint'
        WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
        ELSE data_type END AS tipo FROM information_schema.columns WHERE table_name = 'lineitem'""",
    "topk_total_order": """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
}
