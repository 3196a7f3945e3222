"""Two dirty customer registries derived from the customer table, and their matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_to
from ..operators import matching
from ..session import stage
from .common import sql_initcap, sql_round, table

# How hexadecimal digits are spelled as letters and as numbers.
HEX, LETTERS = "0123456789abcdef", "aeiouablmnrstdcv"
HEX_ALPHA, NUMBERS = "abcdef", "012345"
DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "empresa.com"]
# Labels of the two sources.
SOURCE_A, SOURCE_B = "bronze_customer_postgresql", "bronze_customer_json"
# schema of the second registry's files
JSON_SCHEMA = "nome string, email string, phone string, address string"


def _people(spark, sf_dir) -> DataFrame:
    """Name, contact and street of a person, spelled from a hash of the customer key."""
    k = F.col("c_custkey")
    h = F.md5(F.concat(F.lit("n"), k.cast("string")))

    def letters(start: int, size: int):
        return F.translate(F.substring("h", start, size), HEX, LETTERS)

    return table(spark, sf_dir, "customer").select("c_custkey").select(k.alias("k"), h.alias("h")).select(
        "k", "h",
        letters(1, 6).alias("first"),
        letters(7, 8).alias("last"),
        F.translate(F.substring("h", 15, 11), HEX_ALPHA, NUMBERS).alias("phone"),
        letters(26, 6).alias("street"),
        F.element_at(F.array(*map(F.lit, DOMAINS)), (F.col("k") % 5 + 1).cast("int")).alias("domain"),
    )


def registry_a(spark, sf_dir) -> DataFrame:
    k = F.col("k")
    mail = F.concat("first", F.lit("."), "last", F.lit("@"), "domain")
    return _people(spark, sf_dir).select(
        k.alias("customer_id"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), F.upper("first"))).otherwise(F.col("first")).alias("first_name"),
        F.when(k % 3 == 1, F.concat(F.upper("last"), F.lit(" "))).otherwise(F.col("last")).alias("last_name"),
        F.when(k % 10 == 1, F.replace(mail, F.lit("."), F.lit(". "))).otherwise(mail).alias("email"),
        F.when(k % 13 == 0, F.lit("000")).otherwise(F.col("phone")).alias("phone"),
        F.concat(F.lit("Rua "), "street", F.lit(", "), (k % 900 + 1).cast("string")).alias("address"),
    )


def registry_b(spark, sf_dir) -> DataFrame:
    """The same people with dropped or changed letters, short surnames, new contacts."""
    k = F.col("k")
    first = F.when(k % 6 == 1, F.concat(F.substring("first", 1, 2), F.substring("first", 4, 9))).when(
        k % 6 == 2, F.concat(F.lit("k"), F.substring("first", 2, 9))
    ).when(k % 6 == 4, F.reverse("first")).otherwise(F.col("first"))
    last = F.when(k % 6 == 3, F.concat(F.substring("last", 1, 1), F.lit("."))).when(
        k % 6 == 4, F.reverse("last")
    ).otherwise(F.col("last"))
    user = F.concat("first", F.when(k % 5 == 1, F.lit("_")).otherwise(F.lit(".")), "last", F.when(k % 5 == 2, F.lit("2")).otherwise(F.lit("")))
    domain = F.when(k % 5 == 3, F.lit("outro.org")).otherwise(F.col("domain"))
    plain = F.concat(F.lit("("), F.substring("phone", 1, 2), F.lit(") "), F.substring("phone", 3, 9))
    street = F.concat(F.lit("rua "), "street", F.lit(", "), (k % 900 + 1).cast("string"))
    return _people(spark, sf_dir).select(
        k.alias("customer_id"),
        F.concat(first, F.lit(" "), last).alias("nome"),
        F.concat(user, F.lit("@"), domain).alias("email"),
        F.when(k % 13 == 0, F.lit("000")).when(k % 4 < 2, plain).otherwise(F.reverse("phone")).alias("phone"),
        F.when(k % 7 < 5, F.concat(street, F.lit(" - mg")))
        .otherwise(F.concat(F.lit("Avenida "), F.reverse("street"), F.lit(", "), (k % 77).cast("string")))
        .alias("address"),
    )


SQL_PEOPLE = f"""h0 AS (SELECT c_custkey AS k, md5('n' || c_custkey) AS h FROM customer),
people AS (SELECT k, translate(substr(h, 1, 6), '{HEX}', '{LETTERS}') AS first, translate(substr(h, 7, 8), '{HEX}', '{LETTERS}') AS last,
  translate(substr(h, 15, 11), '{HEX_ALPHA}', '{NUMBERS}') AS phone, translate(substr(h, 26, 6), '{HEX}', '{LETTERS}') AS street,
  ({DOMAINS})[CAST(k % 5 + 1 AS INTEGER)] AS domain FROM h0)"""
_FULL_A = f"{sql_initcap('trim(first_name)')} || ' ' || {sql_initcap('trim(last_name)')}"
_CONTACT = "lower(replace(trim(email), ' ', '')) AS email, regexp_replace(phone, '[^0-9]', '', 'g') AS phone, lower(trim(address)) AS endereco"
SQL_XREF = f"""{SQL_PEOPLE},
ra AS (SELECT k AS customer_id, CASE WHEN k % 3 = 0 THEN ' ' || upper(first) ELSE first END AS first_name,
  CASE WHEN k % 3 = 1 THEN upper(last) || ' ' ELSE last END AS last_name,
  CASE WHEN k % 10 = 1 THEN replace(first || '.' || last || '@' || domain, '.', '. ') ELSE first || '.' || last || '@' || domain END AS email,
  CASE WHEN k % 13 = 0 THEN '000' ELSE phone END AS phone, 'Rua ' || street || ', ' || (k % 900 + 1) AS address FROM people),
rb AS (SELECT CASE k % 6 WHEN 1 THEN substr(first, 1, 2) || substr(first, 4) WHEN 2 THEN 'k' || substr(first, 2)
    WHEN 4 THEN reverse(first) ELSE first END || ' ' ||
    CASE k % 6 WHEN 3 THEN substr(last, 1, 1) || '.' WHEN 4 THEN reverse(last) ELSE last END AS nome,
  first || CASE WHEN k % 5 = 1 THEN '_' ELSE '.' END || last || CASE WHEN k % 5 = 2 THEN '2' ELSE '' END || '@' ||
    CASE WHEN k % 5 = 3 THEN 'outro.org' ELSE domain END AS email,
  CASE WHEN k % 13 = 0 THEN '000' WHEN k % 4 < 2 THEN '(' || substr(phone, 1, 2) || ') ' || substr(phone, 3) ELSE reverse(phone) END AS phone,
  CASE WHEN k % 7 < 5 THEN 'rua ' || street || ', ' || (k % 900 + 1) || ' - mg'
    ELSE 'Avenida ' || reverse(street) || ', ' || (k % 77) END AS address FROM people),
xa AS (SELECT '{SOURCE_A}' AS source_name, concat('PG-', customer_id) AS registro_id, {_FULL_A} AS full_name, {_CONTACT} FROM ra),
xb AS (SELECT '{SOURCE_B}' AS source_name, concat('JS-', row_number() OVER (ORDER BY nome, email, phone, address)) AS registro_id,
  {sql_initcap("trim(nome)")} AS full_name, {_CONTACT} FROM rb)"""


def _tri(x: str) -> str:
    return f"CASE WHEN length({x}) > 0 THEN list_distinct(list_transform(range(1, length({x}) + 1), lambda i: substr('  ' || {x}, i, 3))) END"


_USER = "regexp_replace(split_part(email, '@', 1), '[^a-z0-9]', '', 'g') || CASE WHEN contains(email, '@') THEN '@' || string_split(email, '@')[-1] ELSE '' END"
SQL_TOKENS = "".join(
    f""",
t{s} AS (SELECT *, {_tri("lower(full_name)")} AS tn, {_tri(f"({_USER})")} AS te, {_tri("endereco")} AS ta,
  regexp_replace(email, '[^0-9]', '', 'g') AS de, regexp_replace(endereco, '[^0-9]', '', 'g') AS da FROM x{s})"""
    for s in "ab"
)


def _sim(x: str, y: str) -> str:
    common = f"len(list_intersect({x}, {y}))"
    return f"({common}::DOUBLE / (len({x}) + len({y}) - {common}))"


def registries(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Both registries in one shape; staged because three rules read them."""
    a = matching.harmonise_split_names(registry_a(spark, sf_dir), SOURCE_A, "PG-")
    b = matching.harmonise_full_names(registry_b(spark, sf_dir), SOURCE_B, "JS-")
    return stage(a, "registry_a"), stage(b, "registry_b")


def match_xref(spark, sf_dir):
    a, b = registries(spark, sf_dir)
    return a.unionByName(b)


def match_pairs(spark, sf_dir):
    """Verified value pairs of every rule with their similarities and record counts."""
    a, b = registries(spark, sf_dir)
    out = None
    for rule in matching.FIELDS:
        rows = matching.matching_values(a, b, rule).select(
            F.col("regra").cast("bigint").alias("regra"),
            F.col("full_name_a").alias("nome_pg"), F.col("valor_a").alias("valor_pg"),
            F.col("full_name_b").alias("nome_js"), F.col("valor_b").alias("valor_js"),
            round_to(F.col("sim_nome"), 3).alias("sim_nome"), round_to(F.col("sim_valor"), 3).alias("sim_valor"),
            F.col("registros_a").alias("registros_pg"), F.col("registros_b").alias("registros_js"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def match_blocked_pairs(spark, sf_dir):
    """Matches found through the blocking keys, per rule."""
    return match_pairs(spark, sf_dir).groupBy("regra").agg(
        F.count(F.lit(1)).alias("pares"), F.count_distinct("nome_js", "valor_js").alias("valores_js")
    )


def _cascaded(spark, sf_dir) -> DataFrame:
    return matching.cascade(matching.signals(*registries(spark, sf_dir)))


def match_signals(spark, sf_dir):
    return _cascaded(spark, sf_dir).select(
        "id_pg", "id_js",
        *[round_to(F.col(c), 3).alias(c) for c in ("sim_nome", "sim_edicao_nome", "sim_email", "sim_endereco")],
        "telefone_igual", "nome_ok", "email_ok", "endereco_ok",
    )


def match_cascade(spark, sf_dir):
    return _cascaded(spark, sf_dir).select(
        "source_pg", "id_pg", "nome_pg", "source_js", "id_js", "nome_js", "email_pg", "email_js",
        F.col("regra_match").cast("bigint").alias("regra_match"),
    )


def match_best(spark, sf_dir):
    # only what is ranked or returned moves to its record
    ranked = _cascaded(spark, sf_dir).select("id_js", "nome_js", "id_pg", "nome_pg", "sim_nome", "regra_match")
    return matching.best_match(ranked).select("id_js", "nome_js", "id_pg", "nome_pg", F.col("regra_match").cast("bigint").alias("regra_match"))


QUERIES = {
    f.__name__: f
    for f in (match_xref, match_pairs, match_blocked_pairs, match_signals, match_cascade, match_best)
}

_V = "SELECT full_name, {f} AS v, tn, {extra}, min(registro_id) AS id, count(*) AS n FROM t{s} WHERE full_name IS NOT NULL AND {f} IS NOT NULL GROUP BY ALL"


def _sql_rule(rule: int, field: str, extra: str, on: str, sim: str) -> str:
    a, b = (_V.format(f=field, extra=extra, s=s) for s in "ab")
    return f"""SELECT {rule} AS regra, a.full_name AS nome_pg, a.v AS valor_pg, b.full_name AS nome_js, b.v AS valor_js,
      {_sim("a.tn", "b.tn")} AS sn, {sim} AS sv, a.n AS registros_pg, b.n AS registros_js, a.id AS id_pg
      FROM ({a}) a JOIN ({b}) b ON {on} WHERE {_sim("a.tn", "b.tn")} >= 0.6 AND {sim} >= 0.6"""


_PAIRS = " UNION ALL ".join(
    (
        _sql_rule(1, "email", "te, de", "a.de = b.de", _sim("a.te", "b.te")),
        _sql_rule(2, "phone", "1 AS one", "a.v = b.v", "1.0::DOUBLE"),
        _sql_rule(3, "endereco", "ta, da", "a.da = b.da", _sim("a.ta", "b.ta")),
    )
)
_SQL_BEST_PER_RULE = f"""pairs AS MATERIALIZED ({_PAIRS}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY regra, nome_js, valor_js ORDER BY sn DESC, id_pg) AS rn FROM pairs) WHERE rn = 1),
linked AS (SELECT DISTINCT b.registro_id AS id_js, best.id_pg FROM tb b LEFT JOIN best ON b.full_name = best.nome_js
  AND CASE regra WHEN 1 THEN b.email WHEN 2 THEN b.phone ELSE b.endereco END = best.valor_js),
sig0 AS (SELECT l.id_js, l.id_pg, a.source_name AS source_pg, b.source_name AS source_js, a.full_name AS nome_pg, b.full_name AS nome_js,
  a.email AS email_pg, b.email AS email_js, {_sim("a.tn", "b.tn")} AS sim_nome,
  1.0::DOUBLE - levenshtein(lower(a.full_name), lower(b.full_name)) / greatest(length(a.full_name), length(b.full_name))::DOUBLE AS sim_edicao_nome,
  CASE WHEN a.de = b.de THEN coalesce({_sim("a.te", "b.te")}, 0) ELSE 0 END AS sim_email,
  CASE WHEN a.da = b.da THEN coalesce({_sim("a.ta", "b.ta")}, 0) ELSE 0 END AS sim_endereco,
  coalesce(a.phone = b.phone, false) AS telefone_igual
  FROM linked l LEFT JOIN ta a ON l.id_pg = a.registro_id JOIN tb b ON l.id_js = b.registro_id),
sig AS (SELECT *, sim_nome >= 0.6 AS nome_ok, sim_email >= 0.6 AS email_ok, sim_endereco >= 0.6 AS endereco_ok FROM sig0),
casc AS (SELECT *, CASE WHEN nome_ok AND email_ok THEN 1 WHEN nome_ok AND telefone_igual THEN 2
  WHEN nome_ok AND endereco_ok THEN 3 END AS regra_match FROM sig)"""
_CASC = f"WITH {SQL_XREF}{SQL_TOKENS}, {_SQL_BEST_PER_RULE}"
# the best match straight from the definition, over every pair of records that shares
# what its rule demands exactly: the digits, the phone, or the address digits
_ALL_PAIRS_BEST = f"""WITH {SQL_XREF}{SQL_TOKENS}, pairs AS (
    SELECT 1 AS regra_match, a.registro_id AS id_pg, b.registro_id AS id_js, {_sim("a.tn", "b.tn")} AS sn
    FROM ta a JOIN tb b ON a.de = b.de WHERE {_sim("a.tn", "b.tn")} >= 0.6 AND {_sim("a.te", "b.te")} >= 0.6
    UNION ALL SELECT 2, a.registro_id, b.registro_id, {_sim("a.tn", "b.tn")}
    FROM ta a JOIN tb b ON a.phone = b.phone WHERE {_sim("a.tn", "b.tn")} >= 0.6
    UNION ALL SELECT 3, a.registro_id, b.registro_id, {_sim("a.tn", "b.tn")}
    FROM ta a JOIN tb b ON a.da = b.da WHERE {_sim("a.tn", "b.tn")} >= 0.6 AND {_sim("a.ta", "b.ta")} >= 0.6),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_js ORDER BY regra_match, sn DESC, id_pg) AS rn FROM pairs) WHERE rn = 1)
  SELECT id_js, b.full_name AS nome_js, id_pg, a.full_name AS nome_pg, regra_match
  FROM best JOIN ta a ON id_pg = a.registro_id JOIN tb b ON id_js = b.registro_id"""

ORACLE = {
    "match_xref": f"WITH {SQL_XREF} SELECT * FROM xa UNION ALL SELECT * FROM xb",
    "match_pairs": f"""WITH {SQL_XREF}{SQL_TOKENS} SELECT regra, nome_pg, valor_pg, nome_js, valor_js,
        {sql_round("sn", 3)} AS sim_nome, {sql_round("sv", 3)} AS sim_valor, registros_pg, registros_js FROM ({_PAIRS})""",
    "match_blocked_pairs": f"""WITH {SQL_XREF}{SQL_TOKENS} SELECT regra, count(*) AS pares,
        count(DISTINCT (nome_js, valor_js)) AS valores_js FROM ({_PAIRS}) GROUP BY regra""",
    "match_signals": f"""{_CASC} SELECT id_pg, id_js, {sql_round("sim_nome", 3)} AS sim_nome,
        {sql_round("sim_edicao_nome", 3)} AS sim_edicao_nome, {sql_round("sim_email", 3)} AS sim_email,
        {sql_round("sim_endereco", 3)} AS sim_endereco, telefone_igual, nome_ok, email_ok, endereco_ok FROM casc""",
    "match_cascade": f"""{_CASC} SELECT source_pg, id_pg, nome_pg, source_js, id_js, nome_js, email_pg, email_js,
        regra_match FROM casc""",
    "match_best": _ALL_PAIRS_BEST,
}
