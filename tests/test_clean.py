from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from silverlode.functions.text import compact_email, digits, fold, money, multi_date, recode, tidy, title
from silverlode.operators import clean

LEDGER = "id_lancamento string, data_lancamento string, centro_custo string, categoria string, valor string, tipo string, descricao string"
RAW = [
    (" A1 ", "2025-03-01", "rh", "SOFTWARE", "R$ 1,234.50", "Despesa", "  licenca   anual "),
    ("A2", "15/03/2025", "OPERAÇÕES ", "Prestação de Serviços", "  2,000.00 ", "receita", "PROJETO"),
    ("A2", "15/03/2025", "OPERAÇÕES ", "Prestação de Serviços", "  2,000.00 ", "receita", "PROJETO"),
    ("A3", None, "ti", "cloud", "R$10.00", "DESPESA", "x"),
    ("A4", "2025-04-01", "ti", "cloud", None, "DESPESA", "x"),
    ("A5", "2025-04-02", "ti", " ", "7.5", "despesa", "x"),
    ("A6", "31/31/2025", "ti", "infra", "1", "despesa", "x"),
    ("A7", "2025-04-03", "ti", "desconhecida", "", "outro", "x"),
]


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


def test_text_functions(spark):
    assert one(spark, "AÇÃO É", fold) == "acao e"
    assert one(spark, "  a \t b\n c ", tidy) == "a b c"
    assert one(spark, " tI  ops ", title) == "Ti  Ops"
    assert one(spark, "(34) 9-1", digits) == "3491"
    assert one(spark, " Ana@Gmail. Com ", compact_email) == "ana@gmail.com"
    assert one(spark, None, title) is None


def test_money(spark):
    assert one(spark, "R$ 6,273.32", money) == Decimal("6273.32")
    assert one(spark, "-5.00", money) == Decimal("5.00")
    assert one(spark, "-5.00", lambda c: money(c, keep_sign=True)) == Decimal("-5.00")
    assert one(spark, "R$ 1.234,56", lambda c: money(c, decimal_comma=True)) == Decimal("1234.56")
    assert one(spark, "", money) is None
    assert one(spark, "abc", money) is None
    assert one(spark, "1.2.3", money) is None
    assert one(spark, None, money) is None


def test_multi_date(spark):
    both = lambda c: multi_date(c, clean.DATE_FORMATS)
    assert one(spark, "2025-02-03", both) == date(2025, 2, 3)
    assert one(spark, "03/02/2025", both) == date(2025, 2, 3)
    assert one(spark, "2025-13-40", both) is None
    assert one(spark, "x", lambda c: multi_date(c, clean.DATE_FORMATS, "1900-01-01")) == date(1900, 1, 1)


def test_recode(spark):
    by = lambda c: recode(c, clean.CATEGORY_LABELS, clean.NO_CATEGORY)
    assert one(spark, " LICENÇAS ", by) == "Software"
    assert one(spark, " ", by) == "Sem Categoria"
    assert one(spark, None, by) == "Sem Categoria"
    assert len(clean.CATEGORY_LABELS) == 30


def test_silver_ledger(spark, rows):
    bronze = spark.createDataFrame(RAW, LEDGER)
    silver = clean.silver_ledger(bronze)
    got = rows(silver, "id_lancamento", "data_lancamento", "centro_custo", "categoria", "valor", "tipo", "descricao")
    assert got == [
        ("A1", date(2025, 3, 1), "Rh", "Software", Decimal("1234.50"), "Despesa", "Licenca Anual"),
        ("A2", date(2025, 3, 15), "Operacoes", "Receita de Servicos", Decimal("2000.00"), "Receita", "Projeto"),
        ("A5", date(2025, 4, 2), "Ti", "Sem Categoria", Decimal("7.50"), "Despesa", "X"),
    ]
    # with the sentinel date, undated rows stay
    kept = clean.silver_ledger(bronze, "sentinel")
    assert rows(kept.where(F.col("data_lancamento") == date(1900, 1, 1)), "id_lancamento") == [("A3",), ("A6",)]


def test_distinct_is_idempotent(spark):
    once = clean.silver_ledger(spark.createDataFrame(RAW, LEDGER))
    assert once.distinct().count() == once.count()


def test_dedupe_by_key(spark, rows):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 7, "z"), (2, None, "q")], "k int, r int, v string")
    assert rows(clean.dedupe_by_key(df, ["k"], [F.col("r")])) == [(1, 5, "a"), (2, None, "q")]


def test_silver_customers_order_of_steps(spark, rows):
    data = [(f"C{i}", float(i), float(i * 10), " app ") for i in range(1, 12)]
    data += [data[0], ("C90", None, 1.0, "Web"), ("C91", 5000.0, None, "WEB"), ("C92", 6.5, None, "web")]
    df = spark.createDataFrame(data, "cliente_id string, renda_mensal double, score_bureau double, canal string")
    out = {r["cliente_id"]: r for r in clean.silver_customers(df).collect()}
    assert len(out) == 12 and "C90" not in out and "C91" not in out
    assert out["C92"]["score_bureau"] == 60.0  # median of the deduplicated rows with income
    assert {r["canal"] for r in out.values()} == {"App", "Web"}
