from datetime import date
from decimal import Decimal

from silverlode.operators import metrics, quality, star

SILVER = "id_lancamento string, data_lancamento date, centro_custo string, categoria string, valor decimal(12,2), tipo string, descricao string"
DATA = [
    ("1", date(2025, 1, 5), "Ti", "Vendas", Decimal("100.00"), "Receita", "a"),
    ("2", date(2025, 1, 6), "Rh", "Aluguel", Decimal("30.00"), "Despesa", "b"),
    ("3", date(2025, 2, 7), "Ti", "Receita de Servicos", Decimal("50.00"), "Receita", "c"),
    ("4", date(2025, 2, 7), "Ti", "Viagens", Decimal("80.00"), "Despesa", "d"),
    ("5", date(2025, 2, 8), "Ti", "Viagens", Decimal("1.00"), None, "e"),
]


def build(spark):
    return star.Star(spark.createDataFrame(DATA, SILVER))


def test_dimensions(spark, rows):
    g = build(spark)
    assert rows(g.cost_centres) == [(1, "Rh"), (2, "Ti")]
    assert rows(g.types) == [(1, "Despesa"), (2, "Receita")]
    assert rows(g.categories) == [
        (1, "Aluguel", "Operacional"),
        (2, "Receita de Servicos", "Receita"),
        (3, "Vendas", "Receita"),
        (4, "Viagens", "Pessoas"),
    ]
    assert rows(g.dates, "sk_data", "mes", "nome_mes", "trimestre", "dia", "dia_semana")[0] == (
        20250105, 1, "January", 1, 5, "Sunday",
    )
    assert g.dates.count() == 4


def test_numbering_in_parallel_equals_window(spark, rows):
    df = spark.createDataFrame([(f"l{i % 97:03d}",) for i in range(500)] + [(None,)], "x string")
    a = star.dimension(df, "x", "sk", "nome")
    b = star.dimension(df, "x", "sk", "nome", bounded=True)
    assert rows(a) == rows(b) and a.count() == 97


def test_fact_and_orphans(spark, rows):
    g = build(spark)
    assert rows(g.fact, "id_lancamento", "sk_centro_custo", "sk_categoria", "sk_tipo", "valor_sinalizado") == [
        ("1", 2, 3, 2, Decimal("100.00")),
        ("2", 1, 1, 1, Decimal("-30.00")),
        ("3", 2, 2, 2, Decimal("50.00")),
        ("4", 2, 4, 1, Decimal("-80.00")),
    ]
    lost = quality.orphans(g.silver, g.types.withColumnRenamed("tipo", "t"), "tipo", "t")
    assert rows(lost, "id_lancamento") == [("5",)]


def test_metrics(spark, rows):
    g = build(spark)
    f = g.fact
    assert rows(metrics.kpi(f)) == [(Decimal("150.00"), Decimal("110.00"), Decimal("40.00"))]
    monthly = metrics.net_by_month(f, g.dates)
    assert rows(monthly, "mes", "resultado_liquido") == [(1, Decimal("70.00")), (2, Decimal("-30.00"))]
    assert rows(metrics.month_growth(monthly), "mes", "crescimento_pct") == [(1, None), (2, -142.86)]
    assert rows(metrics.top_categories(f, g.categories, 1)) == [("Viagens", Decimal("80.00"), 1)]
    assert rows(metrics.top_cost_centres(f, g.cost_centres, 1)) == [("Ti", Decimal("70.00"))]
    assert rows(metrics.expense_by_cost_centre(f, g.cost_centres)) == [("Rh", Decimal("30.00")), ("Ti", Decimal("80.00"))]
    assert metrics.average_expense(f).first()["despesa_media"] == 55.0
    assert metrics.by_month_and_type(f, g.dates).count() == 4
