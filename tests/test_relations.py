"""Quality reports, profiling, joins, windows, views, sources and sinks."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverlode import session
from silverlode.operators import joins, materialize, profile, quality, windows
from silverlode.operators.quality import Rule
from silverlode.sources import generate, readers, sinks

ORDERS = "id int, produto string, quantidade int, preco decimal(8,2)"
LINES = [
    (1, "Espresso", 2, Decimal("8.50")),
    (2, "Latte", 0, Decimal("12.00")),
    (3, None, -1, Decimal("9.00")),
    (4, "Bolo", 1, Decimal("0.00")),
    (5, "Bolo", None, Decimal("3.00")),
]


def rules(action):
    return [
        Rule("produto_valido", F.col("produto").isNotNull(), action),
        Rule("quantidade_valida", F.col("quantidade") > 0, action),
        Rule("preco_valido", F.col("preco") > 0, action),
    ]


def test_expectations(spark, rows):
    df = spark.createDataFrame(LINES, ORDERS)
    assert rows(quality.expect_valid(df, rules("drop")), "id") == [(1,)]
    assert quality.expect_valid(df, rules("warn")).count() == 5
    assert rows(quality.rule_metrics(df, rules("drop")), "rule", "checked", "failed") == [
        ("preco_valido", 5, 1), ("produto_valido", 5, 1), ("quantidade_valida", 5, 3),
    ]
    flagged = {r["id"]: r["violations"] for r in quality.flag_violations(df, rules("warn")).collect()}
    assert flagged[1] == [] and flagged[3] == ["produto_valido", "quantidade_valida"]
    assert flagged[5] == ["quantidade_valida"]  # NULL counts as a violation
    assert rows(quality.gate(df, rules("fail"))) == [(4, False)]
    assert rows(quality.gate(df.where("id = 1"), rules("fail"))) == [(0, True)]
    with pytest.raises(ValueError):
        Rule("x", F.lit(True), "ignore")


def test_quality_reports(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "b"), (None, "c")], "k int, v string")
    assert rows(quality.null_counts(df)) == [(1, 1)]
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 3)]
    assert rows(quality.duplicate_count(df)) == [(5, 4, 1)]
    assert rows(quality.primary_key_report(df, ["k"])) == [(5, 1, 1, False)]
    assert rows(quality.primary_key_report(df.where("k = 2"), ["k"])) == [(1, 0, 0, True)]
    assert rows(quality.duplicate_count(df.limit(0))) == [(0, 0, 0)]
    assert rows(quality.leakage(df.where("k = 1"), df.where("k = 2"), ["k"])) == [(0,)]
    assert rows(quality.leakage(df, df.where("k = 1"), ["k"])) == [(1,)]
    assert rows(quality.layer_counts({"a": df, "b": df.distinct()})) == [("a", 5), ("b", 4)]


def test_fan_out_sum_equals_joined_rows(spark, rows):
    sales = spark.createDataFrame([("X", 1, 10), ("X", 1, 20), ("Y", 2, 5), ("Y", 3, 7)], "cidade string, cliente int, v long")
    credit = spark.createDataFrame([(1, 100), (1, 50), (2, 8)], "cliente int, c long")
    naive = sales.join(credit, "cliente").groupBy("cidade").agg(F.sum("v"), F.sum("c"))
    assert rows(joins.join_sum(sales, credit, "cliente", "cidade", "v", "c")) == rows(naive) == [("X", 60, 300), ("Y", 5, 8)]
    assert rows(joins.join_sum(sales, credit, "cliente", "cidade", "v", "c", fan_out=False)) == [("X", 30, 150), ("Y", 5, 8)]


def test_ratio_to_target(spark, rows):
    actual = spark.createDataFrame([("G", 9000.0), ("U", 1500.0), ("Z", 1.0), ("S", 1.0)], "cidade string, r double")
    goals = spark.createDataFrame([("G", 4500.0), ("U", 2000.0), ("Z", 0.0)], "cidade string, m double")
    assert rows(joins.ratio_to_target(actual, goals, "cidade", "r", "m"), "cidade", "pct_meta") == [("G", 200.0), ("U", 75.0), ("Z", None)]


def test_windows(spark, rows):
    df = spark.createDataFrame([("A", 1, 320.0), ("A", 2, 555.25), ("A", 3, 1150.0), ("B", 1, 1.0)], "g string, m int, v double")
    assert rows(windows.running_total(df, "g", "m", "v", "t"), "g", "m", "t") == [
        ("A", 1, 320.0), ("A", 2, 875.25), ("A", 3, 2025.25), ("B", 1, 1.0),
    ]
    assert rows(windows.versus_group_mean(df, "g", "v").where("g = 'A' and m = 1"), "media_grupo", "pct_vs_grupo") == [(675.08, -52.6)]
    nameless = spark.createDataFrame([(None, 1.0), (None, 3.0)], "g string, v double")
    assert rows(windows.versus_group_mean(nameless, "g", "v"), "media_grupo") == [(2.0,), (2.0,)]
    assert rows(windows.top_k_per_group(df, ["g"], [F.desc("v")], 1), "g", "m") == [("A", 3), ("B", 1)]
    assert "GroupLimit" in windows.top_k_per_group(df, ["g"], [F.desc("v")], 1)._jdf.queryExecution().toString()


def test_profile(spark, rows):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(1, 11)] + [(1000.0, 1), (None, 0)], "x double, y int")
    assert rows(profile.numeric_profile(df, ["x"])) == [("x", 11, 1.0, 95.9091, 1000.0)]
    assert rows(profile.iqr_outliers(df, "x")) == [(1, 16.0)]
    assert rows(profile.quantiles(df, "x", [0.5])) == [(0.5, 6.0)]
    assert rows(profile.quantiles(df, "x", [0.5], exact=False)) == [(0.5, 6.0)]
    assert profile.band_rate(df, "x", [(5.0, "low")], "high", "y").count() == 2
    assert rows(profile.schema_table(df)) == [(0, "x", "double"), (1, "y", "int")]
    c = profile.correlations(df.where("x < 100"), ["x"], "y").first()["corr_x"]
    assert c == pytest.approx(-0.174)


def test_snapshot_is_stale_until_refreshed(spark, tmp_path):
    src = str(tmp_path / "src")
    sinks.write_replace(spark.range(3), src)
    build = lambda s: s.read.parquet(src).agg(F.count("*").alias("n"))
    live = lambda: materialize.persistent_view(spark, "v_rows", f"SELECT count(*) AS n FROM parquet.`{src}`").first()["n"]
    assert materialize.refresh_snapshot(spark, "mv_rows", build).first()["n"] == 3
    sinks.write_append(spark.range(2), src)
    assert live() == 5 and spark.table("mv_rows").first()["n"] == 3
    materialize.refresh_snapshot(spark, "mv_rows", build)
    assert spark.table("mv_rows").first()["n"] == 5

    def broken(s):
        raise RuntimeError("source unavailable")

    with pytest.raises(RuntimeError):
        materialize.refresh_snapshot(spark, "mv_rows", broken)
    assert spark.table("mv_rows").first()["n"] == 5


def test_snapshot_outlives_its_view(spark, tmp_path):
    """Refreshed three times on one durable folder: the newest counts, one older version stays."""
    root = str(tmp_path / "mv")
    for n in (2, 3, 4):
        materialize.refresh_snapshot(spark, "mv_durable", lambda s, n=n: s.range(n), root)
        assert spark.table("mv_durable").count() == n == materialize.current_snapshot(spark, root).count()
    assert sorted(p.name for p in (tmp_path / "mv").iterdir()) == ["v=0000000002", "v=0000000003"]
    (tmp_path / "mv" / "v=0000000009").mkdir()  # an unfinished version is no version
    assert materialize.current_snapshot(spark, root).count() == 4
    with pytest.raises(FileNotFoundError):
        materialize.current_snapshot(spark, str(tmp_path / "none"))


def test_view_scopes(spark):
    materialize.live_view(spark.range(4), "v_session")
    materialize.live_view(spark.range(4), "v_global", scope="global")
    other = spark.newSession()
    assert other.table("global_temp.v_global").count() == 4
    assert not other.catalog.tableExists("v_session")
    with pytest.raises(ValueError):
        materialize.live_view(spark.range(1), "x", scope="cluster")


def test_csv_rescue_and_json(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('id,v\n1,"R$ 1,50"\n2, x \n3,a,b\n')
    got = rows(readers.read_raw_csv(spark, str(tmp_path / "a.csv"), ["id", "v"]))
    assert got == [("1", "R$ 1,50", None), ("2", " x ", None), ("3", "a", "3,a,b")]
    (tmp_path / "a.json").write_text('[\n {"nome": "A", "x": 1},\n {"nome": "B"}\n]')
    assert rows(readers.read_json_array(spark, str(tmp_path / "a.json"), "nome string, x int", ["nome"])) == [("A",), ("B",)]
    inv = readers.file_inventory(spark, str(tmp_path))
    assert {r["path"].split("/")[-1] for r in inv.collect()} == {"a.csv", "a.json"}
    prov = readers.with_provenance(spark.read.text(str(tmp_path / "a.csv")), full_path=False).first()
    assert prov["_arquivo_origem"] == "a.csv" and prov["_carregado_em"] is not None


def test_jdbc_options_describe_a_partitioned_scan():
    assert readers.jdbc_options("jdbc:postgresql://h/db", "t", ("id", 1, 1000, 8)) == {
        "url": "jdbc:postgresql://h/db", "dbtable": "t", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "1000", "numPartitions": "8",
    }


def test_replace_sink_changes_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_replace(spark.range(3), path)
    sinks.write_replace(spark.range(2).select(F.lit("x").alias("novo")), path)
    assert spark.read.parquet(path).columns == ["novo"] and spark.read.parquet(path).count() == 2


def test_inject_dirt(spark):
    df = spark.range(100).select("id", F.lit(2.0).alias("x"))
    dirty = generate.inject_dirt(df, F.col("id"), nulls={"x": (10, 3)}, outliers={"x": (20, 1, 50.0)}, copies=(25, 0))
    assert dirty.count() == 104
    assert dirty.where("x is null").count() == 10 and dirty.where("x = 100").count() == 5


def test_scratch_follows_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.scratch_root(spark) == configured.rstrip("/")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
