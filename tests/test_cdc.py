import random

import pytest
from pyspark.sql import functions as F

from silverlode.operators import cdc, clean

FEED = "cliente_id int, nome string, cidade string, operacao string, sequencia int"
EVENTS = [
    (101, "Ana", "Araxá", "I", 1),
    (102, "Bruno", "Uberlândia", "I", 2),
    (103, "Carla", "Goiânia", "I", 3),
    (102, "Bruno", "Belo Horizonte", "U", 4),
    (103, None, None, "D", 5),
    (104, "Diego", "Curitiba", "I", 6),
]


def spec():
    return ["cliente_id"], "sequencia", F.col("operacao") == "D"


def test_scd1_published_state(spark, rows):
    df = spark.createDataFrame(EVENTS, FEED)
    assert rows(cdc.scd1(df, *spec(), drop=["operacao", "sequencia"])) == [
        (101, "Ana", "Araxá"),
        (102, "Bruno", "Belo Horizonte"),
        (104, "Diego", "Curitiba"),
    ]
    kept = cdc.scd1(df, *spec())
    assert "operacao" in kept.columns and "sequencia" in kept.columns


def test_scd2_published_versions(spark, rows):
    df = spark.createDataFrame(EVENTS, FEED)
    got = rows(cdc.scd2(df, *spec(), drop=["operacao", "sequencia"]), "cliente_id", "cidade", "__START_AT", "__END_AT")
    assert got == [
        (101, "Araxá", 1, None),
        (102, "Belo Horizonte", 4, None),
        (102, "Uberlândia", 2, 4),
        (103, "Goiânia", 3, 5),
        (104, "Curitiba", 6, None),
    ]


def test_order_corrections(spark, rows):
    df = spark.createDataFrame(
        [(4, "Cappuccino", 2, "UPDATE", 1), (7, "Suco", 0, "DELETE", 1)],
        "id int, produto string, quantidade int, operacao string, versao int",
    )
    got = cdc.scd1(df, ["id"], "versao", F.col("operacao") == "DELETE")
    assert rows(got, "id", "quantidade") == [(4, 2)]


def test_edge_cases(spark, rows):
    events = [
        (1, "a", "x", "I", 1), (1, None, None, "D", 2), (1, "a2", "y", "I", 3),  # insert again after a delete
        (2, None, None, "D", 1),  # delete of an unknown key
        (3, "c", "x", "I", 5), (3, None, None, "D", 5),  # equal sequence: the delete wins
        (4, "d", "x", "I", 1), (4, "d", "x", "U", 2), (4, "d", "z", "U", 3),  # unchanged payload
    ]
    df = spark.createDataFrame(events, FEED)
    assert rows(cdc.scd1(df, *spec()), "cliente_id", "cidade") == [(1, "y"), (4, "z")]
    history = cdc.scd2(df, *spec(), drop=["operacao", "sequencia"])
    assert rows(history, "cliente_id", "__START_AT", "__END_AT") == [(1, 1, 2), (1, 3, None), (4, 1, 2), (4, 2, 3), (4, 3, None)]
    short = cdc.scd2(df, *spec(), drop=["operacao", "sequencia"], collapse=True)
    assert rows(short.where("cliente_id = 4"), "__START_AT", "__END_AT") == [(1, 3), (3, None)]


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("collapse", [False, True])
def test_scd2_against_brute_force_with_a_hot_key(spark, rows, parts, collapse):
    rnd = random.Random(parts)
    events = []
    for seq in rnd.sample(range(5000), 600):
        key = 1 if rnd.random() < 0.4 else rnd.randint(2, 30)
        op = rnd.choice("IUUUD")
        events.append((key, None if op == "D" else rnd.choice("ab"), None if op == "D" else "c", op, seq))
    expected, by_key = [], {}
    for e in sorted(events, key=lambda e: e[4]):
        by_key.setdefault(e[0], []).append(e)
    for key, es in by_key.items():
        if collapse:
            es = [e for i, e in enumerate(es) if i == 0 or (e[3] == "D", e[1], e[2]) != (es[i - 1][3] == "D", es[i - 1][1], es[i - 1][2])]
        for e, nxt in zip(es, es[1:] + [None]):
            if e[3] != "D":
                expected.append((key, e[1], e[4], nxt and nxt[4]))
    df = spark.createDataFrame(events, FEED).repartition(5)
    got = cdc.scd2(df, *spec(), drop=["operacao", "sequencia"], parts=parts, collapse=collapse)
    want = sorted(expected, key=lambda r: [(v is not None, v) for v in r])
    assert rows(got, "cliente_id", "nome", "__START_AT", "__END_AT") == want
    quick = cdc.scd2(df, *spec(), drop=["operacao", "sequencia"], parts=parts, collapse=collapse, unique_sequence=True)
    assert rows(quick) == rows(got)


def test_merge_ignores_late_events(spark, rows):
    df = spark.createDataFrame(EVENTS, FEED)
    state = cdc.latest_events(df.where("sequencia > 3"), *spec())
    merged = cdc.merge_scd1(state, df.where("sequencia <= 3"), *spec())
    assert rows(merged) == rows(cdc.latest_events(df, *spec()))
    assert rows(merged.where("operacao = 'D'"), "cliente_id") == [(103,)]  # the tombstone stays


def test_a_null_key_is_a_key(spark, rows):
    events = [(None, "a", "x", "I", i) for i in range(1, 9)]
    df = spark.createDataFrame(events, FEED)
    got = cdc.scd2(df, *spec(), drop=["operacao", "sequencia"], parts=4)
    assert rows(got, "__START_AT", "__END_AT") == [(i, i + 1 if i < 8 else None) for i in range(1, 9)]


def test_history_shuffles_the_feed_once(spark):
    df = spark.createDataFrame(EVENTS, FEED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = cdc.scd2(df, *spec(), parts=2, unique_sequence=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    feed_side = plan[plan.index("SortMergeJoin") :].split("Window")[0]
    assert "Exchange" not in feed_side  # the join keeps the window's partitioning


def test_payloads_with_maps(spark):
    """Maps have no order; the sequence decides, then the delete, then a print of the row."""
    feed = spark.createDataFrame([(1, 5, "U", {"a": 1}), (1, 7, "U", {"b": 2}), (2, 3, "U", {"c": 3}), (2, 3, "D", None)], "k int, seq int, op string, m map<string,int>")
    got = {r["k"]: r["m"] for r in cdc.scd1(feed, ["k"], "seq", F.col("op") == "D").collect()}
    assert got == {1: {"b": 2}}
    one = clean.dedupe_by_key(feed, ["k"], [-F.col("seq")])
    assert {r["k"]: r["seq"] for r in one.collect()} == {1: 7, 2: 3}
