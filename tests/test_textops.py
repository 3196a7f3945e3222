from collections import Counter

from silverlode.operators import textops

# Our own ten comments over three classes.
COMMENTS = [
    (1, "Equipe excelente, resolveram tudo rapido"),
    (2, "Sigo esperando retorno, um absurdo"),
    (3, "Como antecipo as parcelas?"),
    (4, "Fui enganado na taxa anunciada"),
    (5, "Parabens pela agilidade"),
    (6, "O app trava sempre"),
    (7, "Qual o horario da agencia?"),
    (8, "Cobraram tarifa, quero estorno"),
    (9, "Gostei da consultora, muito atenciosa"),
    (10, "Voces trabalham com consignado?"),
    (11, ""),
    (12, "gostei mas trava"),
]
KEYWORDS = {
    "elogio": ["excelente", "parabens", "gostei", "agilidade", "atenciosa"],
    "reclamacao": ["absurdo", "esperando", "enganado", "trava", "cobraram", "tarifa", "estorno"],
    "duvida": ["como", "qual", "horario", "trabalham"],
}


def labelled(spark):
    df = spark.createDataFrame(COMMENTS, "id int, texto string")
    return textops.classify(df, "texto", KEYWORDS, "duvida")


def test_classify(spark):
    got = {r["id"]: r["tipo"] for r in labelled(spark).collect()}
    assert Counter(got[i] for i in range(1, 11)) == {"elogio": 3, "reclamacao": 4, "duvida": 3}
    assert got[11] == "duvida" and got[12] == "elogio"  # nothing found; a tie


def test_concat_parts_is_complete(spark):
    got = textops.concat_parts(labelled(spark), "tipo", "texto", "id", per_part=5)
    parts = {(r["tipo"], r["parte"]): r["texto"] for r in got.collect()}
    assert parts["elogio", 0] == COMMENTS[0][1]
    assert parts["elogio", 1] == f"{COMMENTS[4][1]} | {COMMENTS[8][1]}"
    whole = textops.concat_parts(labelled(spark), "tipo", "texto", "id", per_part=1000)
    assert whole.count() == 3
    assert sum(r["textos"] for r in whole.collect()) == len(COMMENTS)


def test_extractive_summary(spark, rows):
    docs = [(1, "g", "the cat sat. the cat ran! dogs bark"), (2, "g", "the cat sat"), (3, "h", "um so texto")]
    df = spark.createDataFrame(docs, "id int, g string, t string")
    got = textops.extractive_summary(df, "g", "t", "id", k=2)
    assert rows(got, "g", "posicao", "id", "pos", "frase") == [
        ("g", 1, 1, 0, "the cat sat"),
        ("g", 2, 2, 0, "the cat sat"),
        ("h", 1, 3, 0, "um so texto"),
    ]


def test_summary_whatever_is_common_and_however_it_is_spread(spark, rows, monkeypatch):
    """Common words travel, rarer ones are shuffled, parts follow the number of words: same sentences."""
    texts = [(i, "g" if i % 3 else "h", f"alpha beta w{'abcdefghij'[i % 10]}. alpha gamma {'xyz'[i % 3]}! alpha") for i in range(40)] + [(99, None, "alpha alpha")]
    df = spark.createDataFrame(texts, "id int, g string, t string")
    found = {}
    for common in (2.0, 0.05, 0.0):  # all words rare, some, none
        monkeypatch.setattr(textops, "COMMON", common)
        monkeypatch.setattr(textops, "PER_TASK", 10)
        out = textops.extractive_summary(df, "g", "t", "id", k=3)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" in plan  # more parts than the session's shuffles make
        found[common] = rows(out, "g", "posicao", "id", "pos", "score", "frase")
    assert found[2.0] == found[0.05] == found[0.0]
    assert found[2.0][0] == ("g", 1, 1, 2, 78.0, "alpha") and len(found[2.0]) == 6
