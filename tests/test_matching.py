import random

import pytest
from pyspark.sql import functions as F

from silverlode.functions.similarity import edit_similarity, email_domain, email_user, similarity
from silverlode.operators import matching as m

XREF = "source_name string, registro_id string, full_name string, email string, phone string, endereco string"


def tri(s):
    s = s or ""
    p = "  " + s
    return {p[i : i + 3] for i in range(len(s))}


def jac(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def digs(s):
    return "".join(c for c in s if c.isdigit())


def user(e):
    return "".join(c for c in e.split("@")[0] if c.isalnum())


def whole(e):
    return user(e) + ("@" + e.split("@")[-1] if "@" in e else "")


def rule_of(a, b):
    """Definition: compare two records field by field."""
    if jac(tri(a[2].lower()), tri(b[2].lower())) < 0.6:
        return None
    if a[3] and b[3] and digs(a[3]) == digs(b[3]) and jac(tri(whole(a[3])), tri(whole(b[3]))) >= 0.6:
        return 1
    if a[4] is not None and a[4] == b[4]:
        return 2
    if a[5] and b[5] and digs(a[5]) == digs(b[5]) and jac(tri(a[5]), tri(b[5])) >= 0.6:
        return 3
    return None


def brute(a, b):
    best = {}
    for y in b:
        found = [(r, -jac(tri(x[2].lower()), tri(y[2].lower())), x[1]) for x in a if (r := rule_of(x, y))]
        if found:
            best[y[1]] = (min(found)[0], min(found)[2])
    return best


def run(spark, a, b):
    da, db = spark.createDataFrame(a, XREF), spark.createDataFrame(b, XREF)
    best = m.best_match(m.cascade(m.signals(da, db)))
    return {r["id_js"]: (r["regra_match"], r["id_pg"]) for r in best.collect()}


def test_published_outcomes(spark):
    a = [
        ("a", "PG-1", "Ana Souza", "ana.souza@gmail.com", "34999112233", "rua das flores, 100, araxá"),
        ("a", "PG-2", "Bruno Lima", "bruno_lima@hotmail.com", "34900000000", "rua x, 1"),
        ("a", "PG-3", "Carla Mendes", "carla.mendes@yahoo.com", "62911111111", "rua 5, 33"),
        ("a", "PG-4", "Diego Ferreira", "dferreira@outra.com", "34999996655", "praça da matriz, 9"),
        ("a", "PG-5", "Fabio Rocha", "fr@uol.com", "34912345678", "rua b, 45, uberaba - mg"),
        ("a", "PG-6", "Zulmira Prado", "z@z.com", "1", "rua z"),
    ]
    b = [
        ("b", "JS-1", "Ana Souza", "ana.souza@gmail.com", "34999112233", "rua das flores, 100, araxá - mg"),
        ("b", "JS-2", "Bruno L.", "bruno.lima@hotmail.com", "34988223344", "avenida brasil 200"),
        ("b", "JS-3", "Karla Mendes", "carla.mendes@yahoo.com", "62997771122", "rua 5, 33, goiânia"),
        ("b", "JS-4", "Ana Souza", "ana.souza2@gmail.com", "34988880000", "rua nova, 5"),
        ("b", "JS-5", "Diego Ferreira", "diego@empresa.com", "34999996655", "praça central, 12"),
        ("b", "JS-6", "Fabio Rocha", "fabio.rocha@gmail.com", "34988887777", "rua b, 45, uberaba - mg"),
        ("b", "JS-7", "Helena Dias", "helena.dias@outlook.com", "11955554444", "rua y, 9"),
    ]
    assert run(spark, a, b) == {
        "JS-1": (1, "PG-1"),
        "JS-2": (1, "PG-2"),
        "JS-3": (1, "PG-3"),
        "JS-5": (2, "PG-4"),
        "JS-6": (3, "PG-5"),
    } == brute(a, b)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_blocked_equals_all_pairs(spark, seed):
    """Random registries with copies, hot phones, short, empty and missing fields."""
    rnd = random.Random(seed)
    names = ["ana", "ana s", "x", "maria silva", "mario silva", "joao paulo souza", "j p souza", "li", "bo"]

    def record(tag, i):
        name = rnd.choice(names)
        if rnd.random() < 0.4:
            at = rnd.randrange(len(name))
            name = name[:at] + rnd.choice("abk ") + name[at + 1 :]
        mail = rnd.choice([name.replace(" ", rnd.choice("._")) + rnd.choice(["", "2"]) + "@" + rnd.choice(["a.com", "b.com"]), "semarroba", "@a.com", None])
        street = rnd.choice(["rua a, 1", "rua ab, 1", "av brasil, 20", "av brazil, 20", "", None])
        return (tag, f"{tag}-{i:03d}", " ".join(name.split()).title(), mail, rnd.choice(["000", "000", "123", "", None, str(i)]), street)

    a = [record("PG", i) for i in range(70)]
    b = [record("JS", i) for i in range(70)]
    a += [("PG", f"PG-9{i:02d}", *a[0][2:]) for i in range(30)]  # a group of copies
    assert run(spark, a, b) == brute(a, b)


def test_domains_may_differ_and_nobody_is_left_out(spark):
    a = [("a", "PG-1", "Joao Silva", "joao.silva@gmail.com", "1", "rua a"), ("a", "PG-2", "Ana Souza", "ana.souza@gmail.com", "2", "rua b")]
    b = [("b", f"JS-{i}", n, e, None, None) for i, (n, e) in enumerate([("Joao Silva", "joao.silva@gmial.com"), ("Joao Silva", "joao.silva@gmail.com.br"), ("Ana Souza", "ana.souza2@gmail.com"), ("Helena Dias", "helena.dias@outlook.com")])]
    da, db = spark.createDataFrame(a, XREF), spark.createDataFrame(b, XREF)
    rows = {r["id_js"]: (r["regra_match"], r["id_pg"]) for r in m.cascade(m.signals(da, db)).collect()}
    assert rows == {"JS-0": (1, "PG-1"), "JS-1": (1, "PG-1"), "JS-2": (None, None), "JS-3": (None, None)}


def test_copies_are_compared_once(spark):
    a = [("a", f"PG-{i:03d}", "Ana Souza", "ana@a.com", "1", "rua a, 1") for i in range(50)]
    b = [("b", f"JS-{i:03d}", "Ana Souza", "ana@a.com", "1", "rua a, 1") for i in range(40)]
    da, db = spark.createDataFrame(a, XREF), spark.createDataFrame(b, XREF)
    pairs = m.matching_values(da, db, 1).collect()
    assert [(r["id_a"], r["registros_a"], r["registros_b"]) for r in pairs] == [("PG-000", 50, 40)]
    assert set(run(spark, a, b).values()) == {(1, "PG-000")}


def test_similarity_functions(spark):
    df = spark.createDataFrame([("karla mendes", "carla mendes"), ("a", "a"), ("", "a")], "a string, b string")
    got = [r[0] for r in df.select(similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [0.6, 1.0, None]
    edit = [r[0] for r in df.select(edit_similarity(F.col("a"), F.col("b"))).collect()]
    assert edit == [pytest.approx(1 - 1 / 12), 1.0, 0.0]
    mail = spark.createDataFrame([("a_b.c@x.com",), ("sem",)], "e string")
    assert [tuple(r) for r in mail.select(email_user(F.col("e")), email_domain(F.col("e"))).collect()] == [("abc", "x.com"), ("sem", None)]


def test_harmonise(spark, rows):
    a = spark.createDataFrame([(7, " ANA", "souza ", "ana@gmail. com", "(34) 9", " Rua A ")], "customer_id int, first_name string, last_name string, email string, phone string, address string")
    b = spark.createDataFrame([("zeca", "z@z", "1", "r"), ("ana b", "a@a", "2", "s")], "nome string, email string, phone string, address string")
    assert rows(m.harmonise_split_names(a, "s", "PG-")) == [("s", "PG-7", "Ana Souza", "ana@gmail.com", "349", "rua a")]
    assert rows(m.harmonise_full_names(b, "s", "JS-"), "registro_id", "full_name") == [("JS-1", "Ana B"), ("JS-2", "Zeca")]


def test_no_side_of_a_join_is_collected_on_the_driver(spark):
    """Files are small, the keys and trigrams made of them are not: every join has to shuffle."""
    a = [("a", f"PG-{i}", "Ana Souza", f"ana{i}@a.com", "1", "rua a, 1") for i in range(5)]
    b = [("b", f"JS-{i}", "Ana Souza", f"ana{i}@a.com", "1", "rua a, 1") for i in range(5)]
    da, db = spark.createDataFrame(a, XREF), spark.createDataFrame(b, XREF)
    for df in (*(m.matching_values(da, db, rule) for rule in m.FIELDS), m.signals(da, db)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def registries(seed, n=60):
    rnd = random.Random(seed)
    names = ["ana", "ana s", "x", "xy", "maria silva", "mario silva", "joao paulo souza", "j p souza", "li", ""]

    def record(tag, i):
        name = rnd.choice(names)
        if name and rnd.random() < 0.5:
            at = rnd.randrange(len(name))
            name = name[:at] + rnd.choice("abk ") + name[at + 1 :]
        mail = rnd.choice([name.replace(" ", rnd.choice("._")) + rnd.choice(["", "2"]) + "@" + rnd.choice(["a.com", "b.com"]), "..", "", None])
        return (tag, f"{tag}-{i:03d}", " ".join(name.split()).title(), mail, rnd.choice(["000", "123", "", None]), rnd.choice(["rua a, 1", "rua ab, 1", "av brasil, 20", "", None]))

    return [record("PG", i) for i in range(n)], [record("JS", i) for i in range(n)]


@pytest.mark.parametrize("crowded", [(0, 1 << 33), (0, 0)])
def test_crowded_groups_keep_all_matches(spark, monkeypatch, crowded):
    """Keys of one and of two trigrams find what whole groups find, sets of a single trigram too."""
    monkeypatch.setattr(m, "CROWDED", crowded)
    a, b = registries(7)
    assert run(spark, a, b) == brute(a, b)


@pytest.mark.parametrize("threshold", [0.3, 0.9])
def test_crowded_groups_at_other_thresholds(spark, monkeypatch, threshold):
    a, b = registries(8)
    da, db = spark.createDataFrame(a, XREF), spark.createDataFrame(b, XREF)

    def close(x, y):
        return jac(tri(x[2].lower()), tri(y[2].lower())) >= threshold

    expected = {(x[2], x[4], y[2], y[4]) for x in a for y in b if x[4] is not None and x[4] == y[4] and close(x, y)}
    monkeypatch.setattr(m, "CROWDED", (0, 0))
    got = {(r["full_name_a"], r["valor_a"], r["full_name_b"], r["valor_b"]) for r in m.matching_values(da, db, 2, threshold).collect()}
    assert got == expected


def test_a_value_has_few_key_rows(spark):
    """Keys were 460 rows of an e-mail and name, most of them never to meet: that filled disks."""
    rows = [("a", f"PG-{i}", f"Joaquim{i:03d} Albuquerque", f"joaquim.albuquerque{i}@empresa.com", str(i), f"rua das flores, {i}") for i in range(20)]
    df = spark.createDataFrame(rows, XREF)
    for rule in m.FIELDS:
        values = m._values(df, rule).withColumn("_n", F.monotonically_increasing_id())
        everywhere = list(range(m.BUCKETS))
        counts = [m._keys(values, rule, m.THRESHOLD, [], crowded).count() / 20 for crowded in ([[], []], [everywhere, []], [everywhere, everywhere])]
        assert counts[0] == 1 and counts[1] <= 10 and counts[2] <= 60
        assert [t for _, t in m._keys(values, rule, m.THRESHOLD, [], [[], []]).dtypes] == ["bigint"] * 3


def test_trigrams_are_not_shuffled(spark):
    a, b = registries(9, 5)
    da, db = spark.createDataFrame(a, XREF), spark.createDataFrame(b, XREF)
    for df in (*(m.matching_values(da, db, rule) for rule in m.FIELDS), m.signals(da, db)):
        plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        moved = [part.split("\n")[1] for part in plan.split("\n\n") if part.split(" ", 1)[-1].startswith("Exchange")]
        assert len(moved) > 3 and not any("_t_" in columns for columns in moved)


def test_sketches_differ_in_no_more_bits_than_sets(spark):
    rnd = random.Random(3)
    sets = [[f"t{rnd.randrange(60)}" for _ in range(rnd.randrange(1, 40))] for _ in range(60)]
    df = spark.createDataFrame([(i, sorted(set(s))) for i, s in enumerate(sets)], "i int, tokens array<string>")
    for bits in (m.NAME_BITS, m.VALUE_BITS):
        sketch = {r[0]: r[1] for r in df.select("i", m._sketch("tokens", bits)).collect()}
        assert all(0 <= v < 1 << bits for v in sketch.values())
        assert all(bin(sketch[i] ^ sketch[j]).count("1") <= len(set(sets[i]) ^ set(sets[j])) for i in sketch for j in sketch)
