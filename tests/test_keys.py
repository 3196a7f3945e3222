import pytest

from silverlode.operators.keys import KeyMap


def test_keys_stay_over_loads(spark, tmp_path):
    labels = lambda *x: spark.createDataFrame([(v,) for v in x], "nome string")
    keys = KeyMap(spark, str(tmp_path / "keys"), ["nome"], "sk", most=3)
    with pytest.raises(LookupError):
        keys.read()
    assert keys.load(1, labels("m", "c", "c", None)) == 2
    first = {r["nome"]: r["sk"] for r in keys.read().collect()}
    assert first == {"c": 1, "m": 2}
    # labels that sort before known ones come after them; the table splits meanwhile
    assert keys.load(2, labels("a", "c", "z", *map("k{:02}".format, range(20)))) == 22
    second = {r["nome"]: r["sk"] for r in keys.read().collect()}
    assert first.items() <= second.items()
    assert sorted(second.values()) == list(range(1, 25)) and second["a"] == 3 and second["z"] == 24
    assert keys.stored.layout().buckets > 1
    # again under the same version, and a load without anything new
    assert keys.load(2, labels("a", "c", "z", *map("k{:02}".format, range(20)))) == 22
    assert {r["nome"]: r["sk"] for r in keys.read().collect()} == second
    assert keys.load(3, labels("a", "m", None)) == 0 and keys.load(4, labels()) == 0
    assert {r["nome"]: r["sk"] for r in keys.read().collect()} == second


def test_keys_of_several_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (1, None)], "n int, s string")
    keys = KeyMap(spark, str(tmp_path / "keys"), ["n", "s"], "sk")
    assert keys.load(1, rows.where("n = 2")) == 1 and keys.load(2, rows) == 2
    assert sorted(map(tuple, keys.read().collect())) == [(1, 2, "a"), (2, 1, "a"), (3, 1, "b")]
