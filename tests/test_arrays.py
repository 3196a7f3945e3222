import json
import random

import pytest

from silverlode.sources.arrays import read_json_array

SCHEMA = "k long, t string, o struct<x:long,s:string>, l array<struct<z:string>>"
COLS = ["k", "t", "o", "l"]


@pytest.fixture
def split_at(spark):
    """Reads files in ranges of this many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield use
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def messy(draw, n):
    odd = ["}", "{", '"', "\\", "]", "[", ",", "é", "\n", "漢", "a", " ", "{}", '\\"', "}]"]
    word = lambda: "".join(draw.choice(odd) for _ in range(draw.randrange(9)))
    return [
        {"k": k, "t": word(), "o": {"x": k, "s": word()}, "l": [{"z": word()} for _ in range(draw.randrange(3))]}
        for k in range(n)
    ]


def values(df):
    return sorted(json.dumps(r.asDict(True), sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("size,indent", [(23, None), (64, 2), (400, None), (1 << 20, None)])
def test_equals_the_plain_reader(spark, split_at, tmp_path, size, indent):
    """Braces, quotes and backslashes in strings, nested objects, ranges smaller than an object."""
    draw = random.Random(size)
    rows = [messy(draw, 40), messy(draw, 7), []]
    for i, part in enumerate(rows):
        (tmp_path / f"{i}.json").write_text(json.dumps(part, indent=indent, ensure_ascii=bool(i)))
    split_at(size)
    got = read_json_array(spark, str(tmp_path), SCHEMA, COLS)
    assert values(got) == sorted(json.dumps(r, sort_keys=True) for part in rows for r in part)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert values(got) == values(spark.read.schema(SCHEMA).option("multiLine", True).json(str(tmp_path)))


def test_one_array_is_read_by_many_tasks(spark, split_at, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(messy(random.Random(1), 400)))
    split_at(4096)
    assert spark.read.text(str(tmp_path), lineSep="}").rdd.getNumPartitions() > 8
    assert read_json_array(spark, str(tmp_path), SCHEMA, ["k"]).distinct().count() == 400


@pytest.mark.parametrize(
    "text,want",
    [
        ("", []), (" [ ] ", []), ('{"k": 1}', [1]), ('{"k": 1}\n{"k": 2}\n', [1, 2]), ('[{"k": 1}, {}]', [None, 1]),
        ('[{"k": 1}, {"k" 2}, {"k": 3}]', [None, 1, 3]), ('[{"k": 1}, {"k": 2, "t": "cut', [None, 1]),
        ('[{"k": 1, "further": [{"k": 9}]}]', [1]),
    ],
)
@pytest.mark.parametrize("size", [5, 1 << 20])
def test_odd_files(spark, split_at, tmp_path, text, want, size):
    (tmp_path / "a.json").write_text(text)
    split_at(size)
    got = [r["k"] for r in read_json_array(spark, str(tmp_path), SCHEMA, ["k"]).collect()]
    assert sorted(got, key=lambda k: (k is not None, k)) == want
