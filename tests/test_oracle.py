"""Registered queries against their SQL twins on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return f"{type(v).__name__}:{v!r}"


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    twin = sql.sql(entry.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(twin.columns)
    got = Counter(tuple(map(norm, r)) for r in df.select(cols).collect())
    want = Counter(tuple(map(norm, r)) for r in twin.select(*[f'"{c}"' for c in cols]).fetchall())
    assert got == want and got


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 110


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["ano", "mes", "nome_mes", "resultado_liquido"] and out.count() > 0
