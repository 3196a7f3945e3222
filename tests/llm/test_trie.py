"""The conversation trie against a brute-force version."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from silverlode.llm import trie
from silverlode.llm.common import carried, importable

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture
def sp(spark):
    importable(spark)
    return spark


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [turn[2:] for turn in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    out = Counter()
    for k, members in nodes.items():
        below = [u for u in nodes if u[: len(k)] == k]
        saved = sum((len(nodes[u]) - 1) * len(u[-1][1].encode()) for u in below if u)
        ends = ",".join(str(c) for c in members if len(built[c]) == len(k))
        parent = nodes[k[:-1]][0] if k else None
        out[members[0], len(k), parent, len(members), kids[k], sum(not kids[u] for u in below), saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def test_trie_equals_brute_force(sp, monkeypatch):
    """Few different turns, NULLs, ties, repeated rows, long conversations, families without a first one."""
    monkeypatch.setattr(trie, "PIECE", 3)
    rnd = random.Random(5)
    rows = [
        (c, rnd.choice([t, t, t, None, 1]), rnd.choice(["user", "user", "assistant", None]), rnd.choice(["é", "b", "", None, "long " * 2000]))
        for c in [*range(40), 101, 104, 10**15]
        for t in range(rnd.choice([1, 2, 5, 9, 12, 20, 60]))
    ]
    rows += [(c, t, "user", f"hello {t}") for c in range(200, 230) for t in range(3)]  # a group of copies
    rows += [(None, 1, "user", "x"), rows[0], rows[0]]
    clash = sp.createDataFrame([(*r, 7, "k") for r in rows], SCHEMA + ", depth int, k1 string")
    assert Counter(map(tuple, trie.prefix_trie(clash).collect())) == brute(rows)


def test_empty_table_has_no_node(sp):
    out = trie.prefix_trie(sp.createDataFrame([], SCHEMA))
    assert out.count() == 0
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]


def test_carried_sums_over_the_whole_table(sp):
    rows = [(i % 3, i, (i * 7) % 11) for i in range(500)]
    df = sp.createDataFrame(rows, "k long, i long, v long").repartition(7)
    got = {(r.k, r.i): r.s for r in carried(df, ["k", "i"], {"s": df["v"]}).collect()}
    total, want = 0, {}
    for k, i, v in sorted(rows):
        want[k, i], total = total, total + v
    assert got == want
