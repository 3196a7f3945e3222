"""Ranked search against a brute-force version."""

import math
import random
import re
import string
from collections import Counter

import pytest

from silverlode.llm import search
from silverlode.llm.common import importable

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture
def sp(spark):
    importable(spark)
    return spark


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = Counter()
    for item, text in items:
        scores = []
        for i, b, n in bags:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if b[t])
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        for rank, (s, has, i) in enumerate(sorted(scores)[:10], 1):
            out[item, rank, i if has else None, -s] += 1
    return out


@pytest.fixture(scope="module")
def corpus():
    """Words of Zipf frequencies, groups of near copies, ties, NULLs, empty and very long texts."""
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(400)] + ["Été", "漢字", "x1"]
    pick = lambda n: rnd.choices(words, [1 / (i + 1) for i in range(len(words))], k=n)
    docs = [(i, " ".join(pick(rnd.randint(1, 60)))) for i in range(700)]
    base = pick(40)
    docs += [(1000 + i, ". ".join(w if rnd.random() > 0.05 else "odd" for w in base)) for i in range(150)]
    docs += [(2000 + i, "the same Text, w7-w9 again") for i in range(40)]
    docs += [(5, docs[5][1]), (5, "w3 w399"), (None, "the same text w7 w9 again"), (None, None), (8, ""), (9, " .\n"), (3000, "w2 " * 20_000 + "w398")]
    items = [(i, " ".join(pick(rnd.randint(1, 30)))) for i in range(40)]
    items += [(40, "The SAME text w7"), (41, " ".join(base)), (42, None), (43, ""), (44, "nowhere"), (0, "w1"), (0, "w1"), (None, "w5 w7"), (45, "été 漢字 w398")]
    return docs, items


@pytest.mark.parametrize(("shard", "block", "item_terms", "bits"), [(1 << 18, 48, 1 << 18, 23), (500, 4, 50, 7), (3, 1, 1, 6)])
def test_ranks_equal_brute_force(sp, corpus, monkeypatch, shard, block, item_terms, bits):
    """Also in many tiny shards and blocks, items one by one, and with a filter that lets all through."""
    docs, items = corpus
    items = items if item_terms > 1 else items[36:]
    for name, v in (("SHARD", shard), ("BLOCK", block), ("ITEM_TERMS", item_terms if item_terms > 1 else 20), ("FILTER_BITS", bits)):
        monkeypatch.setattr(search, name, v)
    d = sp.createDataFrame([(*r, "k", 1) for r in docs], "doc_id long, text string, item_id string, n int").repartition(3)
    q = sp.createDataFrame([(*r, 2) for r in items], "item_id long, text string, doc_id int")
    assert Counter(map(tuple, search.ranked(d, q).collect())) == brute(docs, items)


def test_blocks_are_skipped_by_exact_bounds(corpus):
    """No bound is below a score, and searching scores fewer documents than the lists hold."""
    import numpy as np

    docs, items = corpus
    bags = [Counter(terms(t)) for _, t in docs if terms(t)]
    words = sorted({w for b in bags for w in b})
    number = {w: i for i, w in enumerate(words)}
    edges = np.cumsum([0] + [len(b) for b in bags])
    flat = np.array([number[w] for b in bags for w in sorted(b)])
    tfs = np.array([b[w] for b in bags for w in sorted(b)])
    weights = np.arange(len(words), dtype=np.int64) * 37 % 9000 + 1
    axes = np.random.default_rng(7).standard_normal((len(words), search.DIMENSIONS), np.float32)
    shard = search.Shard(edges, flat, tfs, np.full(len(bags), 100), axes, weights)
    scored = 0
    count = shard.scores
    for _, text in items[:40]:
        asked = np.array(sorted({number[t] for t in terms(text)}))
        w = np.zeros(len(words), np.int64)
        w[asked] = weights[asked]
        for t in asked:
            blocks = shard.list_blocks(int(t))
            bounds = blocks.bounds(asked, weights[asked])
            for i in range(blocks.count):
                assert count(blocks.docs[blocks.edges[i] : blocks.edges[i + 1]], w).max() <= bounds[i]
        shard.scores = lambda d, w: (sizes.append(len(d)), count(d, w))[1]
        sizes = []
        best = search.Best().of_shard(np.arange(len(bags)), np.ones(len(bags), bool))
        shard.search(asked, best, np.zeros(len(words), np.int64))
        scored += sum(sizes)
        every = count(np.arange(len(bags)), w)
        assert sorted(best.score, reverse=True) == sorted(every[every > 0], reverse=True)[:10]
    lists = sum(len({i for i, b in enumerate(bags) for t in set(terms(text)) if t in b}) for _, text in items[:40])
    assert scored < lists


def test_empty_tables(sp):
    docs = sp.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = sp.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.ranked(docs.limit(0), items).count() == search.ranked(docs, items.limit(0)).count() == 0
    assert search.ranked(docs, items).count() == 1
