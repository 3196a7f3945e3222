"""The class model against counts and probabilities worked out one by one."""

import math
import random
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from silverlode.llm import classes
from silverlode.llm.common import importable

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string, block long, n int, code string"


@pytest.fixture
def sp(spark):
    importable(spark)
    return spark


@pytest.fixture(scope="module")
def rows():
    """Two languages with grammars of their own, NULLs, repeats, an unspaced and a long text."""
    rnd = random.Random(2)
    kinds = [[[f"{p}{k}{i}" for i in range(40)] for k in "nva"] for p in ("x", "y")]
    out = []
    for i in range(400):
        kind = kinds[rnd.random() < 0.4]
        text = " ".join(rnd.choices(kind[j % 3], [1 / (r + 1) for r in range(40)])[0] for j in range(rnd.randint(3, 30)))
        out.append((i, text.capitalize() + rnd.choice([".", "", " odd%d" % i])))
    out += [(5, out[5][1]), (500, None), (501, ""), (502, " \t\n"), (None, "xn1 xv1 ünïque word"), (503, "a" * 50_000), (504, "xn0 xv0 xa0 " * 5_000)]
    return [(*r, 9, 9, "k") for r in out]


def tokens(text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    return [w.translate(LOWER) for w in text.split(" ") if w] + [None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


@pytest.mark.parametrize("block", [2_000_000, 700])
def test_scores_equal_the_definition(sp, rows, monkeypatch, block):
    monkeypatch.setattr(classes, "BLOCK", block)
    monkeypatch.setattr(classes, "PASSES", 3)
    df = sp.createDataFrame(rows, SCHEMA).repartition(2)
    train = [tokens(t) for i, t, *_ in rows if not held(i)]
    count = Counter(w for x in train for w in x)
    total = sum(count.values())

    # the classes as learned, everything else again from the texts
    d = df.selectExpr("doc_id", "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 10 = 0, false) as held_out", "text")
    from silverlode.session import stage

    blocks = stage(classes.in_blocks(d), "blocks")
    counts = stage(classes.word_counts(blocks), "counts")
    model, history = classes.learned(blocks, counts)
    assert max(history) > history[0] and len(history) == 4

    def class_of(w):
        if w is None:
            return 0
        raw = w.encode()
        return int(model.classes[model.units.of(np.array([classes.word_id(raw)]), np.array([classes.ending(raw)]))[0]])

    of = {w: class_of(w) for w in count}
    assert [w for w, c in of.items() if c == 0] == [None]
    size, known, pairs = Counter(), Counter(), Counter()
    for w, n in count.items():
        size[of[w]] += n
        known[of[w]] += 1
    for x in train:
        for a, b in zip([None, *x], x):
            pairs[of[a], of[b]] += 1
    assert list(model.sizes) == [size[c] for c in range(classes.CLASSES)]
    before = Counter()
    for (a, _), n in pairs.items():
        before[a] += n
    seen = Counter(count.values())
    discount = min(0.9, max(0.1, seen[1] / (seen[1] + 2 * seen[2])))

    def follows(a, b):
        share = (size[b] + 1) / (total + classes.CLASSES)
        return (pairs[a, b] + classes.SHRINK * share) / (before[a] + classes.SHRINK)

    def word(w, c):
        if c == 0:
            return 1.0
        return ((count[w] - discount) if w in count else (discount * known[c] + 1)) / (size[c] + 1)

    for c in range(1, classes.CLASSES):  # a distribution in every class, and over the next class
        assert math.isclose(sum(word(w, c) for w in of if of[w] == c) + word("never", c), 1)
        assert math.isclose(sum(follows(c, b) for b in range(classes.CLASSES)), 1)
    want = Counter()
    for i, t, *_ in rows:
        x = tokens(t)
        cs = [0, *map(class_of, x)]
        plain = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in x)
        full = sum(math.log10(follows(a, b)) + math.log10(word(w, b)) for w, a, b in zip(x, cs, cs[1:]))
        want[i, held(i), len(x), sum(w in count for w in x), total, f"{plain:.6g}", f"{full:.6g}"] += 1
    got = Counter((*r[:5], f"{r[5]:.6g}", f"{r[6]:.6g}") for r in classes.class_scores(df).collect())
    assert got == want


def test_held_out_texts_are_likelier_than_under_the_plain_model(sp, rows):
    out = [r for r in classes.class_scores(sp.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert len(out) > 20
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 0.2 * sum(r.n_tokens for r in out)


def test_exchange_gains_what_it_says():
    """Each move's gain is that of the whole likelihood, and no other class would have given more."""
    rnd = np.random.default_rng(4)
    n = 30
    pairs = rnd.poisson(0.7, (n, n))
    start = np.r_[0, 1 + np.arange(n - 1) % 5]

    def matrix(of):
        m = np.zeros((classes.CLASSES, classes.CLASSES), np.int64)
        np.add.at(m, (np.repeat(of, n), np.tile(of, n)), pairs.ravel())
        return m

    pairs[0], pairs[:, 0] = 1, 1
    np.fill_diagonal(pairs, rnd.poisson(1, n))
    # rows and columns have equal sums where texts run on: make them so by a cycle
    for u in range(n - 1):
        gap = pairs[u].sum() - pairs[:, u].sum()
        pairs[n - 1 if gap > 0 else u, u if gap > 0 else n - 1] += abs(gap)
    for u in range(1, n):
        after, before = (np.bincount(start, x, classes.CLASSES).astype(np.int64) for x in (pairs[u], pairs[:, u]))
        ((_, moved),) = classes.exchanged([(u, after, before, int(pairs[u, u]))], start, matrix(start))
        tries = []
        for c in range(1, 8):
            of = start.copy()
            of[u] = c
            tries.append(classes.likelihood(matrix(of)))
        of = start.copy()
        of[u] = moved
        assert classes.likelihood(matrix(of)) >= max(tries) - 1e-6


def test_nothing_to_learn_from(sp):
    empty = sp.createDataFrame([], SCHEMA)
    assert classes.class_scores(empty).count() == 0
    only = [i for i in range(60) if held(i)]
    out = classes.class_scores(sp.createDataFrame([(i, "some words", 1, 1, "x") for i in only], SCHEMA)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in out} == {(3, 0, 0)}
    assert all(math.isclose(r.base_score, 0) and math.isfinite(r.score) for r in out)


def test_only_sums_and_rare_words_move(sp, rows, monkeypatch):
    """Texts stay where their block is, whose scores are added up in slices of documents."""
    assert [(s.start, s.stop) for s in classes.sliced(np.array([3, 1, 9, 2, 2, 2]), 4)] == [(0, 2), (2, 3), (3, 5), (5, 6)]
    monkeypatch.setattr(classes, "PASSES", 1)
    monkeypatch.setattr(classes, "SHARE", 1e-2)
    df = sp.createDataFrame(rows, SCHEMA).repartition(2)
    got = []
    for size in (200_000, 7):
        monkeypatch.setattr(classes, "SLICE", size)
        out = classes.class_scores(df)
        (line,) = [x for x in out._jdf.queryExecution().analyzed().toString().splitlines() if "FlatMapCoGroupsInArrow" in x]
        assert "rare#" in line and "codes#" not in line and "words#" not in line
        got.append(Counter((*r[:5], f"{r[5]:.6g}", f"{r[6]:.6g}") for r in out.collect()))
    assert got[0] == got[1]
