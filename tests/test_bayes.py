import math
from collections import Counter
from hashlib import md5

import pytest

from silverlode.operators import bayes

ROWS = [
    (1, "good good film", "pos"), (2, "Good story, fine end", "pos"), (3, "bad film", "neg"),
    (4, "bad bad END", "neg"), (5, "no label", None), (6, None, "pos"), (7, "", "neg"), (8, "good good film", "pos"),
]


def by_hand(rows, text, buckets):
    place = lambda w: int(md5(w.encode()).hexdigest()[:7], 16) % buckets
    cut = lambda t: [w for w in "".join(c.lower() if c.isalpha() else " " for c in t or "").split()]
    labelled = [(cut(t), c) for _, t, c in rows if c]
    scores = {}
    for c in sorted({c for _, c in labelled}):
        seen = Counter(place(w) for ws, k in labelled if k == c for w in ws)
        prior = sum(k == c for _, k in labelled) / len(labelled)
        scores[c] = math.log(prior) + sum(math.log((seen[place(w)] + 1) / (sum(seen.values()) + buckets)) for w in cut(text))
    whole = sum(map(math.exp, scores.values()))
    return max(scores, key=scores.get), {c: math.exp(s) / whole for c, s in scores.items()}


@pytest.mark.parametrize("buckets", [3, 1 << 14])
def test_equals_counting_by_hand(spark, buckets):
    df = spark.createDataFrame(ROWS, "id long, text string, label string")
    model = bayes.naive_bayes(df, "text", "label", buckets)
    assert model.classes == ["neg", "pos"] and model.weights.count() == buckets
    new = ROWS + [(9, "unseen words only", None), (10, "bad end of a good film " * 200, None)]
    got = {r["id"]: r for r in model.classify(spark.createDataFrame(new, df.schema), "id", "text").collect()}
    assert len(got) == len(new)
    for i, text, _ in new:
        best, shares = by_hand(ROWS, text, buckets) if len(text or "") < 1000 else (None, None)
        if best:
            assert got[i]["classe"] == best
            assert got[i]["p"] == pytest.approx([shares["neg"], shares["pos"]], abs=1e-4)
        assert sum(got[i]["p"]) == pytest.approx(1)


def test_one_class_ties_and_no_labels(spark):
    rows = "id long, text string, label int"
    one = bayes.naive_bayes(spark.createDataFrame([(1, "a b", 7)], rows), "text", "label", 8)
    assert [tuple(r) for r in one.classify(spark.createDataFrame([(1, "c", None)], rows), "id", "text").collect()] == [(1, 7, [1.0])]
    tie = bayes.naive_bayes(spark.createDataFrame([(1, "same", 2), (2, "same", 1)], rows), "text", "label", 8)
    assert [r["classe"] for r in tie.classify(spark.createDataFrame([(1, "same", None)], rows), "id", "text").collect()] == [1]
    assert tie.classify(spark.createDataFrame([], rows), "id", "text").count() == 0
    with pytest.raises(ValueError):
        bayes.naive_bayes(spark.createDataFrame([(1, "a", None)], rows), "text", "label")
