"""Quality by a sparse rule ensemble over text statistics (after Friedman & Popescu 2008).

A forest of shallow trees is grown on labelled statistics. Every path from a root is a
conjunction of thresholds; a logistic regression with an L1 penalty gives each such rule
a weight and most of them none. The rules that keep a weight are compiled into one Spark
column expression, so scoring a corpus runs no model code.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import bounded_sample, picked, texts_of
from silverlode.session import stage

#: Labelled rows the model is fitted on at most, chosen by a hash of the id.
FIT_ROWS = 20_000
TREES, DEPTH, SEED = 12, 3, 7
#: Weight of the L1 penalty.
LASSO = 0.002
THRESHOLD = 0.3

STATISTICS = (
    "chars", "words", "word_length", "upper", "digits", "marks", "blanks", "other_bytes",
    "distinct_words", "same_as_before", "distinct_lines", "line_words", "marked_words",
)

_kind = np.zeros(256, np.int64)
_kind[ord("a") : ord("z") + 1] = 1
_kind[ord("A") : ord("Z") + 1] = 2
_kind[ord("0") : ord("9") + 1] = 3
_kind[list(b" \t\n\r\x0b\x0c")] = 4
_kind[128:] = 5
END_MARKS = frozenset("#$%&*!|<>=~^_+@/\\{}[]")


def measured(text: str) -> tuple[float, ...]:
    """The statistics of a whole text; all zero for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return (0.0,) * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    marks, lower, upper, digits, blanks, other = np.bincount(_kind, counts, 6)
    n = len(raw)
    words = text.split()
    m = max(1, len(words))
    lines = text.split("\n")
    return (
        float(len(text)), float(len(words)), len(text) / m, upper / max(1.0, upper + lower), digits / n, marks / n, blanks / n, other / n,
        len(set(words)) / m, sum(a == b for a, b in zip(words, words[1:])) / m, len(set(lines)) / len(lines), len(words) / len(lines),
        sum(w[-1] in END_MARKS for w in words) / m,
    )


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, STATISTICS...) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                columns = zip(*map(measured, texts_of(b)), strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.float64()) for c in columns)], ["doc_id", *STATISTICS])

    return picked(df, doc_id=key, text=text).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it at most, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, value in self.tests:
            out = out & ((F.col(name) <= value) if at_most else (F.col(name) > value))
        return out.cast("double")


def rules_of(forest_text: str) -> list[Rule]:
    """Every path, whole or cut short, of the printed trees; each conjunction once."""
    found: dict[Rule, None] = {}
    path: list[tuple[str, bool, float]] = []
    for line in forest_text.splitlines():
        m = re.match(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)", line)
        if not m:
            if line.strip().startswith("Tree"):
                path, base = [], None
            continue
        indent = len(m[1])
        base = indent if base is None else base
        path = path[: indent - base] + [(STATISTICS[int(m[3])], m[4] == "<=", float(m[5]))]
        tight: dict[tuple[str, bool], float] = {}
        for name, at_most, value in path:  # of two bounds on one side the tighter one holds
            old = tight.get((name, at_most), value)
            tight[name, at_most] = min(old, value) if at_most else max(old, value)
        found[Rule(tuple(sorted((n, a, v) for (n, a), v in tight.items())))] = None
    return list(found)


@dataclass(frozen=True)
class RuleModel:
    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 over the statistics' columns."""
        total = F.lit(self.bias)
        for rule, weight in self.weights:
            total = total + rule.column() * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(rows: DataFrame) -> RuleModel:
    """Model of (STATISTICS..., label), a bounded table. Without rows every text scores one half, with one label its smoothed share."""
    ones, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    if ones in (0, n):
        return RuleModel(math.log((ones + 1) / (n - ones + 1)), ())
    vectors = rows.select(array_to_vector(F.array(*STATISTICS)).alias("features"), "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="all", subsamplingRate=0.6).fit(vectors)
    rules = rules_of(forest.toDebugString)
    if not rules:
        return RuleModel(math.log((ones + 1) / (n - ones + 1)), ())
    fired = rows.select(array_to_vector(F.array(*[r.column() for r in rules])).alias("features"), "label")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(fired)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if abs(w) > 1e-9]
    return RuleModel(float(lasso.intercept), tuple(weights))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Labels are learned from rows that are not held out. NULL texts count as empty, rows
    with a NULL id or label teach nothing, a NULL id is not held out. A label outside 0
    and 1 teaches nothing. Repeated rows stay, and repeated labels count as often as they stand.
    """
    stats = stage(statistics(docs, key, text), "statistics")
    known = picked(labels, doc_id=key, label=label).where("label in (0, 1) and doc_id is not null")
    taught = stats.join(known, "doc_id").where(~held_out())
    few = bounded_sample(taught, F.xxhash64("doc_id"), FIT_ROWS)
    model = fit(stage(few.select(*STATISTICS, F.col("label").cast("double").alias("label")), "fit-rows"))
    out = stats.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
