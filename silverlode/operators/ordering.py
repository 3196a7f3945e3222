"""Global order and exact quantiles without gathering rows in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_ROW_BITS = (1 << 33) - 1


def global_row_number(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` for tables of any size.

    ``order`` must be a total order. A plain window would pull every row into one
    task; here Spark's range sort places the rows, each partition numbers its own,
    and the partition totals (one row per partition) become offsets.
    """
    placed = stage(df.sort(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", 33)
    totals = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(offsets, "_part")
    position = F.col("_before") + F.col("_at").bitwiseAND(F.lit(_ROW_BITS)) + 1
    return numbered.withColumn(out, position.cast("bigint")).drop("_part", "_before", "_at")


def order_cuts(df: DataFrame, col: str, parts: int) -> list:
    """At most ``parts - 1`` cut points that split ``col`` into near-equal ranges."""
    if parts <= 1:
        return []
    grid = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(col, grid, 10 * parts).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def range_bucket(c: Column, cuts: list) -> Column:
    """Number of the range ``c`` falls in: 0 up to the first cut, and so on.

    Many cuts are searched in two steps (block, then cut within the block) so a
    thousand ranges cost about sixty comparisons per row.
    """
    if not cuts:
        return F.lit(0)

    def passed(options: Column) -> Column:
        return F.size(F.filter(options, lambda cut: cut < c))

    width = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    block_no = passed(F.array(*[F.lit(b[-1]) for b in blocks]))
    nested = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    inside = F.coalesce(passed(F.get(nested, block_no)), F.lit(0))
    return F.least(block_no * width + inside, F.lit(len(cuts)))  # the last block may be short


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of several numeric columns, as plain numbers.

    Each pass brackets every rank between two ``percentile_approx`` values and counts
    exactly how many rows lie before, on and between them, until each rank's value is
    known. A pass is two scans with partial aggregation for all columns together, moves a
    handful of numbers and shrinks the brackets at least a hundredfold; the first one also
    counts the values. NULL and NaN are no values; infinities are. A column without values
    has NULL quantiles.
    """
    asked = [(c, probs) for c, probs in wanted.items() if len(probs)]
    values = df.select(
        *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}") for i, (c, _) in enumerate(asked)]
    )
    found: dict[str, list[float | None]] = {c: [] for c in wanted}
    if not asked:
        return found
    row = values.agg(
        *[F.count(f"x{i}").alias(f"n{i}") for i in range(len(asked))],
        *[_sketch(F.col(f"x{i}"), [(p, p) for p in probs]).alias(f"q{i}") for i, (_, probs) in enumerate(asked)],
    ).first()
    searched: dict[_Rank, _Bracket] = {}
    guesses: dict[_Rank, tuple[float, float]] = {}
    for i, (_, probs) in enumerate(asked):
        n = row[f"n{i}"]
        for j, p in enumerate(probs if n else ()):
            for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1))):
                searched[i, r] = _Bracket(-math.inf, math.inf, 0, n)
                guesses[i, r] = (row[f"q{i}"][2 * j], row[f"q{i}"][2 * j + 1])
    at: dict[_Rank, float] = {}
    while searched:
        _narrow(values, searched, guesses, at)
        searched = {r: b for r, b in searched.items() if r not in at}
        guesses = _guess(values, searched) if searched else {}

    def quantile(i: int, spot: float) -> float:
        low, high = at[i, math.floor(spot)], at[i, math.ceil(spot)]
        return low if low == high else low + (high - low) * (spot - math.floor(spot))

    for i, (c, probs) in enumerate(asked):
        n = row[f"n{i}"]
        found[c] = [quantile(i, p * (n - 1)) if n else None for p in probs]
    return found


#: Number of a column and a rank among its values.
_Rank = tuple[int, int]


class _Bracket(NamedTuple):
    """Closed value range known to hold a rank, rows before it and rows in it."""

    low: float
    high: float
    before: int
    rows: int

    def holds(self, x: Column) -> Column:
        return x.between(F.lit(self.low), F.lit(self.high))


def _narrow(
    values: DataFrame, searched: dict[_Rank, _Bracket], guesses: dict[_Rank, tuple[float, float]], at: dict[_Rank, float]
) -> None:
    """One scan: a tighter bracket for every rank, or its value in ``at``."""
    # neighbouring ranks mostly share their guesses
    pairs = list(dict.fromkeys((i, *guess) for (i, _), guess in guesses.items()))

    def parts(i: int, lo: float, hi: float) -> Column:
        x = F.col(f"x{i}")
        tests = (x < lo, x == lo, (x > lo) & (x < hi), (x == hi) & (x > lo))
        return F.array(*map(F.count_if, tests))

    counted = values.agg(*[parts(*pair).alias(str(k)) for k, pair in enumerate(pairs)]).first()
    for (i, r), (lo, hi) in guesses.items():
        old = searched[i, r]
        below, on_low, between, on_high = counted[str(pairs.index((i, lo, hi)))]
        inner, upper = below + on_low, below + on_low + between
        if r < below:
            searched[i, r] = _Bracket(old.low, math.nextafter(lo, -math.inf), old.before, below - old.before)
        elif r < inner:
            at[i, r] = lo
        elif r < upper:
            searched[i, r] = _Bracket(math.nextafter(lo, math.inf), math.nextafter(hi, -math.inf), inner, between)
        elif r < upper + on_high:
            at[i, r] = hi
        else:
            passed = upper + on_high
            searched[i, r] = _Bracket(math.nextafter(hi, math.inf), old.high, passed, old.before + old.rows - passed)


def _sketch(x: Column, around: Sequence[tuple[float, float]]) -> Column:
    """Approximate values a little before and after each pair of shares."""
    margin = 0.002
    return F.percentile_approx(x, [min(1.0, max(0.0, p)) for a, b in around for p in (a - margin, b + margin)], 2000)


def _guess(values: DataFrame, searched: dict[_Rank, _Bracket]) -> dict[_Rank, tuple[float, float]]:
    """Approximate values around each rank; one sketch per bracket."""
    by_bracket: dict[tuple[int, _Bracket], list[int]] = {}
    for (i, r), b in searched.items():
        by_bracket.setdefault((i, b), []).append(r)
    row = values.agg(
        *[
            _sketch(F.when(b.holds(F.col(f"x{i}")), F.col(f"x{i}")), [((r - b.before) / b.rows, (r + 1 - b.before) / b.rows) for r in ranks]).alias(str(k))
            for k, ((i, b), ranks) in enumerate(by_bracket.items())
        ]
    ).first()
    return {
        (i, r): (row[str(k)][2 * j], row[str(k)][2 * j + 1])
        for k, ((i, _), ranks) in enumerate(by_bracket.items())
        for j, r in enumerate(ranks)
    }
