"""Population drift: band shares, stability index, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import bands, ratio, round_to
from .ordering import exact_quantiles
from .profile import stack_rows
from .windows import shares

# Score bands and the limits of the drift status.
SCORE_BANDS = [(500.0, "300-500"), (650.0, "501-650"), (800.0, "651-800")]
SCORE_LAST = "801-900"
ALERT_LIMIT, WARN_LIMIT = 0.25, 0.10
FLOOR = 0.001


def score_band(c: Column) -> Column:
    return bands(c, SCORE_BANDS, SCORE_LAST)


def quartile_band(c: Column, cuts: Sequence[float]) -> Column:
    return bands(c, [(cut, f"q{i}") for i, cut in enumerate(cuts, 1)], f"q{len(cuts) + 1}")


def band_proportions(df: DataFrame, band: Column) -> DataFrame:
    """Share of rows per band; only the handful of band totals is divided."""
    counts = df.select(band.alias("faixa")).groupBy("faixa").agg(F.count(F.lit(1)).alias("_n"))
    return shares(counts, "_n", "pct").drop("_n")


def band_pairs(reference: DataFrame, new: DataFrame, band: Column, how: str = "left") -> DataFrame:
    """Shares side by side. ``left`` keeps the reference's bands, ``full`` every band."""
    p = band_proportions(reference, band).withColumnRenamed("pct", "p")
    q = band_proportions(new, band).withColumnRenamed("pct", "q")
    zero = F.lit(0.0)
    return p.join(q, "faixa", how).select(
        "faixa", F.coalesce("p", zero).alias("p"), F.coalesce("q", zero).alias("q")
    )


def stability_index(pairs: DataFrame, floor: float = FLOOR) -> DataFrame:
    """``sum((p - q) * ln(p / q))`` over the bands, both shares floored."""
    p, q = F.greatest("p", F.lit(floor)), F.greatest("q", F.lit(floor))
    return pairs.agg(round_to(F.sum((p - q) * F.ln(p / q)), 3).alias("psi"))


def quartile_pairs(reference: DataFrame, new: DataFrame, col: str) -> DataFrame:
    """Band shares over the quartiles of the reference population only."""
    cuts = exact_quantiles(reference, {col: [0.25, 0.5, 0.75]})[col]
    return band_pairs(reference, new, quartile_band(F.col(col), cuts))


def drift_status(psi: DataFrame, feature: str) -> DataFrame:
    status = (
        F.when(F.col("psi") > ALERT_LIMIT, "ALERTA_RETREINAR").when(F.col("psi") > WARN_LIMIT, "ATENCAO").otherwise("OK")
    )
    return psi.select(F.lit(feature).alias("feature"), "psi", status.alias("status"))


def compare_populations(populations: dict[str, DataFrame], mean_cols: Sequence[str], median_cols: Sequence[str]) -> DataFrame:
    """Means and exact medians of each population, one row per population."""
    rows = {}
    for name, df in populations.items():
        medians = exact_quantiles(df, {c: [0.5] for c in median_cols})
        rows[name] = df.agg(
            *[
                round_to(ratio(F.sum(F.col(c).cast("decimal(30,4)")), F.count(c)), 2).alias(f"media_{c}")
                for c in mean_cols
            ]
        ).select("*", *[round_to(F.lit(medians[c][0]), 1).alias(f"mediana_{c}") for c in median_cols])
    return stack_rows(rows, "populacao")
