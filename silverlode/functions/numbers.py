"""Numeric helpers: division guards and rounding that does not depend on binary ties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double; NULL when ``b`` is 0 or either side is NULL."""
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def round_to(c: Column, places: int) -> Column:
    """Half-up rounding in decimal arithmetic, returned as double."""
    return F.round(c.cast("decimal(38,12)"), places).cast("double")


def bands(c: Column, cuts: list[tuple[float, str]], last: str) -> Column:
    """First band whose upper bound (inclusive) holds ``c``; NULL goes to the ``last`` band."""
    out = None
    for upper, label in cuts:
        test = c <= F.lit(upper)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return F.lit(last) if out is None else out.otherwise(F.lit(last))


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))
