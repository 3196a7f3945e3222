"""Column functions for cleaning text, amounts and dates. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accent pairs folded by the cleaning rules.
ACCENTED = "áéíóúãõâêîôûç"
PLAIN = "aeiouaoaeiouc"


def fold(c: Column) -> Column:
    """Lower case without accents; lower-casing first so capital accents fold too."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def tidy(c: Column) -> Column:
    """Collapse inner whitespace runs and trim."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def title(c: Column) -> Column:
    """Trim and capitalise the first letter of each space-separated word."""
    return F.initcap(F.trim(c))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def compact_email(c: Column) -> Column:
    """Lower-case e-mail with every blank removed."""
    return F.lower(F.replace(F.trim(c), F.lit(" "), F.lit("")))


def money(c: Column, keep_sign: bool = False, decimal_comma: bool = False) -> Column:
    """Parse an amount to decimal(12,2); text without digits becomes NULL.

    The default drops every character but digits and points, as the source data
    expects. ``decimal_comma`` reads ``1.234,56``; ``keep_sign`` keeps a minus.
    """
    if decimal_comma:
        c = F.translate(F.replace(c, F.lit("."), F.lit("")), ",", ".")
    bare = F.regexp_replace(c, "[^0-9.-]" if keep_sign else "[^0-9.]", "")
    return bare.try_cast("decimal(12,2)")


def multi_date(c: Column, formats: Sequence[str], default: str | None = None) -> Column:
    """First format that parses wins; otherwise ``default`` (or NULL)."""
    parsed = [F.try_to_date(c, f) for f in formats]
    if default is not None:
        parsed.append(F.lit(default).cast("date"))
    return F.coalesce(*parsed)


def recode(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """Many-to-one recode of a folded, trimmed label through a literal lookup.

    The lookup is part of the expression, so no join or broadcast is planned;
    it is meant for mappings of a few dozen rows.
    """
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), F.trim(fold(c)))
    return found if default is None else F.coalesce(found, F.lit(default))
