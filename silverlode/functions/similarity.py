"""String similarity in [0, 1] from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(c: Column) -> Column:
    """Distinct three-character pieces of ``c`` behind two leading blanks.

    The padding gives the first letters extra weight and makes every non-empty
    string, even a single letter, own at least one piece. ``c`` is bound to a variable:
    inside a lambda an expression would be computed again for every piece.
    """

    def pieces(padded: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(padded) - 2)
        return F.when(F.length(padded) > 2, F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(3)))))

    return F.element_at(F.transform(F.array(F.concat(F.lit("  "), c)), pieces), 1)


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two distinct arrays; NULL if either is NULL."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def similarity(a: Column, b: Column) -> Column:
    """Trigram similarity of two strings."""
    return jaccard(trigrams(a), trigrams(b))


def edit_similarity(a: Column, b: Column) -> Column:
    """``1 - levenshtein / longer length``; NULL when both are empty."""
    longest = F.nullif(F.greatest(F.length(a), F.length(b)), F.lit(0))
    return F.lit(1.0) - F.levenshtein(a, b) / longest


def email_user(c: Column) -> Column:
    """Part before the ``@`` without separators, so ``a_b`` and ``a.b`` agree."""
    return F.regexp_replace(F.substring_index(c, "@", 1), "[^a-z0-9]", "")


def email_whole(c: Column) -> Column:
    """The e-mail as one string, its user part without separators."""
    return F.concat(email_user(c), F.coalesce(F.concat(F.lit("@"), email_domain(c)), F.lit("")))


def email_domain(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("@")), F.substring_index(c, "@", -1))
