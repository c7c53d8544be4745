"""Name distances and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance of two names, ignoring case; null when a name is null."""
    return F.levenshtein(F.lower(a), F.lower(b))


def names_alike(a: Column, b: Column, max_difference: int) -> Column:
    """True when at most ``max_difference`` edits turn one name into the other.

    The bounded form of the distance stops early and yields -1 beyond the bound.
    """
    return F.levenshtein(F.lower(a), F.lower(b), max_difference) >= 0


def label(*parts: Column) -> Column:
    """``category-id`` style label."""
    return F.concat_ws("-", *parts)
