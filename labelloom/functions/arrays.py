"""Array columns."""
from __future__ import annotations

from pyspark.sql import Column, functions as F



def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def empty_strings() -> Column:
    return F.expr("cast(array() as array<string>)")


def or_empty(c: Column) -> Column:
    return F.coalesce(c, empty_strings())


def stable_distinct(c: Column) -> Column:
    """Distinct items in order of first appearance."""
    return F.array_distinct(c)


def keep_marked(c: Column, marker: str = ":") -> Column:
    """Items that contain the marker; a null array stays null."""
    return F.filter(c, lambda x: F.contains(x, F.lit(marker)))


def chunk_sequential(c: Column, n: int) -> Column:
    """Consecutive slices of ``n`` items; an empty array gives no slice."""
    starts = F.when(F.size(c) > 0, F.sequence(F.lit(0), F.floor((F.size(c) - 1) / n).cast("int")))
    return F.coalesce(F.transform(starts, lambda i: F.slice(c, i * n + 1, F.lit(n))),
                      F.expr("cast(array() as array<array<string>>)"))


def trimmed(c: Column) -> Column:
    from .text import strip
    return F.filter(F.transform(c, strip), lambda x: x != "")


def negatives_for(unused: Column, negs: Column, focus: Column, limit: int) -> Column:
    """Unused labels of the group first, then the sample's negatives; no focus label, no repeats."""
    pool = F.array_except(F.concat(unused, negs), focus)
    return F.slice(F.array_distinct(pool), 1, max(0, limit)) if limit > 0 else F.slice(pool, 1, 0)
