"""Row-level building blocks over item arrays and score vectors (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from setstride.config import PRIZES


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it in `body`.

    An expression captured by a lambda is evaluated again for every element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def multihot(items: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(size)), lambda n: F.array_contains(items, n).cast("int"))


def array_total(values: Column, kind: str = "double") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda acc, x: acc + x)


def joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), " ")


def ranked_items(score: Column) -> Column:
    """Items 1..n in order of score descending, item ascending on ties."""
    pairs = F.transform(score, lambda s, i: F.struct((-s).alias("down"), (i + 1).alias("item")))
    return F.transform(F.sort_array(pairs), lambda p: p["item"])


def first_best(score: Column) -> Column:
    """1-based position of the largest score, the lowest position on ties."""
    return F.array_position(score, F.array_max(score)).cast("int")


def hits(picks: Column, actual: Column, k: int = 5) -> Column:
    return F.size(F.array_intersect(F.slice(picks, 1, k), actual))


def not_among(items: Column, size: int) -> Column:
    """The items of 1..size that are not listed, in order."""
    return F.array_except(F.sequence(F.lit(1), F.lit(size)), items)


def mean_rank(ranked: Column, actual: Column) -> Column:
    """Mean 1-based rank of the items that came up."""
    total = let(
        ranked, lambda r: F.aggregate(actual, F.lit(0).cast("double"), lambda acc, a: acc + F.array_position(r, a))
    )
    return F.try_divide(total, F.size(actual))


def prize(hit_count: Column, special_hit: Column) -> Column:
    """Payoff of a ticket."""
    pairs = [F.lit(v) for (h, s), amount in PRIZES.items() for v in (2 * h + int(s), amount)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), 2 * hit_count + special_hit.cast("int")), F.lit(0.0))


def expected_prize(hit_count: Column, specials: int) -> Column:
    """Payoff when no special is predicted: one chance in `specials` to meet it."""
    return (
        prize(hit_count, F.lit(True)) / F.lit(float(specials))
        + prize(hit_count, F.lit(False)) * (1.0 - 1.0 / specials)
    )
