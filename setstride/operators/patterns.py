"""Pattern features of one step, from its own sorted item array; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.config import DRAWS, LOOKBACK, Domain
from setstride.operators.layout import SERIES, StepTable, by_block, halo_window, spread

PATTERNS = [
    "white_sum", "white_mean", "odd_count", "even_count", "low_count", "high_count",
    "consecutive_pairs", "number_range", "unique_last_digits", "mega_is_odd",
]
ROLLED = ["white_sum", "odd_count", "low_count", "number_range"]


def item_sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda acc, x: acc + x)


def consecutive(items: Column) -> Column:
    """Adjacent items (in order) that differ by one."""
    pairs = F.zip_with(F.slice(items, 1, F.size(items) - 1), F.slice(items, 2, F.size(items)), lambda a, b: b - a)
    return F.size(F.filter(pairs, lambda d: d == 1))


def patterns(items: Column | str = "items", special: Column | str = "special", domain: Domain = DRAWS) -> dict[str, Column]:
    items = F.col(items) if isinstance(items, str) else items
    special = F.col(special) if isinstance(special, str) else special
    n = F.size(items)
    odd = F.size(F.filter(items, lambda x: x % 2 == 1))
    low = F.size(F.filter(items, lambda x: x <= domain.low_max))
    return {
        "white_sum": item_sum(items),
        "white_mean": F.round(item_sum(items) / n, 2),
        "odd_count": odd,
        "even_count": n - odd,
        "low_count": low,
        "high_count": n - low,
        "consecutive_pairs": consecutive(items),
        "number_range": F.array_max(items) - F.array_min(items),
        "unique_last_digits": F.size(F.array_distinct(F.transform(items, lambda x: x % 10))),
        "mega_is_odd": (special % 2 == 1).cast("int"),
    }


def draw_features(steps: DataFrame, domain: Domain = DRAWS) -> DataFrame:
    """draw_number and the ten pattern columns."""
    return steps.select(F.col("step_id").alias("draw_number"), *[c.alias(n) for n, c in patterns(domain=domain).items()])


def rolling_features(table: StepTable, window: int = LOOKBACK, include_current: bool = False) -> DataFrame:
    """Mean and sample deviation of four pattern columns over `window` steps, null until they are full.

    The frame ends before the step; `include_current` moves it to end at the step itself.
    """
    keep = [SERIES, "ord", "step_id", "ts", "items", "special"]
    base = table.df.select(*keep)
    rows = by_block(spread(base, table.block, window), table.rows)
    cols = patterns(domain=table.domain)
    rows = rows.select(*keep, "block", "own", *[cols[c].alias(c) for c in ROLLED])
    w = halo_window().rowsBetween(1 - window, 0) if include_current else halo_window().rowsBetween(-window, -1)
    full = F.col("ord") >= (window - 1 if include_current else window)
    rolled = [
        F.when(full, f(c).over(w)).alias(f"{c}_roll{window}_{name}")
        for c in ROLLED
        for name, f in (("mean", F.avg), ("std", F.stddev_samp))
    ]
    return rows.select(*keep, "block", "own", *rolled).where("own").drop("own", "block")


def last_step_features(items: Column, domain: Domain = DRAWS) -> dict[str, Column]:
    """Summary of the previous step, the same for every candidate."""
    return {
        "last_sum": item_sum(items),
        "last_odd_cnt": F.size(F.filter(items, lambda x: x % 2 == 1)),
        "last_high_cnt": F.size(F.filter(items, lambda x: x > domain.low_max)),
        "last_consec": consecutive(items),
    }


def sequence_windows(table: StepTable, length: int = 20) -> DataFrame:
    """Each step with the item sets of the `length` steps before it (only where all of them exist)."""
    rows = by_block(spread(table.df.select(SERIES, "ord", "step_id", "items"), table.block, length), table.rows)
    w = halo_window().rowsBetween(-length, -1)
    return rows.select(SERIES, "ord", "step_id", "items", "own", F.collect_list("items").over(w).alias("past")).where(
        F.col("own") & (F.size("past") == length)
    ).drop("own")
