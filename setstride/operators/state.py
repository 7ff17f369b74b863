"""Per-item state strictly before each step: counts, last and first seen, rolling counts, gap spread.

The vocabulary is small and fixed, so the state of a step is one array with a slot per item (and per
special), kept beside the step: n rows are shuffled, not n x 47, and scoring stays inside the row.
For open vocabularies the `sparse_*` functions keep one row per (step, item) that occurred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from setstride.operators.kernels import slot_kernel, slot_totals_kernel
from setstride.operators.layout import SERIES, StepTable, block_of, by_block, halo_window, spread
from setstride.session import materialise

STEP_COLUMNS = ["step_id", "ts", "items", "special", "prev_items", "prev_special", "prev2_items"]


def slots_of(table: StepTable) -> Column:
    """0-based slots touched by a step: items first, the special after them."""
    width = table.domain.items
    items = F.transform("items", lambda n: n - 1)
    special = F.when(F.col("special").isNull(), F.array().cast("array<int>")).otherwise(
        F.array(F.col("special") + F.lit(width - 1))
    )
    return F.concat(items, special)


def in_span(df: DataFrame, table: StepTable, span: tuple[int, int] | None, back: int = 0) -> DataFrame:
    """Rows that any step of lo <= ord < hi needs inside its block (earlier blocks arrive as carry rows)."""
    if span is None:
        return df
    lo, hi = span
    start = lo // table.block * table.block - back
    return df.where((F.col("ord") >= start) & (F.col("ord") < hi))


def dense_prefix(totals: DataFrame, key: str, width: int, values: dict[str, str]) -> DataFrame:
    """Prefix state per (series, key) over blocks: totals of blocks <= b become the carry of block b + 1.

    `values` maps column -> how it accumulates (sum, max, min). Only per-block summaries pass through here;
    a block lists at most `width` entries, completed by blanks so that no key is missing from a block.
    """
    fields = [F.col(key).cast("int").alias(key), *values]
    blank = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda k: F.struct(k.alias(key), *[F.lit(None).cast("long").alias(v) for v in values]),
    )
    how = {"sum": F.sum, "max": F.max, "min": F.min}
    dense = (
        totals.groupBy(SERIES, "block")
        .agg(F.collect_list(F.struct(*fields)).alias("_e"))
        .select(SERIES, "block", F.explode(F.concat("_e", blank)).alias("_r"))
        .select(SERIES, "block", "_r.*")
        .groupBy(SERIES, "block", key)
        .agg(*[how[h](v).alias(v) for v, h in values.items()])
    )
    upto = Window.partitionBy(SERIES, key).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    return dense.select(
        SERIES, (F.col("block") + 1).alias("block"), key, *[how[h](v).over(upto).alias(f"_{v}") for v, h in values.items()]
    ).where(F.coalesce(*[F.col(f"_{v}") for v in values]).isNotNull())


def _carry(table: StepTable, width: int, back: int, span, gaps: bool) -> DataFrame:
    """One row per (block, slot): slot state summed over every step before the block's halo."""
    rows = table.df if span is None else table.df.where(F.col("ord") < span[1])
    steps = rows.select(SERIES, "ord", slots_of(table).alias("slots"))
    schema = StructType([steps.schema[SERIES], *[StructField(n, LongType()) for n in ("block", "start")], StructField("slot", IntegerType()), *[StructField(n, LongType()) for n in ("n", "last", "first", "gsq")]])
    totals = materialise(steps.mapInArrow(slot_totals_kernel(table.block, back, width), schema), "slot-totals")
    if gaps:  # the gap that a run of steps opens with ends in it
        opening = F.col("first") - F.lag("last").over(Window.partitionBy(SERIES, "slot").orderBy("start"))
        totals = totals.withColumn("gsq", F.col("gsq") + F.coalesce(opening * opening, F.lit(0)))
    how = {"n": "sum", "last": "max", "first": "min", "gsq": "sum"}
    return dense_prefix(totals, "slot", width, how).select(
        SERIES, "block", F.array("slot").alias("slots"), *[f"_{v}" for v in how]
    )


def slot_state(
    table: StepTable,
    windows: tuple[int, ...] = (),
    want: tuple[str, ...] = ("cnt", "last"),
    span: tuple[int, int] | None = None,
    beside: tuple[str, ...] = (),
) -> DataFrame:
    """Steps with an array over all slots per wanted state, as of just before the step.

    `cnt` appearances, `last` / `first` ord seen (-1 = never), `gsq` sum of squared gaps, and `r<w>`
    appearances in the previous w steps for each of `windows`. `span` limits the steps that are
    returned (lo <= ord < hi); their state still counts every earlier step.
    Columns of `beside` (one value per step in `table`) stay beside the state.
    """
    both = by_block(slot_rows(table, windows, want, span, beside), table.rows)
    keep = [SERIES, "block", "ord", *STEP_COLUMNS, *beside]
    state = both.mapInArrow(slot_kernel(keep, table.domain.slots, windows, want), state_schema(both, keep, windows, want))
    return state if span is None else state.where(F.col("ord") >= span[0])


def slot_rows(table: StepTable, windows: tuple[int, ...], want: tuple[str, ...], span: tuple[int, int] | None, beside: tuple[str, ...] = ()) -> DataFrame:
    """What the slot kernel reads once it is brought together by block: the steps with their halo, and the carry rows."""
    width, back = table.domain.slots, max(windows, default=0)
    source = in_span(table.df.select(SERIES, "ord", *STEP_COLUMNS, *beside), table, span, back)
    rows = spread(source, table.block, back).withColumn("slots", slots_of(table))
    carry = _carry(table, width, back, span, "gsq" in want)
    if span is not None:
        rows = rows.where(F.col("block") >= span[0] // table.block)
        carry = carry.where(F.col("block").between(span[0] // table.block, (span[1] - 1) // table.block))
    carry = carry.withColumn("ord", F.lit(-1).cast("long")).withColumn("own", F.lit(False))
    return rows.unionByName(carry, allowMissingColumns=True)


def state_schema(rows: DataFrame, keep: list[str], windows: tuple[int, ...], want: tuple[str, ...]) -> StructType:
    names = [*want, *[f"r{w}" for w in windows]]
    return StructType([*rows.select(*keep).schema.fields, *[StructField(n, ArrayType(LongType())) for n in names]])


def item_part(table: StepTable, name: str) -> Column:
    return F.slice(F.col(name), 1, table.domain.items)


def special_part(table: StepTable, name: str) -> Column:
    return F.slice(F.col(name), table.domain.items + 1, table.domain.specials)


def current_gap(last: Column) -> Column:
    """Steps since each item was last seen, counted at the latest known step; never seen counts every step."""
    return F.transform(last, lambda s: F.col("ord") - 1 - s)


def average_gap(cnt: Column, last: Column, first: Column) -> Column:
    """Mean gap by telescoping, (last - first) / (count - 1); without a gap, the number of known steps."""
    whole = F.zip_with(last, first, lambda a, b: a - b)
    return F.zip_with(
        cnt, whole, lambda c, d: F.when(c > 1, d / (c - 1)).otherwise(F.col("ord").cast("double"))
    )


def item_grid(state: DataFrame, table: StepTable, arrays: dict[str, Column], keep: list[str]) -> DataFrame:
    """One row per (step, item): the dense candidate grid, unfolded inside the row, with label `y`."""
    label = F.transform(
        F.sequence(F.lit(1), F.lit(table.domain.items)),
        lambda n: F.array_contains("items", n).cast("int"),
    )
    state = state.select(*keep, label.alias("y"), *[c.alias(a) for a, c in arrays.items()])
    names = ["y", *arrays]
    return state.select(*keep, F.posexplode(F.arrays_zip(*names)).alias("_at", "_v")).select(
        *keep, (F.col("_at") + 1).alias("item"), *[F.col(f"_v.{n}").alias(n) for n in names]
    )


# ---------------------------------------------------------------------------------------------------
# Sparse form: one row per occurrence, any vocabulary


def step_items(table: StepTable, specials: bool = False) -> DataFrame:
    if specials:
        return table.df.select(SERIES, "ord", "step_id", "ts", F.col("special").alias("item"))
    return table.df.select(SERIES, "ord", "step_id", "ts", F.explode("items").alias("item"))


def sparse_gaps(occurrences: DataFrame, size: int) -> DataFrame:
    """Occurrences (series_id, ord, item, ...) with `seen_before` (previous ord of the item) and `gap`.

    Windows run per (series, block, item); the last sighting in earlier blocks enters as a carry row.
    """
    rows = occurrences.withColumn("block", block_of(size))
    totals = rows.groupBy(SERIES, "block", "item").agg(F.max("ord").alias("_last"))
    earlier = Window.partitionBy(SERIES, "item").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        totals.select(SERIES, "block", "item", F.max("_last").over(earlier).alias("ord"))
        .where(F.col("ord").isNotNull())
        .withColumn("_carry", F.lit(True))
    )
    both = rows.withColumn("_carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    seen = both.withColumn("seen_before", F.lag("ord").over(halo_window("item")))
    return (
        seen.where(~F.col("_carry"))
        .withColumn("gap", F.col("ord") - F.col("seen_before"))
        .drop("_carry", "block")
    )


def gap_stats(occurrences: DataFrame, size: int) -> DataFrame:
    """Per (series, item): appearances, last seen, mean / max / min gap, squared-gap sum."""
    return sparse_gaps(occurrences, size).groupBy(SERIES, "item").agg(
        F.count("*").alias("appearances"),
        F.max("ord").alias("last_ord"),
        F.min("ord").alias("first_ord"),
        F.avg("gap").alias("avg_gap"),
        F.max("gap").alias("max_gap"),
        F.min("gap").alias("min_gap"),
    )


def series_length(table: StepTable) -> DataFrame:
    return table.df.groupBy(SERIES).agg((F.max("ord") + 1).alias("n_steps"))


def dense_items(table: StepTable, per_series: DataFrame, specials: bool = False) -> DataFrame:
    """Every (series, item) of the fixed vocabulary, so that absent items can be filled."""
    width = table.domain.specials if specials else table.domain.items
    return per_series.withColumn("item", F.explode(F.sequence(F.lit(1), F.lit(width))))


def ball_stats(table: StepTable, specials: bool = False) -> DataFrame:
    """Gap statistics and last sighting for every number of the vocabulary, present or not."""
    occurred = step_items(table, specials)
    stats = gap_stats(occurred, table.block)
    seen = occurred.groupBy(SERIES, "item").agg(
        F.max_by("step_id", "ord").alias("last_seen_step"), F.max("ts").alias("last_seen_date")
    )
    full = dense_items(table, series_length(table), specials)
    return (
        full.join(stats, [SERIES, "item"], "left")
        .join(seen, [SERIES, "item"], "left")
        .select(
            SERIES,
            "item",
            F.coalesce("appearances", F.lit(0)).alias("appearances"),
            "avg_gap",
            "max_gap",
            "min_gap",
            (F.col("n_steps") - 1 - F.coalesce("last_ord", F.lit(-1))).alias("current_gap"),
            "last_seen_step",
            "last_seen_date",
            "first_ord",
            "last_ord",
            "n_steps",
        )
    )


def frequency(table: StepTable, window: int | None = None, specials: bool = False) -> DataFrame:
    """Appearances of every number over the last `window` steps of each series (all when falsy)."""
    lengths = series_length(table)
    occurred = step_items(table, specials)
    if window:
        # the last blocks of each series meet their steps by block, so no task reads a whole series
        first = F.greatest(F.col("n_steps") - window, F.lit(0))
        tails = lengths.select(SERIES, "n_steps", F.explode(F.sequence(block_of(table.block, first), block_of(table.block, F.col("n_steps") - 1))).alias("block"))
        occurred = occurred.withColumn("block", block_of(table.block)).join(tails, [SERIES, "block"]).where(F.col("ord") >= F.col("n_steps") - window)
    counts = occurred.groupBy(SERIES, "item").agg(F.count("*").alias("n"))
    return (
        dense_items(table, lengths, specials)
        .join(counts, [SERIES, "item"], "left")
        .select(SERIES, "item", F.coalesce("n", F.lit(0)).alias("appearances"))
    )


def as_of_previous(events: DataFrame, requests: Column, payload: dict[str, Column], size: int) -> DataFrame:
    """As-of join within a series: for each row where `requests` holds, the payload of the latest earlier row.

    `payload` values are null on rows that carry no state (`F.when(cond, ...)`). "Earlier" is by ord.
    """
    state = F.when(
        F.coalesce(*[c.cast("string") for c in payload.values()]).isNotNull(),
        F.struct(*[c.alias(n) for n, c in payload.items()]),
    )
    rows = events.withColumn("_state", state).withColumn("_asked", requests).withColumn("block", block_of(size))
    ends = rows.where(F.col("_state").isNotNull()).groupBy(SERIES, "block").agg(F.max_by("_state", "ord").alias("_state"))
    blocks = rows.groupBy(SERIES, "block").agg(F.lit(1).alias("_one")).join(ends, [SERIES, "block"], "left")
    earlier = Window.partitionBy(SERIES).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(
        SERIES,
        "block",
        F.lit(-1).cast("long").alias("ord"),
        F.last("_state", ignorenulls=True).over(earlier).alias("_state"),
        F.lit(False).alias("_asked"),
    ).where(F.col("_state").isNotNull())
    before = halo_window().rowsBetween(Window.unboundedPreceding, -1)
    found = rows.unionByName(carry, allowMissingColumns=True).withColumn(
        "_found", F.last("_state", ignorenulls=True).over(before)
    )
    return found.where("_asked").select(*events.columns, *[F.col(f"_found.{n}").alias(f"prev_{n}") for n in payload])
