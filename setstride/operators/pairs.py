"""Pair statistics: co-occurrence within a step, transitions between steps, and both as of every step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from setstride.operators.kernels import cell_totals_kernel, context_kernel, joint_kernel
from setstride.operators.layout import SERIES, StepTable, block_of, by_block
from setstride.operators.state import STEP_COLUMNS, dense_prefix, in_span, slot_rows, state_schema
from setstride.session import materialise


def pairs_within(items: Column) -> Column:
    """Every unordered pair of a sorted item array, smaller item first."""
    return F.flatten(
        F.transform(
            items,
            lambda a, i: F.transform(
                F.slice(items, i + 2, F.size(items)), lambda b: F.struct(a.alias("a"), b.alias("b"))
            ),
        )
    )


def cooccurrence(steps: DataFrame, items: str = "items", by: str = SERIES) -> DataFrame:
    """Counts of unordered item pairs (a < b) over all steps, and their share of the largest count.

    Pairs come from one step's own short array, are counted before the shuffle, and the largest count
    is taken over the finished matrix, at most vocabulary^2 rows.
    """
    pairs = steps.select(by, F.explode(pairs_within(F.col(items))).alias("_p")).select(by, "_p.a", "_p.b")
    counts = pairs.groupBy(by, "a", "b").agg(F.count("*").alias("n"))
    top = counts.groupBy(by).agg(F.max("n").alias("_top"))
    return counts.join(top, by).select(by, "a", "b", "n", (F.col("n") / F.col("_top")).alias("share"))


def transition_pairs(table: StepTable, specials: bool = False) -> DataFrame:
    """(from, to) pairs of consecutive steps; the previous step is stored beside each step, so no join."""
    if specials:
        return table.df.where(F.col("prev_special").isNotNull()).select(
            SERIES, F.col("prev_special").alias("from_item"), F.col("special").alias("to_item")
        )
    return table.df.select(SERIES, F.explode("prev_items").alias("from_item"), "items").select(
        SERIES, "from_item", F.explode("items").alias("to_item")
    )


def transition_matrix(table: StepTable, specials: bool = False) -> DataFrame:
    """Row-normalised transition matrix over the whole vocabulary; a row never left is uniform."""
    width = table.domain.specials if specials else table.domain.items
    counts = transition_pairs(table, specials).groupBy(SERIES, "from_item", "to_item").agg(F.count("*").alias("n"))
    numbers = F.sequence(F.lit(1), F.lit(width))
    cells = (
        counts.select(SERIES)
        .distinct()
        .withColumn("from_item", F.explode(numbers))
        .withColumn("to_item", F.explode(numbers))
    )
    full = cells.join(counts, [SERIES, "from_item", "to_item"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    row = F.sum("n").over(Window.partitionBy(SERIES, "from_item"))
    return full.withColumn("prob", F.when(row > 0, F.col("n") / row).otherwise(F.lit(1.0 / width)))


def context_state(table: StepTable, revealed: str = "next", span: tuple[int, int] | None = None) -> DataFrame:
    """Steps with `score` (and `special_score`): evidence for each candidate given the previous step.

    `revealed="next"` sums row-normalised transitions seen before the step; `"same"` sums how often the
    candidate shared a step with the previous items. Both hold only what was known before the step.
    """
    items, specials = table.domain.items, table.domain.specials
    rows, carry = context_rows(table, revealed, span)
    both = by_block(rows.withColumn("own", F.lit(True)).unionByName(carry, allowMissingColumns=True), table.rows)
    keep = [SERIES, "block", "ord", *STEP_COLUMNS]
    state = both.mapInArrow(context_kernel(keep, items, specials, revealed), StructType([*both.select(*keep).schema.fields, *EVIDENCE]))
    return state if span is None else state.where(F.col("ord") >= span[0])


EVIDENCE = [StructField(n, ArrayType(DoubleType())) for n in ("score", "special_score")]


def joint_rows(table: StepTable, windows: tuple[int, ...], want: tuple[str, ...], revealed: str = "next", span: tuple[int, int] | None = None) -> DataFrame:
    """The sorted blocks that `joint_kernel` reads: steps with their halo, contexts and targets, and the carry rows of both kernels."""
    contexts, targets, special_targets = context_columns(table, revealed)
    none = F.array().cast("array<int>")
    marked = slot_rows(table, windows, want, span).select(
        "*", F.coalesce(contexts, none).alias("contexts"), F.coalesce(targets, none).alias("targets"), F.coalesce(special_targets, none).alias("special_targets")
    )
    return by_block(marked.unionByName(context_rows(table, revealed, span)[1], allowMissingColumns=True), table.rows)


def joint_state(table: StepTable, windows: tuple[int, ...], want: tuple[str, ...], revealed: str) -> DataFrame:
    """`slot_state` and `context_state` of every step in one pass over the blocks; no evidence is 0."""
    both, keep = joint_rows(table, windows, want, revealed), [SERIES, "block", "ord", *STEP_COLUMNS]
    schema = StructType([*state_schema(both, keep, windows, want).fields, *EVIDENCE])
    return both.mapInArrow(joint_kernel(keep, table.domain.items, table.domain.specials, windows, want, revealed), schema)


def context_columns(table: StepTable, revealed: str) -> tuple[Column, Column, Column]:
    """0-based contexts, targets and special targets of a step; null without a step before."""
    items = table.domain.items
    empty = F.array().cast("array<int>")
    previous = F.transform("prev_items", lambda n: n - 1)
    if revealed == "next":
        contexts = F.concat(previous, F.when(F.col("prev_special").isNull(), empty).otherwise(F.array(F.col("prev_special") + F.lit(items - 1))))
        targets = F.transform("items", lambda n: n - 1)
        special_targets = F.when(F.col("special").isNull(), empty).otherwise(F.array(F.col("special") - 1))
    else:
        contexts, targets, special_targets = previous, previous, empty
    return contexts, targets, special_targets


def context_rows(table: StepTable, revealed: str, span: tuple[int, int] | None) -> tuple[DataFrame, DataFrame]:
    """The steps with their contexts and targets, and per (block, context) the counts of all earlier blocks."""
    items, specials = table.domain.items, table.domain.specials
    contexts, targets, special_targets = context_columns(table, revealed)
    rows = (
        table.df.where(F.col("prev_items").isNotNull())
        .select(SERIES, "ord", *STEP_COLUMNS)
        .select(
            "*",
            block_of(table.block).alias("block"),
            contexts.alias("contexts"),
            targets.alias("targets"),
            special_targets.alias("special_targets"),
        )
    )
    if span is not None:
        rows = rows.where(F.col("ord") < span[1])
    schema = StructType([rows.schema[SERIES], *[StructField(n, LongType()) for n in ("block", "start")], StructField("cell", IntegerType()), StructField("n", LongType())])
    steps = rows.select(SERIES, "ord", "contexts", "targets", "special_targets")
    totals = materialise(steps.mapInArrow(cell_totals_kernel(table.block, items, specials), schema), "cell-totals")
    cells = dense_prefix(totals, "cell", (items + specials) * items, {"n": "sum"})
    context = F.expr(f"cell div {items}")
    carry = (
        cells.groupBy(SERIES, "block", context.cast("int").alias("_c"))
        .agg(F.collect_list(F.struct("cell", F.col("_n"))).alias("_cells"))
        .select(
            SERIES,
            "block",
            F.array("_c").alias("contexts"),
            F.map_from_entries(
                F.transform("_cells", lambda e: F.struct((e["cell"] % items).alias("k"), e["_n"].alias("v")))
            ).alias("_m"),
        )
        .select(
            SERIES,
            "block",
            "contexts",
            F.transform(
                F.sequence(F.lit(0), F.lit(items - 1)), lambda t: F.coalesce(F.try_element_at("_m", t), F.lit(0))
            ).alias("_vector"),
            F.lit(-1).cast("long").alias("ord"),
            F.lit(False).alias("own"),
        )
    )
    if span is not None:
        rows = in_span(rows, table, span)
        carry = carry.where(F.col("block").between(span[0] // table.block, (span[1] - 1) // table.block))
    return rows, carry


# ---------------------------------------------------------------------------------------------------
# Open vocabularies


def sparse_transitions(occurrences: DataFrame, size: int) -> DataFrame:
    """Counts and row shares of item -> next item per whole data set, from one-item steps of many series.

    The neighbour row is found inside (series, block); the last row of each block is handed to the next
    block as a halo copy, so a series of any length is cut into equal tasks.
    """
    from setstride.operators.layout import halo_window, spread

    rows = spread(occurrences.select(SERIES, "ord", "item"), size, 1)
    moves = (
        rows.withColumn("from_item", F.lag("item").over(halo_window()))
        .where(F.col("own") & F.col("from_item").isNotNull())
        .groupBy("from_item", F.col("item").alias("to_item"))
        .agg(F.count("*").alias("n"))
    )
    return moves.withColumn("prob", F.col("n") / F.sum("n").over(Window.partitionBy("from_item")))


def basket_pairs(lines: DataFrame, basket: str, item: str) -> DataFrame:
    """Co-occurrence of distinct items per basket; duplicates fall away before and after the shuffle.

    A basket array holds distinct items only, so it is bounded by the vocabulary even where one basket
    holds a large share of all rows.
    """
    baskets = lines.select(basket, item).groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return cooccurrence(baskets.select(F.lit(0).alias(SERIES), "items"))
