"""Physical layout of step sequences: global ordinals, equal blocks, halos and carry rows.

A sequence may be one huge series, so nothing here sorts a whole series in one task:

* `ordinal` numbers rows through a range partitioning (row position in the range + rows in earlier ranges);
* steps are cut into equal *blocks* of consecutive ordinals, and every window is partitioned by
  (series, block) instead of by series;
* a finite frame sees across the block border through a *halo* (copies of the last rows of the block
  before), an expanding frame through a *carry row* that holds the state summed over all earlier blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setstride.config import DRAWS, Domain
from setstride.session import materialise

SERIES = "series_id"
MIN_BLOCK = 1 << 10
MAX_BLOCK = 1 << 20


def range_layout(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sort `df` globally by unique `keys` and fix the layout: adds `_part` and `_pos` (row in part).

    The range bounds come from a sample, so the result is written once; both the sizes of the ranges
    and the rows are then read from the same files, whatever task is re-run.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ranged.withColumn("_place", F.monotonically_increasing_id())
    return materialise(
        placed.select(
            "*",
            F.shiftright("_place", 33).alias("_part"),
            F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        ).drop("_place"),
        "ranges",
    )


def ordinal(df: DataFrame, order: list[str], series: str = SERIES, name: str = "ord") -> DataFrame:
    """0-based position of every row within its series; (series, *order) must be unique."""
    laid = range_layout(df, [series, *order])
    sizes = laid.groupBy("_part", series).agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(series).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(
        "_part", series, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    numbered = laid.join(shift, ["_part", series])
    return numbered.withColumn(name, F.col("_pos") + F.col("_shift")).drop("_part", "_pos", "_shift")


def running_totals(df: DataFrame, by: str, order: str, sums: dict[str, str]) -> DataFrame:
    """Exclusive running totals of columns along `order` within `by`, without one task per `by` value.

    `sums` maps output name -> input column; (by, order) must be unique.
    """
    laid = range_layout(df, [by, order])
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("_part", by).agg(*[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()])
    carried = parts.select(
        "_part", by, *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_c_{o}") for o in sums]
    )
    within = Window.partitionBy("_part", by).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = laid.select(
        "*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"_l_{o}") for o, c in sums.items()]
    )
    joined = local.join(carried, ["_part", by])
    return joined.select(*df.columns, *[(F.col(f"_l_{o}") + F.col(f"_c_{o}")).alias(o) for o in sums])


def block_size(longest: int) -> int:
    """Rows per block for a series of `longest` steps.

    About 4 * sqrt(n): the rows of a block and the per-block summaries of a series both grow with the
    square root, until the block reaches what one task should hold.
    """
    wanted = 1 << math.ceil(math.log2(4 * math.sqrt(max(longest, 1))))
    return min(max(wanted, MIN_BLOCK), MAX_BLOCK)


def block_of(size: int, at: Column | str = "ord") -> Column:
    return F.call_function("div", F.col(at) if isinstance(at, str) else at, F.lit(size))


def spread(df: DataFrame, size: int, back: int) -> DataFrame:
    """Add `block` and `own`; rows in the last `back` places of a block are copied into the next block."""
    if back > size:
        raise ValueError(f"halo of {back} rows does not fit into blocks of {size}")
    own = block_of(size)
    if not back:
        return df.withColumn("block", own).withColumn("own", F.lit(True))
    homes = F.when(F.pmod("ord", F.lit(size)) >= size - back, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("block", F.explode(homes)).withColumn("own", F.col("block") == own)


def by_block(df: DataFrame, rows: int | None = None, series: str = SERIES) -> DataFrame:
    """Bring each block together, sorted: the one exchange and sort that later windows reuse.

    The count is explicit because these narrow rows widen many times after the exchange; merging
    partitions by shuffled bytes would leave most of the cluster idle. A known small number of `rows`
    needs fewer tasks than the setting asks for.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows is not None:
        parts = min(parts, 1 + rows // MIN_BLOCK)
    return df.repartition(parts, series, "block").sortWithinPartitions(series, "block", "ord")


def halo_window(*extra: str, series: str = SERIES):
    return Window.partitionBy(series, "block", *extra).orderBy("ord")


@dataclass(frozen=True)
class StepTable:
    """Steps in canonical form: series_id, ord, step_id, ts, items, special, amount, prev_items, prev_special, prev2_items."""

    df: DataFrame
    block: int
    longest: int
    rows: int
    domain: Domain = DRAWS

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def having(self, condition: Column) -> "StepTable":
        return replace(self, df=self.df.where(condition))

    def with_request(self) -> "StepTable":
        """Append one open step per series (ord = last + 1, nothing revealed yet) to be scored."""
        last = self.df.groupBy(SERIES).agg(
            F.max_by(F.struct("ord", "items", "special", "prev_items"), "ord").alias("last")
        )
        empty = F.array().cast("array<int>")
        request = last.select(
            SERIES,
            (F.col("last.ord") + 1).alias("ord"),
            F.lit(None).cast("long").alias("step_id"),
            F.lit(None).cast("date").alias("ts"),
            empty.alias("items"),
            F.lit(None).cast("int").alias("special"),
            F.lit(None).cast("double").alias("amount"),
            F.col("last.items").alias("prev_items"),
            F.col("last.special").alias("prev_special"),
            F.col("last.prev_items").alias("prev2_items"),
        )
        return replace(self, df=self.df.unionByName(request), longest=self.longest + 1)


def build_steps(raw: DataFrame, domain: Domain = DRAWS, block: int | None = None) -> StepTable:
    """Number and lay out raw steps (series_id, step_id, ts, items, special, amount) by (ts, step_id)."""
    spark = raw.sparkSession
    numbered = materialise(
        ordinal(raw.select(SERIES, "step_id", "ts", "items", "special", "amount"), ["ts", "step_id"]), "numbered"
    )
    last, count = numbered.agg(F.max("ord"), F.count("*")).first()
    longest = (last or 0) + 1
    size = block or block_size(longest)
    pairs = by_block(spread(numbered, size, 2), count)
    w = halo_window()
    steps = (
        pairs.select(
            "*",
            F.lag("items").over(w).alias("prev_items"),
            F.lag("special").over(w).alias("prev_special"),
            F.lag("items", 2).over(w).alias("prev2_items"),
        )
        .where("own")
        .drop("own", "block")
    )
    return StepTable(materialise(steps, "steps"), size, longest, count, domain)
