"""Exhaustive ranking of item combinations, once over all steps or as of the fits of a walk."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.operators.layout import SERIES, StepTable, block_of
from setstride.operators.pairs import cooccurrence
from setstride.operators.scorers import KEYS, Span, register, register_refitted, scored
from setstride.operators.state import dense_prefix
from setstride.session import materialise


def item_counts(table: StepTable, specials: bool = False) -> list[int]:
    """Appearances of every number of the (fixed, small) vocabulary, absent ones 0."""
    column = F.array("special") if specials else F.col("items")
    width = table.domain.specials if specials else table.domain.items
    counted = table.df.select(F.explode(column).alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    found = {r["item"]: r["n"] for r in counted.collect()}
    return [found.get(n, 0) for n in range(1, width + 1)]


def fitness_tables(table: StepTable) -> tuple[Column, Column]:
    """Share of appearances per item, and the pair share matrix flattened row by row, as constants.

    Both are bounded by the vocabulary (47 and 47 x 47 numbers), whatever the number of steps.
    """
    width = table.domain.items
    counts = item_counts(table)
    total = max(sum(counts), 1)
    matrix = [0.0] * (width * width)
    for r in cooccurrence(table.df.select(F.lit(0).alias(SERIES), "items")).select("a", "b", "share").collect():
        matrix[(r["a"] - 1) * width + r["b"] - 1] = r["share"]
        matrix[(r["b"] - 1) * width + r["a"] - 1] = r["share"]
    return F.lit([c / total for c in counts]), F.lit(matrix)


def fitness(items: Column, shares: Column, pairs: Column, width: int, pick: int = 5) -> Column:
    """0.6 x sum of item shares + 0.4 x sum of the pair shares of a combination."""
    at = [F.get(items, F.lit(j)) - 1 for j in range(pick)]
    single = sum((F.get(shares, a) for a in at[1:]), F.get(shares, at[0]))
    both = [F.get(pairs, at[i] * width + at[j]) for i in range(pick) for j in range(i + 1, pick)]
    return F.round(0.6 * single + 0.4 * sum(both[1:], both[0]), 12)


def all_combinations(table: StepTable) -> DataFrame:
    """Every ascending 5-set of the vocabulary, unfolded level by level; spread out after two levels."""
    width, pick = table.domain.items, table.domain.pick
    parts = int(table.spark.conf.get("spark.sql.shuffle.partitions"))
    out = table.spark.range(1, width - pick + 2).select(F.col("id").cast("int").alias("c1"))
    for level in range(2, pick + 1):
        follow = F.sequence(F.col(f"c{level - 1}") + 1, F.lit(width - pick + level))
        out = out.select("*", F.explode(follow).alias(f"c{level}"))
        if level == 2:
            out = out.repartition(parts)
    return out.select(F.array(*[f"c{i}" for i in range(1, pick + 1)]).alias("items"))


def best_combinations(table: StepTable, top: int = 10) -> DataFrame:
    """The `top` fittest combinations of all; ties in item order."""
    shares, pairs = fitness_tables(table)
    scored = all_combinations(table).withColumn("fitness", fitness(F.col("items"), shares, pairs, table.domain.items))
    return scored.orderBy(F.desc("fitness"), "items").limit(top)


# ---------------------------------------------------------------------------------------------------
# As of the fits of a walk


def fittest(counts: np.ndarray, pick: int) -> tuple[list[int], float]:
    """The fittest `pick` items (0-based) for counts of items (diagonal) and pairs; ties in item order.

    Combinations grow level by level in lexicographic order; each keeps its last item, so a level is a few vector operations.
    """
    width = len(counts)
    single = 0.6 * np.diag(counts) / max(np.trace(counts), 1)
    both = np.triu(counts, 1) + np.triu(counts, 1).T
    pair = 0.4 * both / max(both.max(), 1)
    members = np.arange(width)[:, None]
    score = single.copy()
    for _ in range(pick - 1):
        last = members[:, -1]
        times = width - 1 - last
        parent = np.repeat(np.arange(len(members)), times)
        added = np.arange(len(parent)) - np.repeat(np.cumsum(times) - times, times) + last[parent] + 1
        gain = single[added]
        for j in range(members.shape[1]):
            gain = gain + pair[members[parent, j], added]
        members, score = np.hstack([members[parent], added[:, None]]), score[parent] + gain
    best = int(np.argmax(np.round(score, 12)))
    return members[best].tolist(), float(score[best])


#: Combinations that a search keeps at hand between fits; fits up to which their counts are taken as columns of a plan.
POOL = 20_000
FEW_FITS = 64
_SLACK = 1e-10


@cache
def _every_combination(width: int, pick: int) -> tuple[np.ndarray, np.ndarray]:
    """Members (one row per place) of every combination in item order, and the cells (row by row) of their pairs."""
    members = np.arange(width, dtype=np.int16)[None, :]
    for _ in range(pick - 1):
        times = width - 1 - members[-1]
        parent = np.repeat(np.arange(members.shape[1]), times)
        added = np.arange(len(parent)) - np.repeat(np.cumsum(times) - times, times) + members[-1][parent] + 1
        members = np.vstack([members[:, parent], added[None, :].astype(np.int16)])
    pairs = np.stack([members[i] * np.int16(width) + members[j] for i, j in itertools.combinations(range(pick), 2)])
    return members, pairs


class Search:
    """The fittest combination for counts that change little from one search to the next; exact, ties in item order.

    All combinations are scored where needed; the best `POOL` are kept. No other can have gained more than the largest rises of single items
    and of pairs since then add up to, so as long as the best kept one is ahead of that, it is the best of all.
    """

    def __init__(self, width: int, pick: int):
        self.width, self.pick, self.pool = width, pick, None
        self.cells = np.flatnonzero(np.triu(np.ones((width, width)), 1))

    @staticmethod
    def _scores(single: np.ndarray, pair: np.ndarray, members: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        total = np.zeros(members.shape[1])
        for table, places in ((single, members), (pair, pairs)):
            for place in places:
                total += np.take(table, place)
        return total

    def best(self, counts: np.ndarray) -> tuple[list[int], float]:
        """0-based items and fitness for counts of items (diagonal) and pairs (either half)."""
        half = np.triu(counts, 1)
        single, pair = 0.6 * np.diag(counts) / max(np.trace(counts), 1), (0.4 * half / max(half.max(), 1)).ravel()
        if self.pool is not None:
            members, pairs, old_single, old_pair, rest = self.pool
            k = len(pairs)
            rise = np.sort(single - old_single)[-self.pick :].sum() + np.sort((pair - old_pair)[self.cells])[-k:].sum()
            score = self._scores(single, pair, members, pairs)
            if score.max() > rest + rise + _SLACK:
                return self._first(members, score)
        members, pairs = _every_combination(self.width, self.pick)
        score = self._scores(single, pair, members, pairs)
        if len(score) > POOL:
            cut = np.partition(score, len(score) - POOL)[len(score) - POOL]
            kept = score > cut
            self.pool = (members[:, kept], pairs[:, kept], single, pair, cut) if kept.any() else None
        return self._first(members, score)

    @staticmethod
    def _first(members: np.ndarray, score: np.ndarray) -> tuple[list[int], float]:
        at = int(np.argmax(np.round(score, 12)))
        return members[:, at].tolist(), float(score[at])


def _best_at_many(table: StepTable, fits: list[int]) -> DataFrame:
    """series, fit_no, best, fitness as of many fits: blocks of steps with the counts before them, so that a task follows the fits of its block."""
    width, pick, size = table.domain.items, table.domain.pick, table.block
    kind, starts = table.df.schema[SERIES].dataType.simpleString(), np.array(fits)
    last = int(starts[-1]) // size

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = pa.Table.from_batches(list(batches)).combine_chunks()
        ords, lists = steps.column("ord").to_numpy().astype("<i8"), steps.column("items").combine_chunks()
        hot = np.zeros((len(ords), width), np.uint8)
        hot[np.repeat(np.arange(len(ords)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False) - 1] = 1
        order, whole = np.argsort(ords), hot.astype(np.float32)
        blobs = [ords[order].tobytes(), zlib.compress(hot[order].tobytes(), 1), (whole.T @ whole).astype("<i8").tobytes()]
        yield pa.record_batch([pa.array([key[0].as_py()], steps.schema.field(SERIES).type), pa.array([key[1].as_py()], pa.int64()), *[pa.array([b], pa.binary()) for b in blobs]], [SERIES, "block", "ords", "hot", "counts"])

    known = table.df.where(F.col("special").isNotNull() & (F.col("ord") < fits[-1])).select(
        SERIES, "ord", F.coalesce(F.filter("items", lambda v: v.isNotNull()), F.array().cast("array<int>")).alias("items"), block_of(size).alias("block")
    )
    blocks = materialise(known.groupBy(SERIES, "block").applyInArrow(pack, f"{SERIES} {kind}, block long, ords binary, hot binary, counts binary"), "fits")

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts before every block up to the last fit's, also of blocks without steps; only sums pass through a series' task."""
        at, block, total = None, 0, None

        def upto(end: int, field: pa.DataType) -> Iterator[pa.RecordBatch]:
            for b in range(block, end):
                yield pa.record_batch([pa.array([at], field), pa.array([b], pa.int64()), pa.array([total.tobytes()], pa.binary())], [SERIES, "block", "before"])

        for batch in batches:
            field = batch.column(SERIES).type
            for series, b, counts in zip(*(batch.column(c).to_pylist() for c in (SERIES, "block", "counts"))):
                if total is None or series != at:
                    if total is not None:
                        yield from upto(last + 1, field)
                    at, block, total = series, 0, np.zeros(width * width, "<i8")
                yield from upto(b + 1, field)
                block, total = b + 1, total + np.frombuffer(counts, "<i8")
        if total is not None:
            yield from upto(last + 1, field)

    sums = blocks.select(SERIES, "block", "counts").repartition(SERIES).sortWithinPartitions(SERIES, "block").mapInArrow(before, f"{SERIES} {kind}, block long, before binary")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Search(width, pick)
        for batch in batches:
            for row in batch.to_pylist():
                lo, hi = np.searchsorted(starts, [row["block"] * size, (row["block"] + 1) * size])
                if lo == hi:
                    continue
                ords = np.frombuffer(row["ords"] or b"", "<i8")
                hot = np.frombuffer(zlib.decompress(row["hot"]), np.uint8).reshape(-1, width).astype(float) if row["ords"] else np.zeros((0, width))
                counts, done, rows = np.frombuffer(row["before"], "<i8").reshape(width, width).astype(float), 0, []
                for j in range(lo, hi):
                    upto = int(np.searchsorted(ords, starts[j]))
                    counts, done = counts + hot[done:upto].T @ hot[done:upto], upto
                    items, score = found.best(counts)
                    rows.append((j, [i + 1 for i in items], score))
                no, best, fitness = zip(*rows)
                arrays = [pa.array([row[SERIES]] * len(rows), batch.column(SERIES).type), pa.array(no, pa.int64()), pa.array(best, pa.list_(pa.int32())), pa.array(fitness, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[SERIES, "fit_no", "best", "fitness"])

    parts = min(int(table.spark.conf.get("spark.sql.shuffle.partitions")) * 4, last + 1)
    asked = sums.where(F.col("block") >= fits[0] // size).join(blocks.drop("counts"), [SERIES, "block"], "left")
    return asked.repartition(parts, SERIES, "block").mapInArrow(search, f"{SERIES} {kind}, fit_no long, best array<int>, fitness double")


def counts_at_fits(table: StepTable, fits: list[int]) -> DataFrame:
    """series, fit, cells (cell, n): appearances of items (cell = 48 x item for 47 items) and of pairs in the steps before each fit."""
    width = table.domain.items
    part = sum((F.when(F.col("ord") >= f, 1).otherwise(0) for f in fits), F.lit(0))
    known = table.df.where(F.col("special").isNotNull() & (F.col("ord") < fits[-1])).select(SERIES, part.cast("long").alias("block"), F.array_sort("items").alias("v"))
    cells = F.flatten(F.transform("v", lambda a: F.transform(F.filter("v", lambda b: b >= a), lambda b: (a - 1) * width + b - 1)))
    totals = known.select(SERIES, "block", F.explode(cells).alias("cell")).groupBy(SERIES, "block", "cell").agg(F.count("*").alias("n"))
    # a part without steps of its own still has the counts of the parts before it
    every = known.select(SERIES).distinct().select(SERIES, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(fits) - 1).cast("long"))).alias("block"))
    blank = every.select(SERIES, "block", F.lit(0).cast("int").alias("cell"), F.lit(0).cast("long").alias("n"))
    dense = dense_prefix(totals.unionByName(blank), "cell", width * width, {"n": "sum"})
    return dense.groupBy(SERIES, (F.col("block") - 1).alias("fit_no")).agg(F.collect_list(F.struct("cell", F.col("_n").alias("n"))).alias("cells"))


def _best_at_few(table: StepTable, fits: list[int]) -> DataFrame:
    """series, fit_no, best, fitness as of a few fits."""
    width, pick = table.domain.items, table.domain.pick
    counted = counts_at_fits(table, fits)
    kind = counted.schema[SERIES].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cells in batch.column("cells").to_pylist():
                flat = np.zeros(width * width)
                flat[[c["cell"] for c in cells]] = [c["n"] for c in cells]
                items, score = fittest(flat.reshape(width, width), pick)
                rows.append(([i + 1 for i in items], score))
            yield pa.RecordBatch.from_arrays(
                [batch.column(SERIES), batch.column("fit_no"), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.float64())],
                names=[SERIES, "fit_no", "best", "fitness"],
            )

    return counted.repartition(SERIES, "fit_no").mapInArrow(run, f"{SERIES} {kind}, fit_no long, best array<int>, fitness double")


def combination_walk(table: StepTable, fits: list[int], end: int | None = None) -> DataFrame:
    """The fittest combination as of each fit, served to the steps up to the next: score 1 for its items, 0 for others.

    More than `FEW_FITS` fits have to be equally far apart.
    """
    width = table.domain.items
    if len(fits) <= FEW_FITS:
        found = _best_at_few(table, fits)
        number = sum((F.when(F.col("ord") >= f, 1).otherwise(0) for f in fits[1:]), F.lit(0))
    else:
        found = _best_at_many(table, fits)
        number = F.least(F.floor((F.col("ord") - fits[0]) / (fits[1] - fits[0])), F.lit(len(fits) - 1))
    # one row per series and fit meets the steps; no row per served step is made
    asked = table.df.select(*KEYS).where(F.col("ord").between(fits[0], (table.longest + 1 if end is None else end) - 1))
    rows = asked.withColumn("fit_no", number.cast("long")).join(found.select(SERIES, "fit_no", "best"), [SERIES, "fit_no"])
    score = F.transform(F.sequence(F.lit(1), F.lit(width)), lambda n: F.array_contains("best", n).cast("double"))
    return scored(rows, table, ("genetic", score, F.lit(None).cast("int")))


def _combination_scores(table: StepTable, span: Span = None) -> DataFrame:
    lo, hi = span or (table.longest * 4 // 5, table.longest)
    return combination_walk(table, [lo], hi)


register("genetic", _combination_scores)
register_refitted("genetic", combination_walk)
