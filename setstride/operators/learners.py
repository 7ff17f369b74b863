"""Learned scorers on as-of-step features, fitted once or anew along a walk.

* `decision_tree`: one tree per item on the whole state vector (gap, gap ratio, last-30 and last-100 count of every item).
* `rf`, `xgb`: a forest and boosted trees per item on the feature matrix (8 rolled statistics, gap and last-20 count of every item).
* `mlp`: one network for all items on an item's own gap and last-30 count. Rows with equal inputs are one weighted row, so
  the training table is as small as the number of distinct inputs, and is counted in one pass for all fits of a walk.

A fit at ordinal `fit` has seen the steps before it and scores the steps from there up to the next fit. Trees: see `trees`.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setstride.config import LOOKBACK, SHORT_WINDOW, VALIDATION_STEPS, Domain
from setstride.functions.arrays import multihot
from setstride.operators import combinations, trees  # noqa: F401 (combinations registers its scorer)
from setstride.operators.evaluate import outcomes
from setstride.operators.layout import SERIES, StepTable
from setstride.operators.neighbours import state_vectors
from setstride.operators.patterns import ROLLED, rolling_features
from setstride.operators.scorers import KEYS, Span, register, register_refitted, scored
from setstride.operators.state import current_gap, item_part, slot_state
from setstride.operators.trees import Bins, Matrix, Models
from setstride.session import materialise

WARM_UP = 100
# Weight of a positive row, 42 absent items for 5 present ones; layers, rate and passes of the network.
POSITIVE_WEIGHT = 42 / 5
HIDDEN = (128, 64)
RATE = 0.001
EPOCHS = 100
BATCHES = 8
FITS_AT_ONCE = 64


def feature_matrix(table: StepTable, lookback: int = LOOKBACK, include_current: bool = False) -> DataFrame:
    """x (8 rolled statistics, every item's gap, every item's last-20 count) and y (multi-hot) per step."""
    rolled = rolling_features(table, lookback, include_current).select(
        SERIES, "ord", F.array(*[f"{c}_roll{lookback}_{s}" for c in ROLLED for s in ("mean", "std")]).alias("_roll")
    )
    # the narrow rolled values join the narrow steps; the state is made beside them
    beside = replace(table, df=table.df.join(rolled, [SERIES, "ord"], "left"))
    state = slot_state(beside, (SHORT_WINDOW,), beside=("_roll",)).where(F.col("ord") >= lookback)
    gap = F.transform(current_gap(item_part(table, "last")), lambda x: x.cast("double"))
    freq = F.transform(item_part(table, f"r{SHORT_WINDOW}"), lambda x: x.cast("double"))
    return state.select(*KEYS, F.concat("_roll", gap, freq).alias("x"), multihot(F.col("items"), table.domain.items).alias("y"))


# ---------------------------------------------------------------------------------------------------
# Bins of fixed width, from the vocabulary alone


def state_bins(domain: Domain) -> Bins:
    """Bins of the state vector: whole gaps and counts, eighths of the gap ratio."""
    names = [f"{n}_{i}" for n in ("gap", "gap_ratio", "freq30", "freq100") for i in range(1, domain.items + 1)]
    return Bins(names, np.zeros(4 * domain.items), np.repeat([1.0, 0.125, 1.0, 1.0], domain.items))


def matrix_bins(domain: Domain, lookback: int = LOOKBACK) -> Bins:
    """Bins of the feature matrix: whole gaps and counts; rolled statistics within 2.7 deviations of random picking."""
    n, k = domain.items, domain.pick
    spread = (n - k) / (n - 1)
    share = {"odd_count": (n + 1) // 2 / n, "low_count": domain.low_max / n}
    expected = {
        "white_sum": (k * (n + 1) / 2, math.sqrt(k * (n - k) * (n + 1) / 12)),
        "number_range": ((k - 1) * (n + 1) / (k + 1), (n + 1) * math.sqrt(2 * (k - 1) / (k + 2)) / (k + 1)),
        **{c: (k * p, math.sqrt(k * p * (1 - p) * spread)) for c, p in share.items()},
    }
    names, low, width = [], [], []
    for c in ROLLED:
        mean, deviation = expected[c]
        for statistic, centre, error in (("mean", mean, deviation / math.sqrt(lookback)), ("std", deviation, deviation / math.sqrt(2 * lookback - 2))):
            names.append(f"{c}_{statistic}")
            width.append(error / 6)
            low.append(centre - 16 * error / 6)
    names += [f"{x}_{i}" for x in ("gap", f"freq{SHORT_WINDOW}") for i in range(1, n + 1)]
    return Bins(names, np.array(low + [0.0] * 2 * n), np.array(width + [1.0] * 2 * n))


def state_matrix(table: StepTable, warm_up: int = WARM_UP) -> Matrix:
    vectors = state_vectors(table, 30).where(F.col("ord") >= warm_up).withColumnRenamed("vec", "x")
    return trees.binned_matrix(table, vectors, state_bins(table.domain))


def forest_matrix(table: StepTable, lookback: int = LOOKBACK) -> Matrix:
    return trees.binned_matrix(table, feature_matrix(table, lookback), matrix_bins(table.domain, lookback))


# ---------------------------------------------------------------------------------------------------
# Learned scorers: (table, fit ordinals, end) -> scores of the steps from the first fit on


def tree_walk(table: StepTable, fits: list[int], end: int | None = None, matrix: Matrix | None = None, depth: int = 5, least: int = 20) -> DataFrame:
    matrix = matrix or state_matrix(table)
    if len(fits) > trees.FEW_FITS and matrix.count <= trees.WHOLE_ROWS:
        return trees.followed(matrix, table, "decision_tree", fits, depth, least, end)
    parts = []
    for i in range(0, len(fits), FITS_AT_ONCE):  # the trees of some fits at a time
        own, after = fits[i : i + FITS_AT_ONCE], [*fits, end][min(i + FITS_AT_ONCE, len(fits))]
        scores = trees.served(matrix, table, "decision_tree", own, [trees.fit_gini(matrix, own, depth, least)], end=after)
        parts.append(scores if len(fits) <= FITS_AT_ONCE else materialise(scores, "served"))
    return reduce(DataFrame.unionByName, parts)


def forest_walk(
    table: StepTable, fits: list[int], end: int | None = None, matrix: Matrix | None = None, count: int = 50, depth: int = 6, least: int = 1, share: float = 0.5
) -> DataFrame:
    matrix = matrix or forest_matrix(table)
    models = trees.fit_gini(matrix, fits, depth, least, count, share)
    return trees.served(matrix, table, "rf", fits, [models], end=end)


def boosted_walk(table: StepTable, fits: list[int], end: int | None = None, matrix: Matrix | None = None, rounds: int = 100, depth: int = 5, **settings) -> DataFrame:
    matrix = matrix or forest_matrix(table)
    sets = trees.fit_boosted(matrix, fits, depth, rounds, **settings)
    return trees.served(matrix, table, "xgb", fits, sets, trees.logistic, end)


# --- network


def network_inputs(table: StepTable, warm_up: int = WARM_UP) -> DataFrame:
    """Step keys with the gap and the last-30 count of every item."""
    state = slot_state(table, (30,)).where(F.col("ord") >= warm_up)
    return state.select(*KEYS, current_gap(item_part(table, "last")).alias("gap"), item_part(table, "r30").alias("freq"))


def input_counts(inputs: DataFrame, fits: list[int], items: int) -> DataFrame:
    """(fit number, gap, freq, n, present): how often each input occurred between a fit and the one before, and how often with the item."""
    starts = np.array(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = np.searchsorted(starts, batch.column("ord").to_numpy(), "right")
            n = batch.num_rows
            cells = np.stack([np.repeat(fit, items), *(batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("gap", "freq"))])
            lists = batch.column("items")
            hot = np.zeros((n, items), np.int64)
            hot[np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False) - 1] = 1
            keys, at, count = np.unique(cells, axis=1, return_inverse=True, return_counts=True)
            present = np.bincount(at.ravel(), hot.ravel(), keys.shape[1]).astype(np.int64)
            yield pa.record_batch([pa.array(c) for c in (*keys, count, present)], ["fit", "gap", "freq", "n", "present"])

    known = inputs.where("special is not null").where(F.col("ord") < int(starts[-1])).select("ord", "gap", "freq", "items")
    made = known.mapInArrow(run, "fit long, gap long, freq long, n long, present long")
    return made.groupBy("fit", "gap", "freq").agg(F.sum("n").alias("n"), F.sum("present").alias("present"))


class Network:
    """Two hidden layers of rectified units and a logistic output over (gap, freq), fitted by weighted mini-batches with Adam."""

    def __init__(self, hidden: tuple[int, int] = HIDDEN, seed: int = 42):
        rng = np.random.default_rng(seed)
        sizes = [2, *hidden, 1]
        self.weights = [p for a, b in itertools.pairwise(sizes) for p in (rng.normal(0, math.sqrt(2 / a), (a, b)), np.zeros(b))]
        self.mean, self.scale = np.zeros(2), np.ones(2)
        self.losses: list[float] = []

    def _layers(self, x: np.ndarray) -> list[np.ndarray]:
        out = [(x - self.mean) / self.scale]
        for i in range(0, len(self.weights), 2):
            z = out[-1] @ self.weights[i] + self.weights[i + 1]
            out.append(np.maximum(z, 0) if i + 2 < len(self.weights) else z)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return trees.logistic(self._layers(x)[-1][:, 0])

    def fit(self, x: np.ndarray, n: np.ndarray, present: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, batches: int = BATCHES, positive: float = POSITIVE_WEIGHT) -> "Network":
        """x: distinct inputs; n, present: rows and rows with the item of each. Equal to fitting on the single rows."""
        total = n.sum()
        self.mean = (x * n[:, None]).sum(axis=0) / total
        self.scale = np.sqrt(((x - self.mean) ** 2 * n[:, None]).sum(axis=0) / total) + 1e-8
        yes, no = positive * present, (n - present).astype(float)
        whole = (yes + no).sum() / batches
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        order, step = np.random.default_rng(7), 0
        for _ in range(epochs):
            loss = 0.0
            for part in np.array_split(order.permutation(len(x)), min(batches, len(x))):
                layers = self._layers(x[part])
                p = trees.logistic(layers[-1][:, 0])
                loss -= (yes[part] * np.log(p + 1e-12) + no[part] * np.log(1 - p + 1e-12)).sum()
                slope = ((yes[part] + no[part]) * p - yes[part])[:, None] / whole
                grads = []
                for i in range(len(self.weights) - 2, -1, -2):
                    below = layers[i // 2]
                    grads[:0] = [below.T @ slope, slope.sum(axis=0)]
                    slope = (slope @ self.weights[i].T) * (below > 0)
                step += 1
                for w, g, (m, v) in zip(self.weights, grads, moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            self.losses.append(loss / (whole * batches))
        return self


def network_walk(table: StepTable, fits: list[int], end: int | None = None, epochs: int = EPOCHS) -> DataFrame:
    """Runs of fits are dealt to tasks: each starts from the counts before its run, and adds the steps between its fits."""
    inputs, items, starts = network_inputs(table), table.domain.items, np.array(fits)
    length = math.ceil(len(fits) / (4 * table.spark.sparkContext.defaultParallelism))
    heads = starts[::length]
    counted = np.array([tuple(r) for r in input_counts(inputs, heads.tolist(), items).orderBy("fit", "gap", "freq").toLocalIterator()], np.int64).reshape(-1, 5)  # runs x distinct inputs
    if not (counted[:, 0] == 0).any():
        raise ValueError(f"no steps before the fit at {fits[0]}")

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = pa.Table.from_batches(list(batches)).combine_chunks().sort_by("ord")
        ords, known = steps.column("ord").to_numpy(), ~steps.column("special").is_null().to_numpy().astype(bool)
        gap, freq = (steps.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, items) for c in ("gap", "freq"))
        lists = steps.column("items").combine_chunks()
        hot = np.zeros((len(ords), items), np.int64)
        hot[np.repeat(np.arange(len(ords)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False) - 1] = 1
        number = key[0].as_py()
        base = counted[counted[:, 0] <= number]
        n, present = (np.zeros((max(gap.max(), base[:, 1].max()) + 1, max(freq.max(), base[:, 2].max()) + 1), np.int64) for _ in range(2))
        np.add.at(n, (base[:, 1], base[:, 2]), base[:, 3])
        np.add.at(present, (base[:, 1], base[:, 2]), base[:, 4])
        mine, score = starts[number * length : (number + 1) * length], np.zeros((len(ords), items))
        for start, stop in itertools.pairwise([*np.searchsorted(ords, mine), len(ords)]):
            if start == stop:
                continue
            at = np.nonzero(n)
            network = Network().fit(np.stack(at, axis=1).astype(float), n[at], present[at], epochs)
            inputs, place = np.unique(np.stack([gap[start:stop].ravel(), freq[start:stop].ravel()], axis=1), axis=0, return_inverse=True)
            score[start:stop] = network.predict(inputs.astype(float))[place.ravel()].reshape(-1, items)
            seen = np.flatnonzero(known[start:stop]) + start
            np.add.at(n, (gap[seen].ravel(), freq[seen].ravel()), 1)
            np.add.at(present, (gap[seen].ravel(), freq[seen].ravel()), hot[seen].ravel())
        made = pa.ListArray.from_arrays(pa.array(np.arange(len(ords) + 1, dtype=np.int32) * items), pa.array(np.round(score, 12).ravel()))
        yield from pa.table([*steps.select(KEYS).columns, made], names=[*KEYS, "score"]).to_batches()

    rows = inputs.where(F.col("ord") >= fits[0])
    if end is not None:
        rows = rows.where(F.col("ord") < end)
    number = sum((F.when(F.col("ord") >= int(h), 1).otherwise(0) for h in heads[1:]), F.lit(0))
    dealt = rows.withColumn("run", number).repartition(len(heads), "run")
    schema = rows.select(*KEYS, F.lit(None).cast("array<double>").alias("score")).schema
    return scored(dealt.groupBy("run").applyInArrow(run, schema), table, ("mlp", F.col("score"), F.lit(None).cast("int")))


# ---------------------------------------------------------------------------------------------------
# One fit, importances, search


def cut_at(table: StepTable, ratio: float, first: int) -> int:
    """The ordinal that parts the first `ratio` of the usable steps from the rest."""
    return first + math.floor((table.longest - first) * ratio)


def tree_scores(table: StepTable, ratio: float = 0.8) -> DataFrame:
    return tree_walk(table, [cut_at(table, ratio, WARM_UP)])


def forest_scores(table: StepTable, ratio: float = 0.8, **settings) -> DataFrame:
    return forest_walk(table, [cut_at(table, ratio, LOOKBACK)], **settings)


def boosted_scores(table: StepTable, ratio: float = 0.8, **settings) -> DataFrame:
    return boosted_walk(table, [cut_at(table, ratio, LOOKBACK)], **settings)


def network_scores(table: StepTable, ratio: float = 0.8, **settings) -> DataFrame:
    return network_walk(table, [cut_at(table, ratio, WARM_UP)], **settings)


def tree_models(table: StepTable, ratio: float = 0.8, depth: int = 5, least: int = 20) -> tuple[Matrix, Models]:
    matrix = state_matrix(table)
    return matrix, trees.fit_gini(matrix, [cut_at(table, ratio, WARM_UP)], depth, least)


def tree_importance(table: StepTable, ratio: float = 0.8) -> DataFrame:
    """feature_name, importance: mean over the trees of all items, largest first (one row per feature)."""
    matrix, models = tree_models(table, ratio)
    rows = trees.importance(models, matrix.bins.names)
    return table.spark.createDataFrame(rows, "feature_name string, importance double").orderBy(F.desc("importance"), "feature_name")


def tree_roots(table: StepTable, ratio: float = 0.8) -> DataFrame:
    """item, feature_name, bin, gain: the first split of every item's tree (one row per item)."""
    matrix, models = tree_models(table, ratio, depth=1)
    rows = [
        (int(models.item[m]) + 1, matrix.bins.names[models.feature[m, 0]], int(models.bin[m, 0]), float(models.gain[m, 0]), *map(float, models.value[m]))
        for m in range(len(models)) if models.feature[m, 0] >= 0
    ]
    return table.spark.createDataFrame(rows, "item int, feature_name string, bin int, gain double, share double, share_low double, share_high double")


def balanced_weights(rows: DataFrame, by: list[str]) -> DataFrame:
    """Add `weight` = n / (2 n_class) within `by` (none, or a column of the fixed vocabulary).

    Class counts are two numbers per group; they come back as a constant of the row expression, so no row moves for its weight.
    """
    counts = {tuple(r[:-1]): r[-1] for r in rows.groupBy(*by, "y").agg(F.count("*").alias("n")).collect()}
    totals: dict[tuple, int] = {}
    for (*group, _), n in counts.items():
        totals[tuple(group)] = totals.get(tuple(group), 0) + n
    weights = {"|".join(map(str, key)): totals[key[:-1]] / (2 * n) for key, n in counts.items()}
    if not weights:
        return rows.withColumn("weight", F.lit(None).cast("double"))
    table = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair])
    return rows.withColumn("weight", table[F.concat_ws("|", *[F.col(c).cast("string") for c in (*by, "y")])])


def sampled_settings(trials: int, seed: int = 42) -> list[dict]:
    """Parameter maps of a forest, drawn once each."""
    rng = np.random.default_rng(seed)
    space = {"depth": range(3, 8), "least": (1, 5, 10, 20), "share": (0.2, 0.35, 0.5, 0.8)}
    every = [dict(zip(space, v)) for v in itertools.product(*space.values())]
    return [every[i] for i in rng.permutation(len(every))[:trials]]


def halving_search(table: StepTable, trials: int = 30, first: int = 2, keep: float = 1 / 3, most: int = 50, last: int = VALIDATION_STEPS) -> DataFrame:
    """Successive halving over forests: all settings with few trees, then the best third with three times as many, up to `most`.

    Hits count on the last `last` steps; the split is by time. All trials share one binned matrix. Ties keep the earlier trial.
    Columns: trial, params, trees (of its last rung), avg_hits there; best first.
    """
    matrix, fit = forest_matrix(table), table.longest - last
    running = list(enumerate(sampled_settings(trials)))
    results: dict[int, tuple[int, float]] = {}
    count = first
    while running:
        for trial, settings in running:
            scores = forest_walk(table, [fit], matrix=matrix, count=count, **settings)
            hits = outcomes(scores, table.domain).agg(F.avg("hits")).first()[0]
            results[trial] = (count, float(hits))
        if len(running) == 1 or count >= most:
            break
        running.sort(key=lambda r: (-results[r[0]][1], r[0]))
        running = running[: max(1, math.ceil(len(running) * keep))]
        count = min(most, count * 3)
    settings = dict(enumerate(sampled_settings(trials)))
    rows = [(t, str(sorted(settings[t].items())), n, h) for t, (n, h) in results.items()]
    return table.spark.createDataFrame(rows, "trial int, params string, trees int, avg_hits double").orderBy(F.desc("trees"), F.desc("avg_hits"), "trial")


def _once(walk: Callable[..., DataFrame], first: int, table: StepTable, span: Span = None) -> DataFrame:
    """One fit before the span, or on the first 80 % of the steps."""
    return walk(table, [cut_at(table, 0.8, first)]) if span is None else walk(table, [span[0]], span[1])


for _name, _walk, _first in (("decision_tree", tree_walk, WARM_UP), ("rf", forest_walk, LOOKBACK), ("xgb", boosted_walk, LOOKBACK), ("mlp", network_walk, WARM_UP)):
    register(_name, partial(_once, _walk, _first))
    register_refitted(_name, _walk)
