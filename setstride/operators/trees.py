"""Histogram trees for many models at once: one tree per item, forests and boosted trees, refit along a walk.

Features are cut into `BINS` bins of fixed width (`Bins`), so bins look at no other step. The binned matrix is written once and shared by
all items, trees, rounds and fits: as rows for scoring, and packed into blocks of about `BLOCK_ROWS` rows for growing. A level
of all trees is one job: a task takes blocks and a group of models, places the rows in each model's tree so far and counts them by
(node, feature, bin); counts of a model leave the task once for all its blocks and meet, where the best split of each node is found. Up to `WHOLE_ROWS`
rows a task holds all blocks and grows its models' trees (and all rounds of boosting) whole: the same steps in one job. Only splits come to the
driver: their number is that of the nodes, whatever the data. All counts and sums are whole numbers, so no result depends on the order of tasks.

Two features are counted at once, by a code of both bins, and both channels (rows and rows with the item, or second and first gradients) in one
number; the counts of each feature are sums over those of the pair.

* `fit`: a model sees the revealed steps with ord < its fit ordinal and serves the steps from there up to the next fit.
* Gini trees weigh the classes as balanced over the rows of the fit; splits need `least` rows on both sides.
* Forests draw each row k times by a hash (Poisson of mean 1) and a share of the features anew at every node.
* Boosting adds second-order trees of the logistic loss; gradients are kept to 2^-24. Margins are written every `KEEP_ROUNDS` rounds.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setstride.operators.layout import SERIES, StepTable
from setstride.operators.scorers import KEYS, scored
from setstride.session import materialise

BINS = 32
BLOCK_ROWS = 1 << 17
WHOLE_ROWS = 1 << 20
CHUNK_ROWS = 1 << 15
LEVEL_BYTES = 1 << 26
KEEP_ROUNDS = 10
FEW_FITS = 8
_MERGED_UNION = "spark.sql.unionOutputPartitioning"
_UNIT = 1 << 24
_G, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _hash(*parts: np.ndarray | int) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for p in parts:
        h = (h ^ np.asarray(p, np.uint64)) * _G
        h = (h ^ (h >> np.uint64(32))) * _M
        h = h ^ (h >> np.uint64(29))
    return h


@dataclass(frozen=True)
class Bins:
    """Names, lower ends and widths of the features' bins; values outside fall into the first or the last bin."""

    names: list[str]
    low: np.ndarray
    width: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor((np.nan_to_num(x) - self.low) / self.width), 0, BINS - 1).astype(np.uint8)


@dataclass
class Models:
    """Heap-ordered trees of many models: item (0-based), fit ordinal, draw (-1: every row once), splits and node values."""

    item: np.ndarray
    fit: np.ndarray
    draw: np.ndarray
    depth: int
    feature: np.ndarray = field(default=None)
    bin: np.ndarray = field(default=None)
    value: np.ndarray = field(default=None)
    gain: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.feature is None:
            m, inner = len(self.item), (1 << self.depth) - 1
            self.feature, self.bin = np.full((m, inner), -1, np.int16), np.zeros((m, inner), np.uint8)
            self.value, self.gain = np.zeros((m, 2 * inner + 1)), np.zeros((m, inner))

    def __len__(self) -> int:
        return len(self.item)

    def take(self, m: int, level: int, splits: tuple[np.ndarray, ...]) -> None:
        """Add one level's splits (see `_best`) to a model."""
        f, b, gain, own, left, right = splits
        nodes = 1 << level
        at = slice(nodes - 1, 2 * nodes - 1)
        self.feature[m, at], self.bin[m, at], self.gain[m, at] = f, b, np.where(f >= 0, gain, 0.0)
        if level == 0:
            self.value[m, 0] = own[0]
        below = 2 * np.flatnonzero(f >= 0) + 2 * nodes - 1
        self.value[m, below], self.value[m, below + 1] = left[f >= 0], right[f >= 0]

    def nodes(self, m: int, b: np.ndarray, depth: int) -> np.ndarray:
        """The node that each binned row reaches within `depth` splits."""
        node = np.zeros(len(b), np.int64)
        feature, at = self.feature[m], self.bin[m]
        rows = np.arange(len(b))
        for _ in range(depth):
            inside = node < feature.size
            f = np.where(inside, feature[np.minimum(node, feature.size - 1)], -1)
            right = b[rows, np.maximum(f, 0)] > at[np.minimum(node, feature.size - 1)]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def values(self, m: int, b: np.ndarray) -> np.ndarray:
        """The value of the leaf that each binned row reaches; nodes without a split hand theirs down to the left."""
        feature, at, value = self.feature[m].astype(np.int64), self.bin[m].astype(np.int64), self.value[m].copy()
        for i in np.flatnonzero(feature < 0):
            value[2 * i + 1] = value[i]
        at[feature < 0], feature = BINS, np.maximum(feature, 0)
        cells, start = b.reshape(-1), np.arange(len(b)) * b.shape[1]
        node = np.zeros(len(b), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (cells[start + feature[node]] > at[node])
        return value[node]


@dataclass(frozen=True)
class Matrix:
    """The binned matrix of a step table: `rows` (the step keys and `b`), `blocks` (one packed block a row)."""

    rows: DataFrame
    blocks: DataFrame
    bins: Bins
    count: int
    items: int


_BLOCK = "block long, n long, ords binary, keys binary, b binary, y binary"


def _pack(items: int, marked: bool = False):
    """Packs the rows of a block; `marked` ones say with `known` whether they are revealed."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        n = table.num_rows
        hot = np.zeros((n, items), np.uint8)
        lists = table.column("items").combine_chunks()
        at = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
        hot[at, lists.flatten().to_numpy() - 1] = 1
        blobs = [table.column("ord").to_numpy().astype("<i8").tobytes(), table.column("key").to_numpy().astype("<i8").tobytes(), b"".join(table.column("b").to_pylist()), hot.tobytes()]
        names = ["block", "n", "ords", "keys", "b", "y"]
        if marked:
            blobs.append(table.column("known").to_numpy().astype(np.uint8).tobytes())
            names.append("known")
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()), pa.array([n], pa.int64()), *[pa.array([x], pa.binary()) for x in blobs]], names)

    return run


def binned_matrix(table: StepTable, vectors: DataFrame, bins: Bins) -> Matrix:
    """Bin the vectors (step keys and `x`) and write them once, as rows and as packed blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            b = [r.tobytes() for r in bins.of(x)]
            yield pa.RecordBatch.from_arrays([*batch.select(KEYS).columns, pa.array(b, pa.binary())], names=[*KEYS, "b"])

    schema = vectors.select(*KEYS, F.lit(None).cast("binary").alias("b")).schema
    rows = materialise(vectors.select(*KEYS, "x").mapInArrow(cut, schema), "binned")
    blocks = max(1, -(-table.rows // BLOCK_ROWS))
    known = rows.where("special is not null").select("ord", "items", "b", F.xxhash64(SERIES, "ord").alias("key"))
    dealt = known.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(blocks)))
    dealt = dealt.repartition(min(blocks, int(table.spark.conf.get("spark.sql.shuffle.partitions"))), "block")
    packed = materialise(dealt.groupBy("block").applyInArrow(_pack(table.domain.items), _BLOCK), "blocks")
    return Matrix(rows, packed, bins, table.rows, table.domain.items)


def _unpack(row: dict, items: int) -> tuple[np.ndarray, ...]:
    n = row["n"]
    return (
        np.frombuffer(row["ords"], "<i8"), np.frombuffer(row["keys"], "<i8").view(np.uint64),
        np.frombuffer(row["b"], np.uint8).reshape(n, -1), np.frombuffer(row["y"], np.uint8).reshape(n, items),
    )


def _by_chunks(rows: np.ndarray, made) -> np.ndarray:
    """A function of rows, taken chunk by chunk in the cache."""
    return np.concatenate([made(rows[i : i + CHUNK_ROWS]) for i in range(0, max(len(rows), 1), CHUNK_ROWS)])


def drawn(keys: np.ndarray, draw: int, item: int) -> np.ndarray:
    """How often each row is drawn: once without a draw number, else Poisson of mean 1 by its hash."""
    if draw < 0:
        return np.ones(len(keys), np.int64)
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return _by_chunks(keys, lambda k: np.searchsorted(steps, _hash(k, draw, item).astype(np.float64) / 2.0**64, "right"))


def _small(values: np.ndarray) -> tuple[str, bytes]:
    for kind in ("<u1", "<u2", "<u4"):
        if values.min() >= 0 and values.max() < np.iinfo(kind).max:
            return kind, values.astype(kind).tobytes()
    return "<i8", values.astype("<i8").tobytes()


class _Rows:
    """Rows of a task: one packed block, or all of them where trees grow whole."""

    def __init__(self, packed: list[dict], items: int, before: int):
        parts = [_unpack(row, items) for row in packed]
        margins = [np.frombuffer(row["margin"], "<f4").reshape(row["n"], -1) if "margin" in row else np.zeros((row["n"], 0), "<f4") for row in packed]
        seen = [ords < before for ords, _, _, _ in parts]
        self.ords, self.keys, self.b, self.y = (np.concatenate([part[c][k] for part, k in zip(parts, seen)]) for c in range(4))
        self.margins = np.concatenate([x[k] for x, k in zip(margins, seen)])
        self.half = -(-self.b.shape[1] // 2)
        top = self.b.max(axis=0, initial=0).astype(np.int64) + 1
        self.bins = [(int(top[p]), int(top[self.half :].max(initial=1)) if p + self.half < len(top) else 1) for p in range(self.half)]
        self.codes = np.empty((self.half, len(self.b)), np.uint16)
        for p, (_, wide) in enumerate(self.bins):
            self.codes[p] = self.b[:, p]
            if p + self.half < self.b.shape[1]:
                self.codes[p] = self.codes[p] * np.uint16(wide) + self.b[:, p + self.half]


class _Sample:
    """The drawn rows of one model in a task, their weights in both channels, and the node of the level that each has reached."""

    def __init__(self, rows: _Rows, at: np.ndarray, weights: np.ndarray):
        self.rows, self.at, self.weights, self.node = rows, at, weights, np.zeros(len(at), np.int64)

    def place(self, node: np.ndarray) -> None:
        """Put the rows into nodes of the level; rows that have ended in a leaf above (negative) go."""
        live = node >= 0
        if not live.all():
            self.at, self.weights, node = self.at[live], self.weights[live], node[live]
        self.node = node

    def split(self, splits: tuple[np.ndarray, ...]) -> None:
        """Move the rows to the next level."""
        f, at = splits[0].astype(np.int64), splits[1]
        features, cells = self.rows.b.shape[1], self.rows.b.reshape(-1)
        node = np.empty_like(self.node)
        for i in range(0, len(node), CHUNK_ROWS):
            part = slice(i, i + CHUNK_ROWS)
            here = self.node[part]
            chosen = f[here]
            right = cells[self.at[part] * features + np.maximum(chosen, 0)] > at[here]
            node[part] = np.where(chosen >= 0, 2 * here + right, -1)
        self.place(node)

    def counts(self, nodes: int, above: np.ndarray | None = None, split: np.ndarray | None = None) -> np.ndarray:
        """Sums of the weights by (node, feature, bin).

        With the sums of the level `above` and the features it `split` at, only the smaller part of every node is counted; the other is what is left.
        """
        if above is None:
            return self._counted(self.at, self.node, self.weights, nodes)
        size = np.bincount(self.node, minlength=nodes)
        small = (size[1::2] < size[0::2]).astype(np.int64)
        chosen = np.flatnonzero((self.node & 1) == small[self.node >> 1])
        few = self._counted(self.at[chosen], self.node[chosen] >> 1, self.weights[chosen], nodes >> 1)
        out, k = np.empty((nodes, *above.shape[1:]), above.dtype), np.arange(nodes >> 1)
        out[2 * k + small] = few
        out[2 * k + 1 - small] = np.where((split >= 0)[:, None, None], above, 0) - few
        return out

    def _counted(self, at: np.ndarray, node: np.ndarray, weights: np.ndarray, nodes: int) -> np.ndarray:
        bins, half, features = self.rows.bins, self.rows.half, self.rows.b.shape[1]
        cells = [np.zeros(nodes * a * c, weights.dtype) for a, c in bins]
        for i in range(0, len(at), CHUNK_ROWS):  # a chunk stays in the cache for all pairs
            part = slice(i, i + CHUNK_ROWS)
            here, own, w = at[part], node[part], weights[part]
            starts = {size: own * size for size in {a * c for a, c in bins}}
            for (a, c), codes, total in zip(bins, self.rows.codes, cells):
                np.add.at(total, starts[a * c] + np.take(codes, here, mode="clip"), w)
        out = np.zeros((nodes, features, BINS), weights.dtype)
        for p, ((a, c), total) in enumerate(zip(bins, cells)):
            pair = total.reshape(nodes, a, c)
            out[:, p, :a] = pair.sum(axis=2)
            if half + p < features:
                out[:, half + p, :c] = pair.sum(axis=1)
        return out


def _channels(counts: np.ndarray) -> np.ndarray:
    """(channel, node, feature, bin) of sums that hold both channels in one number."""
    if np.iscomplexobj(counts):
        return np.stack([counts.real, counts.imag]).astype(np.int64)
    return np.stack([counts & 0xFFFFFFFF, counts >> 32])


def _sample(rows: _Rows, models: Models, m: int, margin: np.ndarray | None, boost: "Boost | None") -> _Sample:
    item = int(models.item[m])
    times = boost.taken(rows.keys, item) if boost else drawn(rows.keys, int(models.draw[m]), item)
    at = np.flatnonzero((rows.ords < models.fit[m]) & (times > 0))
    if boost is None:
        return _Sample(rows, at, times[at] * np.where(rows.y[at, item] == 1, (1 << 32) + 1, 1))
    g, h = boost.gradients(margin[at], rows.y[at, item])
    return _Sample(rows, at, h + 1j * g)


def _count_level(models: Models, level: int, groups: int, items: int, boost: "Boost | None"):
    """(model, kind, counts): histograms of one level over the blocks of a task, for the models of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                rows = _Rows([row], items, int(models.fit.max()))
                for m in range(row["group"], len(models), groups):
                    sample = _sample(rows, models, m, boost.margin(rows.margins[:, m], rows.b, m) if boost else None, boost)
                    sample.place(models.nodes(m, rows.b[sample.at], level) - ((1 << level) - 1))
                    if len(sample.at):
                        counts = _channels(sample.counts(1 << level))
                        held[m] = counts if m not in held else held[m] + counts
        for m in sorted(held):
            kind, blob = _small(held.pop(m))
            yield pa.record_batch([pa.array([m], pa.int32()), pa.array([kind]), pa.array([blob], pa.binary())], ["model", "kind", "counts"])

    return run


def _grow_whole(models: Models, groups: int, items: int, rule: "Gini | Boost", rounds: int = 1):
    """All levels (and rounds) of a group's models in one task that holds all blocks: the same steps as level by level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = [row for batch in batches for row in batch.to_pylist()]
        if not packed:
            return
        rows, group = _Rows(packed, items, int(models.fit.max())), packed[0]["group"]
        del packed
        for m in range(group, len(models), groups):
            margin = np.zeros(len(rows.ords)) if isinstance(rule, Boost) else None
            for r in range(rounds):
                now = rule.at(r) if isinstance(rule, Boost) else rule
                tree = Models(models.item[m : m + 1], models.fit[m : m + 1], models.draw[m : m + 1], models.depth)
                sample = _sample(rows, tree, 0, margin, now if isinstance(now, Boost) else None)
                counts = splits = None
                for level in range(models.depth):
                    if not len(sample.at):
                        break
                    counts = sample.counts(1 << level, counts, None if splits is None else splits[0])
                    splits = _best(0, tree, level, now.of(m) if isinstance(now, Gini) else now, _channels(counts).astype(float))
                    tree.take(0, level, splits)
                    yield _split_row(r * len(models) + m, level, splits)
                    sample.split(splits)
                if margin is not None and r + 1 < rounds:
                    margin += _by_chunks(rows.b, lambda b: tree.values(0, b))

    return run


@dataclass(frozen=True)
class Gini:
    """Balanced Gini splits; `share` of the features are tried at each node."""

    weights: np.ndarray  # (model, class)
    least: int = 1
    share: float = 1.0

    def of(self, m: int) -> "Gini":
        return Gini(self.weights[m : m + 1], self.least, self.share)

    def best(self, m: int, models: Models, level: int, live: np.ndarray, every: np.ndarray, some: np.ndarray):
        absent, present = self.weights[m]
        left_n, left_1 = every.cumsum(axis=2), some.cumsum(axis=2)
        n, one = left_n[:, :, -1:], left_1[:, :, -1:]

        def impure(count, ones):
            w, p = absent * (count - ones) + present * ones, present * ones
            return w, np.divide(2 * p * (w - p), w, out=np.zeros_like(w), where=w > 0)

        _, whole = impure(n, one)
        _, left = impure(left_n, left_1)
        _, right = impure(n - left_n, one - left_1)
        gain = np.where((left_n >= self.least) & (n - left_n >= self.least), np.round(whole - left - right, 9), -1.0)
        gain = np.where(self._tried(m, models, live + (1 << level), gain.shape[1])[:, :, None], gain, -1.0)
        value = lambda c, o: np.divide(present * o, absent * (c - o) + present * o, out=np.zeros(o.shape), where=c > 0)
        return gain, left_n, left_1, n, one, value

    def _tried(self, m: int, models: Models, nodes: np.ndarray, features: int) -> np.ndarray:
        if self.share >= 1:
            return np.ones((len(nodes), features), bool)
        key = _hash(nodes[:, None], np.arange(features)[None, :], int(models.item[m]), int(models.draw[m]) + 1, 77)
        return np.argsort(np.argsort(key, axis=1), axis=1) < max(1, int(self.share * features))


@dataclass(frozen=True)
class Boost:
    """State of boosting: settings, the round, and the trees since the margins in the blocks were written."""

    fits: int
    rate: float = 0.05
    rows: float = 0.63
    share: float = 0.773
    least: float = 5.0
    smooth: float = 1.0
    positive: float = 8.4
    round: int = 0
    recent: tuple[Models, ...] = ()

    def at(self, r: int) -> "Boost":
        return replace(self, round=r)

    def margin(self, kept: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
        out = kept.astype(np.float64)
        for trees in self.recent:
            out += trees.values(m, b)
        return out

    def taken(self, keys: np.ndarray, item: int) -> np.ndarray:
        return _by_chunks(keys, lambda k: (_hash(k, self.round, item, 5).astype(np.float64) / 2.0**64 < self.rows).astype(np.int64))

    def gradients(self, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p, w = 1 / (1 + np.exp(-margin)), np.where(y == 1, self.positive, 1.0)
        return np.rint(w * (p - y) * _UNIT), np.rint(w * p * (1 - p) * _UNIT)

    def best(self, m: int, models: Models, level: int, live: np.ndarray, every: np.ndarray, some: np.ndarray):
        h, g = every.cumsum(axis=2) / _UNIT, some.cumsum(axis=2) / _UNIT
        all_h, all_g = h[:, :, -1:], g[:, :, -1:]
        part = lambda a, b: a * a / (b + self.smooth)
        gain = part(g, h) + part(all_g - g, all_h - h) - part(all_g, all_h)
        gain = np.where((h >= self.least) & (all_h - h >= self.least), gain, -1.0)
        key = _hash(np.arange(gain.shape[1]), self.round, int(models.item[m]), 9)
        tried = np.argsort(np.argsort(key)) < max(1, int(self.share * gain.shape[1]))
        gain = np.where(tried[None, :, None], gain, -1.0)
        return gain, h, g, all_h, all_g, lambda c, o: -self.rate * o / (c + self.smooth)


_SPLITS = "model int, level int, " + ", ".join(f"{c} binary" for c in "fbgvlr")


def _best(m: int, models: Models, level: int, rule: Gini | Boost, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, bin and gain of every node's best split, and the values of the node and of both its parts."""
    nodes = 1 << level
    live = np.flatnonzero(total[0, :, 0].any(axis=1))
    gain, left_n, left_1, n, one, value = rule.best(m, models, level, live, *total[:, live])
    flat = gain.reshape(len(live), -1)
    at = flat.argmax(axis=1)
    f, b = np.divmod(at, BINS)
    r = np.arange(len(live))
    top = flat[r, at]
    ln, l1, an, a1 = left_n[r, f, b], left_1[r, f, b], n[r, 0, 0], one[r, 0, 0]
    made = [np.where(top > 1e-9, f, -1).astype("<i2"), b.astype("u1"), np.maximum(top, 0.0), value(an, a1), value(ln, l1), value(an - ln, a1 - l1)]
    out = [np.full(nodes, -1, "<i2"), np.zeros(nodes, "u1"), *(np.zeros(nodes) for _ in range(4))]
    for whole, part in zip(out, made):
        whole[live] = part
    return tuple(out)


def _split_row(m: int, level: int, splits: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([m], pa.int32()), pa.array([level], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in splits]], ["model", "level", *"fbgvlr"])


def _choose(models: Models, level: int, rule: Gini | Boost, features: int):
    """Best split of every node from a model's histograms of all blocks; rows come sorted by model."""
    nodes = 1 << level

    def row(m: int, blobs: list[tuple[str, pa.Scalar]]) -> pa.RecordBatch:
        total = np.zeros((2, nodes, features, BINS))
        for kind, blob in blobs:
            total += np.frombuffer(blob.as_buffer(), kind).reshape(total.shape)
        return _split_row(m, level, _best(m, models, level, rule, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for m, kind, blob in zip(batch.column("model").to_pylist(), batch.column("kind").to_pylist(), batch.column("counts")):
                if held and m != last:
                    yield row(last, held)
                    held = []
                last = m
                held.append((kind, blob))
        if held:
            yield row(last, held)

    return run


def _slice(models: Models, rows: slice) -> Models:
    return Models(models.item[rows], models.fit[rows], models.draw[rows], models.depth, models.feature[rows], models.bin[rows], models.value[rows], models.gain[rows])


def _grow(blocks: DataFrame, models: Models, rule: Gini | Boost, matrix: Matrix) -> None:
    """Grow all trees in place: level by level over all blocks, or whole where a task can hold them."""
    if matrix.count <= WHOLE_ROWS:
        tasks, groups = _tasks(blocks, matrix, len(models))
        _take(models, tasks.mapInArrow(_grow_whole(models, groups, matrix.items, rule), _SPLITS))
        return
    level_bytes = (1 << (models.depth - 1)) * len(matrix.bins.names) * BINS * 4
    at_once = len(models) if isinstance(rule, Boost) else max(1, LEVEL_BYTES // level_bytes)
    spread = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    boost = rule if isinstance(rule, Boost) else None
    for a in range(0, len(models), at_once):
        part = _slice(models, slice(a, a + at_once))  # views: grown in place
        own = rule if boost else Gini(rule.weights[a : a + at_once], rule.least, rule.share)
        tasks, groups = _tasks(blocks, matrix, len(part))
        for level in range(models.depth):
            counted = tasks.mapInArrow(_count_level(part, level, groups, matrix.items, boost), "model int, kind string, counts binary")
            met = counted.repartition(min(len(part), spread), "model").sortWithinPartitions("model")
            _take(part, met.mapInArrow(_choose(part, level, own, len(matrix.bins.names)), _SPLITS))


def _take(models: Models, found: DataFrame) -> None:
    """Fetch splits. The parts of a union stay tasks of their own, also where each is a single partition."""
    kinds = ("<i2", "u1", "<f8", "<f8", "<f8", "<f8")
    conf = found.sparkSession.conf
    before = conf.get(_MERGED_UNION)
    conf.set(_MERGED_UNION, "false")
    try:
        rows = found.collect()  # one row per model and level
    finally:
        conf.set(_MERGED_UNION, before)
    for row in rows:
        models.take(row["model"], row["level"], tuple(np.frombuffer(row[c], k) for c, k in zip("fbgvlr", kinds)))


def _tasks(blocks: DataFrame, matrix: Matrix, models: int) -> tuple[DataFrame, int]:
    """Blocks beside groups of models, read once for every group: few blocks are met by more groups, so that all cores have work."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    whole = matrix.count <= WHOLE_ROWS
    count = 1 if whole else max(1, -(-matrix.count // BLOCK_ROWS))
    groups = max(1, min(models, -(-cores // count)))
    parts = [blocks.withColumn("group", F.lit(g)) for g in range(groups)]
    return reduce(DataFrame.unionAll, [p.coalesce(1) for p in parts] if whole else parts), groups


def class_weights(matrix: Matrix, fits: list[int]) -> np.ndarray:
    """(fit, item, class): n / (2 n_class) over the rows of each fit; 0 for a class without rows."""
    items = matrix.items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ords, _, _, y = _unpack(row, items)
                for j, fit in enumerate(fits):
                    ones = y[ords < fit].sum(axis=0, dtype=np.int64)
                    yield pa.record_batch([pa.array([j], pa.int32()), pa.array([int((ords < fit).sum())], pa.int64()), pa.array([ones.tolist()], pa.list_(pa.int64()))], ["fit", "n", "ones"])

    counted = matrix.blocks.mapInArrow(run, "fit int, n long, ones array<long>").select("fit", "n", F.posexplode("ones").alias("item", "k"))
    out = np.zeros((len(fits), items, 2))
    for r in counted.groupBy("fit", "item").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).collect():  # fits x items
        for c, k in enumerate((r["n"] - r["k"], r["k"])):
            out[r["fit"], r["item"], c] = r["n"] / (2 * k) if k else 0.0
    return out


def fit_gini(matrix: Matrix, fits: list[int], depth: int, least: int, trees: int = 0, share: float = 1.0) -> Models:
    """One tree per fit and item, or `trees` drawn ones each."""
    draws = list(range(trees)) or [-1]
    grid = [(f, i, d) for f in range(len(fits)) for i in range(matrix.items) for d in draws]
    weights = class_weights(matrix, fits)
    whole = Models(np.array([i for _, i, _ in grid]), np.array([fits[f] for f, _, _ in grid]), np.array([d for _, _, d in grid]), depth)
    _grow(matrix.blocks, whole, Gini(np.array([weights[f, i] for f, i, _ in grid]), least, share), matrix)
    return whole


def fit_boosted(matrix: Matrix, fits: list[int], depth: int = 5, rounds: int = 100, **settings) -> list[Models]:
    """Boosted trees for every fit and item: one set of trees per round."""
    item, fit = np.tile(np.arange(matrix.items), len(fits)), np.repeat(fits, matrix.items)
    boost, new = Boost(len(fits), **settings), lambda k: Models(np.tile(item, k), np.tile(fit, k), np.full(len(item) * k, -1), depth)
    if matrix.count <= WHOLE_ROWS:
        whole, every = new(1), new(rounds)
        tasks, groups = _tasks(matrix.blocks, matrix, len(whole))
        _take(every, tasks.mapInArrow(_grow_whole(whole, groups, matrix.items, boost, rounds), _SPLITS))
        return [_slice(every, slice(r * len(item), (r + 1) * len(item))) for r in range(rounds)]
    blocks = matrix.blocks.withColumn("margin", F.unhex(F.repeat(F.lit("00"), (F.col("n") * len(item) * 4).cast("int"))))
    out: list[Models] = []
    for r in range(rounds):
        trees = new(1)
        _grow(blocks, trees, boost.at(r), matrix)
        out.append(trees)
        boost = replace(boost, recent=(*boost.recent, trees))
        if len(boost.recent) == KEEP_ROUNDS and r + 1 < rounds:
            blocks = _with_margins(blocks, boost, matrix.items)
            boost = replace(boost, recent=())
    return out


def _with_margins(blocks: DataFrame, boost: Boost, items: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, b, _ = _unpack(row, items)
                kept = np.frombuffer(row["margin"], "<f4").reshape(row["n"], -1)
                row["margin"] = np.stack([boost.margin(kept[:, m], b, m) for m in range(kept.shape[1])], axis=1).astype("<f4").tobytes()
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    return materialise(blocks.mapInArrow(run, blocks.schema), "margins")


def served(matrix: Matrix, table: StepTable, name: str, fits: list[int], sets: list[Models], link=None, end: int | None = None) -> DataFrame:
    """Scores of every step from the first fit on, each by the models of its latest fit: means of the trees of an item, or sums under `link`."""
    items, starts = matrix.items, np.array(sorted(set(fits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = np.frombuffer(b"".join(batch.column("b").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            fit = starts[np.searchsorted(starts, batch.column("ord").to_numpy(), "right") - 1]
            total, seen = np.zeros((len(b), items)), np.zeros((len(b), items))
            for f in np.unique(fit):
                rows = np.flatnonzero(fit == f)
                here = b[rows]
                for trees in sets:
                    for m in np.flatnonzero(trees.fit == f):
                        total[rows, trees.item[m]] += trees.values(m, here)
                        seen[rows, trees.item[m]] += 1
            score = total / np.maximum(seen, 1) if link is None else link(total)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1, dtype=np.int32) * items), pa.array(np.round(score, 12).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.select(KEYS).columns, lists], names=[*KEYS, "score"])

    rows = matrix.rows.where(F.col("ord") >= int(starts[0]))
    if end is not None:
        rows = rows.where(F.col("ord") < end)
    schema = rows.select(*KEYS, F.lit(None).cast("array<double>").alias("score")).schema
    return scored(rows.mapInArrow(run, schema), table, (name, F.col("score"), F.lit(None).cast("int")))


# ---------------------------------------------------------------------------------------------------
# One tree per item, followed along many fits


class Followed:
    """One item's Gini tree, kept as it would be grown anew from the rows so far: rows run down and are counted in every node they pass.

    Splits are chosen again where rows came in. Elsewhere only the class weights move, which scales the gains of one node by a common factor and
    by at most twice the change of their ratio against each other; a node whose best split leads by more than that keeps it. Candidates that
    part the rows into equal counts stay equal, so the first of them stays the first. Where a split changes, all below is grown anew.
    """

    def __init__(self, b: np.ndarray, y: np.ndarray, depth: int, least: int):
        self.b, self.y, self.least, self.inner = b, y, least, (1 << depth) - 1
        self.cells, nodes = np.arange(b.shape[1]) * BINS, 2 * self.inner + 1
        self.counts = np.zeros((self.inner, 2, b.shape[1] * BINS))
        self.n, self.one = np.zeros(nodes), np.zeros(nodes)
        self.feature, self.bin = np.full(self.inner, -1), np.zeros(self.inner, np.int64)
        self.lead, self.ratio = np.zeros(self.inner), np.full(self.inner, np.nan)
        self.seen = 0

    def weights(self) -> tuple[float, float]:
        n, one = self.n[0], self.one[0]
        return (n / (2 * (n - one)) if n > one else 0.0), (n / (2 * one) if one else 0.0)

    def _choose(self, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Feature (-1: none) and bin of the best split of each node; their leads are kept."""
        absent, present = self.weights()
        k, shape = len(nodes), (len(nodes), self.b.shape[1], BINS)
        left_n, left_1 = (self.counts[nodes, c].reshape(shape).cumsum(axis=2).reshape(k, -1) for c in (0, 1))
        n, one = self.n[nodes], self.one[nodes]
        node, at = np.nonzero((left_n >= self.least) & (n[:, None] - left_n >= self.least))  # only candidates, in order

        def impure(count: np.ndarray, ones: np.ndarray) -> np.ndarray:
            w, p = absent * (count - ones) + present * ones, present * ones
            return np.divide(2 * p * (w - p), w, out=np.zeros_like(w), where=w > 0)

        left_n, left_1 = left_n[node, at], left_1[node, at]
        gain = np.round(impure(n, one)[node] - impure(left_n, left_1) - impure(n[node] - left_n, one[node] - left_1), 9)
        ratio = math.log(present / absent) if absent and present else math.nan
        feature, bins = np.full(k, -1), np.zeros(k, np.int64)
        for i, (lo, hi) in enumerate(itertools.pairwise(np.searchsorted(node, np.arange(k + 1)))):
            lead = math.inf  # no candidate, or nothing to gain, whatever the weights
            if lo < hi and 0 < one[i] < n[i]:
                own = gain[lo:hi]
                first = int(own.argmax())
                top = float(own[first])
                others = own[(left_n[lo:hi] != left_n[lo + first]) | (left_1[lo:hi] != left_1[lo + first])]
                second = float(others.max(initial=0.0))
                if top > 1e-9:
                    feature[i], bins[i] = divmod(int(at[lo + first]), BINS)
                lead = 0.0 if top <= 1e-5 else math.inf if second <= 0 else 0.5 * math.log((top - 1e-7 * max(top, 1.0)) / second)
            self.lead[nodes[i]], self.ratio[nodes[i]] = lead, ratio
        return feature, bins

    def _count(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((2, self.counts.shape[2]))
        for i in range(0, len(rows), CHUNK_ROWS):
            part = rows[i : i + CHUNK_ROWS]
            for c, chosen in enumerate((part, part[self.y[part] == 1])):
                out[c] += np.bincount((self.b[chosen] + self.cells).ravel(), minlength=out.shape[1])
        return out

    def _grow(self, node: int, rows: np.ndarray, counts: np.ndarray | None, split: tuple[int, int] | None = None) -> None:
        """Fill a node and all below it with `rows`, or empty them."""
        self.n[node], self.one[node] = len(rows), int(self.y[rows].sum())
        if node >= self.inner:
            return
        if not len(rows):
            counts, split = 0.0, (-1, 0)
        self.counts[node] = counts
        if split is None:
            f, b = self._choose([node])
            split = int(f[0]), int(b[0])
        self.feature[node], self.bin[node] = split
        if split[0] < 0:
            halves, parts = (rows[:0], rows[:0]), (None, None)
            if 2 * node + 1 < len(self.n) and not (self.n[2 * node + 1] or self.n[2 * node + 2]):
                return  # empty already
        else:
            right = self.b[rows, split[0]] > split[1]
            halves, parts = (rows[~right], rows[right]), (None, None)
            if 2 * node + 1 < self.inner:
                few = int(len(halves[1]) < len(halves[0]))
                part = self._count(halves[few])
                parts = (part, self.counts[node] - part) if few == 0 else (self.counts[node] - part, part)
        for side in (0, 1):
            self._grow(2 * node + 1 + side, halves[side], parts[side])

    def _path(self, row: int) -> Iterator[int]:
        node = 0
        while True:
            yield node
            if node >= self.inner or self.feature[node] < 0:
                return
            node = 2 * node + 1 + int(self.b[row, self.feature[node]] > self.bin[node])

    def learn(self, end: int) -> None:
        """See the rows up to place `end`."""
        if not self.seen:
            rows = np.arange(end)
            self.n[0], self.one[0], self.seen = end, int(self.y[:end].sum()), end
            if end:
                self._grow(0, rows, self._count(rows))
            return
        touched = set()
        for row in range(self.seen, end):
            cells, y = self.cells + self.b[row], int(self.y[row])
            for node in self._path(row):
                self.n[node] += 1
                self.one[node] += y
                if node < self.inner:
                    touched.add(node)
                    self.counts[node, 0, cells] += 1
                    if y:
                        self.counts[node, 1, cells] += 1
        self.seen = end
        absent, present = self.weights()
        now = math.log(present / absent) if absent and present else math.nan
        kept = (np.abs(self.ratio - now) < np.minimum(self.lead, 0.5)) | np.isinf(self.lead) & ~np.isnan(self.ratio + now)
        touched.update(np.flatnonzero((self.n[: self.inner] > 0) & ~kept).tolist())
        if not touched:
            return
        nodes, done = sorted(touched), set()
        feature, bins = self._choose(nodes)
        for node, f, b in zip(nodes, feature.tolist(), bins.tolist()):
            if any((node + 1) >> k in done for k in range(1, node.bit_length() + 1)) or (f, b if f >= 0 else 0) == (self.feature[node], self.bin[node] if f >= 0 else 0):
                continue
            done.add(node + 1)
            rows, above = np.arange(end), node + 1
            for k in range(above.bit_length() - 2, -1, -1):  # from the top down
                parent, child = (above >> (k + 1)) - 1, (above >> k) - 1
                rows = rows[(self.b[rows, self.feature[parent]] > self.bin[parent]) == (child == 2 * parent + 2)]
            lead, ratio = self.lead[node], self.ratio[node]
            self._grow(node, rows, self.counts[node].copy(), (f, b))
            self.lead[node], self.ratio[node] = lead, ratio

    def value(self, row: np.ndarray) -> float:
        node = 0
        while node < self.inner and self.feature[node] >= 0:
            node = 2 * node + 1 + int(row[self.feature[node]] > self.bin[node])
        absent, present = self.weights()
        one = present * self.one[node]
        return one / (absent * (self.n[node] - self.one[node]) + one) if self.n[node] else 0.0


def followed(matrix: Matrix, table: StepTable, name: str, fits: list[int], depth: int, least: int, end: int | None = None) -> DataFrame:
    """The scores of one tree per item, fitted at every fit, for fits that are many: a task follows the trees of some items along a run of fits.

    A task holds the binned rows of the walk (188 bytes a step), up to `WHOLE_ROWS`; only scores leave it.
    """
    spark, items, starts = table.spark, matrix.items, np.array(fits)
    stop = table.longest + 1 if end is None else end
    rows = matrix.rows.where(F.col("ord") < stop)
    blocks = max(1, -(-matrix.count // BLOCK_ROWS))
    keyed = rows.withColumn("key", F.xxhash64(SERIES, "ord"))
    marked = keyed.select("ord", "items", "b", "key", F.col("special").isNotNull().cast("int").alias("known"), F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(blocks)).alias("block"))
    packed = materialise(marked.groupBy("block").applyInArrow(_pack(items, True), _BLOCK + ", known binary"), "walk")
    cores = spark.sparkContext.defaultParallelism
    runs = max(1, min(4 * cores, len(fits) // 2048))
    length = -(-len(fits) // runs)
    pairs = [(run, item) for run in range(runs) for item in range(items) if run * length < len(fits)]
    groups = min(len(pairs), 6 * cores)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for batch in batches for row in batch.to_pylist()]
        if not held:
            return
        group, parts = held[0]["group"], [(*_unpack(row, items), np.frombuffer(row["known"], np.uint8)) for row in held]
        ords, keys, b, y, known = (np.concatenate([p[c] for p in parts]) for c in range(5))
        del held, parts
        order = np.lexsort((keys, ords))
        ords, keys, b, y, known = ords[order], keys[order], b[order], y[order], known[order].astype(bool)
        seen_ords, seen_b, seen_y = ords[known], b[known], y[known]
        for run, item in pairs[group::groups]:
            mine = starts[run * length : (run + 1) * length]
            after = starts[(run + 1) * length] if (run + 1) * length < len(starts) else stop
            tree = Followed(seen_b, np.ascontiguousarray(seen_y[:, item]), depth, least)
            first, last = np.searchsorted(ords, [mine[0], after])
            scores, at = np.zeros(last - first), first
            for fit, upto in zip(np.searchsorted(seen_ords, mine), np.searchsorted(ords, [*mine[1:], after])):
                tree.learn(int(fit))
                for i in range(at, upto):
                    scores[i - first] = tree.value(b[i])
                at = max(at, upto)
            which = (ords[first:last].astype("<i8").tobytes(), keys[first:last].tobytes()) if item == 0 else (b"", b"")
            yield pa.record_batch([pa.array([run], pa.int64()), pa.array([item], pa.int64()), *[pa.array([x], pa.binary()) for x in (np.round(scores, 12).tobytes(), *which)]], ["run", "item", "scores", "ords", "keys"])

    def gather(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda row: row["item"])
        ords, keys = np.frombuffer(found[0]["ords"], "<i8"), np.frombuffer(found[0]["keys"], "<i8")
        score = np.stack([np.frombuffer(row["scores"]) for row in found], axis=1)
        for i in range(0, len(ords), CHUNK_ROWS):
            part = score[i : i + CHUNK_ROWS]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * items), pa.array(part.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ords[i : i + CHUNK_ROWS]), pa.array(keys[i : i + CHUNK_ROWS]), lists], names=["ord", "key", "score"])

    tasks = reduce(DataFrame.unionAll, [packed.withColumn("group", F.lit(g)).coalesce(1) for g in range(groups)])
    before = spark.conf.get(_MERGED_UNION)
    spark.conf.set(_MERGED_UNION, "false")
    try:
        made = materialise(tasks.mapInArrow(follow, "run long, item long, scores binary, ords binary, keys binary"), "followed")
    finally:
        spark.conf.set(_MERGED_UNION, before)
    scores = made.groupBy("run").applyInArrow(gather, "ord long, key long, score array<double>")
    met = keyed.where(F.col("ord") >= int(starts[0])).select(*KEYS, "key").join(scores, ["ord", "key"])
    return scored(met.select(*KEYS, "score"), table, (name, F.col("score"), F.lit(None).cast("int")))


def logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margin))


def importance(models: Models, names: list[str]) -> list[tuple[str, float]]:
    """Each feature's share of the impurity that its splits take away, averaged over the models."""
    total = np.zeros(len(names))
    for m in range(len(models)):
        split = models.feature[m] >= 0
        if split.any():
            own = np.bincount(models.feature[m][split], models.gain[m][split], len(names))
            total += own / own.sum()
    return sorted(zip(names, (total / max(len(models), 1)).tolist()), key=lambda r: (-r[1], r[0]))
