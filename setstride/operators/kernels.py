"""Arrow kernels for running per-slot state inside sorted blocks (used through mapInArrow).

Spark partitions, shuffles and sorts the rows; a kernel streams the batches of one partition and keeps
only the state of the block it is in. The same state as window expressions needs one running aggregate
per slot (about 150 of them), whose generated code is too large for the JIT and ran 10-20 times slower.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every element of a list column."""
    offsets = column.offsets.to_numpy()
    sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), values


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = _column(batch, name)
    return column.fill_null(False if pa.types.is_boolean(column.type) else 0).to_numpy(zero_copy_only=False)


def _as_lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).reshape(-1)))


def _segments(batch: pa.RecordBatch, previous) -> tuple[list[tuple[int, int, bool]], tuple]:
    """Runs of rows of one (series, block): start, end, and whether the run opens a new block."""
    series, block = _column(batch, "series_id").to_numpy(zero_copy_only=False), _numbers(batch, "block")
    change = np.flatnonzero((series[1:] != series[:-1]) | (block[1:] != block[:-1])) + 1
    edges = [0, *change.tolist(), len(block)]
    runs = [(a, b, i > 0 or (series[a], block[a]) != previous) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return runs, (series[-1], block[-1])


def _finish(batch: pa.RecordBatch, keep: list[str], own: np.ndarray, made: dict[str, np.ndarray]) -> pa.RecordBatch:
    kept = batch.select(keep).filter(pa.array(own))
    return pa.RecordBatch.from_arrays(
        [*kept.columns, *[_as_lists(m[own]) for m in made.values()]], names=[*keep, *made]
    )


def slot_kernel(keep: list[str], width: int, windows: tuple[int, ...], want: tuple[str, ...]) -> Callable[[Batches], Batches]:
    """State before each row: cnt, last, first (ord, -1 = never), gsq (sum of squared gaps), r<w>."""
    reach = max(windows, default=0)

    def run(batches: Batches) -> Batches:
        previous, state, tail = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ords, own = _numbers(batch, "ord"), _numbers(batch, "own").astype(bool)
            carried = ords < 0
            at, slot = _lists(_column(batch, "slots"))
            hot = np.zeros((batch.num_rows, width), dtype=bool)
            hot[at, slot] = True
            made = {w: np.zeros((batch.num_rows, width), dtype=np.int64) for w in (*want, *[f"r{w}" for w in windows])}
            sums = {c: _numbers(batch, f"_{c}") for c in ("n", "last", "first", "gsq")}
            runs, previous = _segments(batch, previous)
            for a, b, opens in runs:
                if opens:
                    state = {"n": np.zeros(width, np.int64), "gsq": np.zeros(width, np.int64)}
                    state |= {c: np.full(width, -1, np.int64) for c in ("last", "first")}
                    tail = np.zeros((0, width), np.int64)
                while a < b and carried[a]:
                    k = int(np.flatnonzero(hot[a])[0])
                    for c in state:
                        state[c][k] = sums[c][a]
                    a += 1
                if a == b:
                    continue
                h, o = hot[a:b], ords[a:b, None]
                cum = np.cumsum(h, axis=0, dtype=np.int64) + state["n"]
                before = cum - h
                seen = np.maximum.accumulate(np.where(h, o, state["last"]), axis=0)
                last = np.vstack([state["last"], seen[:-1]])
                if "cnt" in made:
                    made["cnt"][a:b] = before
                if "last" in made:
                    made["last"][a:b] = last
                if "first" in made:
                    opened = np.where(h & (before == 0), o, -1)
                    opened[0] = np.maximum(opened[0], state["first"])
                    opened = np.maximum.accumulate(opened, axis=0)
                    made["first"][a:b] = np.vstack([state["first"], opened[:-1]])
                    state["first"] = opened[-1]
                if "gsq" in made:
                    squares = np.cumsum(np.where(h & (last >= 0), (o - last) ** 2, 0), axis=0) + state["gsq"]
                    made["gsq"][a:b] = np.vstack([state["gsq"], squares[:-1]])
                    state["gsq"] = squares[-1]
                history = np.vstack([tail, before])
                for w in windows:
                    start = np.arange(len(tail), len(history)) - w
                    past = np.where((start >= 0)[:, None], history[np.maximum(start, 0)], 0)
                    made[f"r{w}"][a:b] = before - past
                tail = history[max(len(history) - reach, 0):]
                state["n"], state["last"] = cum[-1], seen[-1]
            yield _finish(batch, keep, own, made)

    return run


def context_kernel(keep: list[str], items: int, specials: int, revealed: str) -> Callable[[Batches], Batches]:
    """Conditional counts of every candidate given the items of the step before.

    `revealed="next"`: row-normalised transitions known before the step, summed over the previous items
    (uniform for an item never followed), and the same for the previous special.
    `revealed="same"`: how often each candidate appeared together with the previous step's items.
    """

    def run(batches: Batches) -> Batches:
        previous, counts = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.num_rows
            own = _numbers(batch, "own").astype(bool)
            carried = _numbers(batch, "ord") < 0
            contexts, targets = np.zeros((rows, items + specials), bool), np.zeros((rows, items), np.int64)
            at, value = _lists(_column(batch, "contexts"))
            contexts[at, value] = True
            at, value = _lists(_column(batch, "targets"))
            targets[at, value] = 1
            special_at, special_value = _lists(_column(batch, "special_targets"))
            special_targets = np.zeros((rows, items), np.int64)
            special_targets[special_at, special_value] = 1
            vector_at, vector = _lists(_column(batch, "_vector"))
            vector_start = np.searchsorted(vector_at, np.arange(rows))
            score, special_score = np.zeros((rows, items)), np.zeros((rows, specials))
            runs, previous = _segments(batch, previous)
            for a, b, opens in runs:
                if opens:
                    counts = np.zeros((items + specials, items), np.int64)
                while a < b and carried[a]:
                    c = int(np.flatnonzero(contexts[a])[0])
                    counts[c] = vector[vector_start[a]:vector_start[a] + items]
                    a += 1
                if a == b:
                    continue
                for c in np.flatnonzero(contexts[a:b].any(axis=0)):
                    here = a + np.flatnonzero(contexts[a:b, c])
                    hot = (targets if c < items else special_targets)[here]
                    upto = np.cumsum(hot, axis=0) + counts[c]
                    counts[c] = upto[-1]
                    if revealed == "same":
                        upto[:, c] = 0
                        score[here] += upto
                        continue
                    known = upto - hot
                    total = known.sum(axis=1, keepdims=True)
                    width = items if c < items else specials
                    share = np.where(total > 0, known[:, :width] / np.maximum(total, 1), 1.0 / width)
                    if c < items:
                        score[here] += share
                    else:
                        special_score[here] = share
            yield _finish(batch, keep, own, {"score": score, "special_score": special_score})

    return run


def _runs(batches: Batches, size: int, back: int) -> Iterator[tuple[pa.RecordBatch, int, int, tuple, bool]]:
    """Runs of consecutive steps of one (series, block): batch, first and last row, (series, block, first ord), whether the run goes on from the batch before.

    Rows may come in any order; a step that does not follow the one before it opens a run of its own.
    """
    after = None
    for batch in batches:
        if not batch.num_rows:
            continue
        series, ords = _column(batch, "series_id").to_numpy(zero_copy_only=False), _numbers(batch, "ord")
        block = (ords + back) // size
        cut = np.flatnonzero((series[1:] != series[:-1]) | (block[1:] != block[:-1]) | (ords[1:] != ords[:-1] + 1)) + 1
        for a, b in itertools.pairwise([0, *cut.tolist(), batch.num_rows]):
            yield batch, a, b, (series[a], int(block[a]), int(ords[a])), a == 0 and (series[a], block[a], ords[a]) == after
        after = series[-1], block[-1], ords[-1] + 1


def _hot(batch: pa.RecordBatch, name: str, width: int, kind: type = bool) -> np.ndarray:
    hot = np.zeros((batch.num_rows, width), kind)
    hot[_lists(_column(batch, name))] = 1
    return hot


def _tall(kind: pa.DataType, at: tuple, key: np.ndarray, key_name: str, values: dict[str, np.ndarray]) -> pa.RecordBatch:
    fixed = [pa.array([at[0]] * len(key), kind), *[pa.array(np.full(len(key), v, np.int64)) for v in at[1:]]]
    arrays = [*fixed, pa.array(key.astype(np.int32)), *[pa.array(v.astype(np.int64)) for v in values.values()]]
    return pa.RecordBatch.from_arrays(arrays, names=["series_id", "block", "start", key_name, *values])


def slot_totals_kernel(size: int, back: int, width: int) -> Callable[[Batches], Batches]:
    """One row per run of steps and slot seen there: n, last, first and gsq, the sum of squared gaps between its steps."""

    def run(batches: Batches) -> Batches:
        opened, n, last, first, gsq, kind, whole, hot = None, None, None, None, None, None, None, None

        def closed() -> Batches:
            if opened is not None and (n > 0).any():
                k = np.flatnonzero(n)
                yield _tall(kind, opened, k, "slot", {"n": n[k], "last": last[k], "first": first[k], "gsq": gsq[k]})

        for batch, a, b, at, goes_on in _runs(batches, size, back):
            if batch is not whole:
                whole, hot, ords = batch, _hot(batch, "slots", width), _numbers(batch, "ord")[:, None]
            if not goes_on:
                yield from closed()
                opened, kind = at, _column(batch, "series_id").type
                n, gsq, last, first = (np.full(width, v, np.int64) for v in (0, 0, -1, -1))
            h, o = hot[a:b], ords[a:b]
            seen = np.maximum.accumulate(np.where(h, o, last), axis=0)
            before = np.vstack([last, seen[:-1]])
            gsq = gsq + (np.where(h & (before >= 0), o - before, 0) ** 2).sum(axis=0)
            first = np.where(first >= 0, first, np.where(h.any(axis=0), o[np.argmax(h, axis=0), 0], -1))
            n, last = n + h.sum(axis=0), seen[-1]
        yield from closed()

    return run


def cell_totals_kernel(size: int, items: int, specials: int) -> Callable[[Batches], Batches]:
    """One row per run of steps and (context, target) met there: cell = context * items + target, and n."""

    def run(batches: Batches) -> Batches:
        opened, counts, kind, whole, hot = None, None, None, None, None

        def closed() -> Batches:
            if opened is not None and counts.any():
                flat = counts.reshape(-1)
                cell = np.flatnonzero(flat)
                yield _tall(kind, opened, cell, "cell", {"n": flat[cell]})

        for batch, a, b, at, goes_on in _runs(batches, size, 0):
            if batch is not whole:
                whole = batch
                hot = [_hot(batch, c, w, np.float32) for c, w in (("contexts", items + specials), ("targets", items), ("special_targets", items))]
            if not goes_on:
                yield from closed()
                opened, kind, counts = at, _column(batch, "series_id").type, np.zeros((items + specials, items), np.int64)
            contexts, targets, special_targets = (h[a:b] for h in hot)  # counts of one batch are exact in 24 bits
            counts[:items] += (contexts[:, :items].T @ targets).astype(np.int64)
            counts[items:] += (contexts[:, items:].T @ special_targets).astype(np.int64)
        yield from closed()

    return run


def _stepped(kernel: Callable[[Batches], Batches]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """A kernel as a function of one batch with rows; its state lives on between the calls."""
    box: list[pa.RecordBatch] = []

    def feed() -> Batches:
        while True:
            yield box.pop()

    made = kernel(feed())

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        box.append(batch)
        return next(made)

    return step


def joint_kernel(keep: list[str], items: int, specials: int, windows: tuple[int, ...], want: tuple[str, ...], revealed: str) -> Callable[[Batches], Batches]:
    """Slot state and conditional counts of the same blocks in one pass: the columns of `slot_kernel` and of `context_kernel`."""

    def run(batches: Batches) -> Batches:
        slots = _stepped(slot_kernel(keep, items + specials, windows, want))
        contexts = _stepped(context_kernel([], items, specials, revealed))
        for batch in batches:
            carries = _column(batch, "_vector").is_valid().to_numpy(zero_copy_only=False)
            own = _numbers(batch, "own").astype(bool)
            left, right = batch.filter(pa.array(~carries)), batch.filter(pa.array(carries | own))
            state = slots(left) if left.num_rows else None
            evidence = contexts(right) if right.num_rows else None
            if own.any():
                yield pa.RecordBatch.from_arrays([*state.columns, *evidence.columns], names=[*state.schema.names, *evidence.schema.names])

    return run


def half_up(x: np.ndarray, digits: int = 12) -> np.ndarray:
    """Non-negative numbers rounded to `digits` decimals; a number that reads as a half goes up."""
    unit = 10.0**digits
    below = np.floor(x * unit)
    return np.where((below + 0.5) / unit == x, below + 1, np.floor(x * unit + 0.5)) / unit


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _lists(_column(batch, name))[1].reshape(batch.num_rows, -1)


def _total(x: np.ndarray) -> np.ndarray:
    """Sums of rows, added from the left."""
    return np.cumsum(x, axis=1)[:, -1:]


def ranks(score: np.ndarray) -> np.ndarray:
    """Items 1..n of every row by score descending, item ascending on ties."""
    return (np.argsort(-score, axis=1, kind="stable") + 1).astype(np.int32)


Scored = tuple[np.ndarray, np.ndarray | None]


def blend(batch: pa.RecordBatch, items: int) -> np.ndarray:
    """Half the share of all appearances, half a softmax of the current gap, shifted by the largest gap."""
    cnt = _matrix(batch, "cnt")[:, :items]
    gap = _numbers(batch, "ord")[:, None] - 1 - _matrix(batch, "last")[:, :items]
    raised = np.exp((gap - gap.max(axis=1, keepdims=True)).astype(np.float64))
    return half_up(0.5 * (cnt / np.maximum(_total(cnt), 1)) + 0.5 * (raised / _total(raised)))


def count_models(batch: pa.RecordBatch, models: tuple[str, ...], items: int, weights: dict[str, int]) -> dict[str, Scored]:
    """(score, special pick) of the steps of a batch for each of `models`; `weights` are those of the frequency score."""
    made: dict[str, Scored] = {}
    for model in models:
        if model == "frequency":
            score = sum(_matrix(batch, name)[:, :items] * w for name, w in weights.items())
            made[model] = score.astype(np.float64), np.argmax(_matrix(batch, "cnt")[:, items:], axis=1) + 1
        elif model == "markov":
            made[model] = half_up(_matrix(batch, "score")), np.argmax(half_up(_matrix(batch, "special_score")), axis=1) + 1
        else:
            made[model] = blend(batch, items), None
    return made


def votes(made: dict[str, Scored], tenths: dict[str, int], pick: int) -> dict[str, Scored]:
    """Weighted votes for the picks of every model, in tenths."""
    score = np.zeros_like(next(iter(made.values()))[0])
    for model, (scores, _) in made.items():
        chosen = ranks(scores)[:, :pick] - 1
        np.put_along_axis(score, chosen, np.take_along_axis(score, chosen, axis=1) + tenths.get(model, 10), axis=1)
    return {"ensemble": (score, None)}


def average(made: dict[str, Scored], name: str) -> dict[str, Scored]:
    """Mean of the models' scores, each divided by its sum."""
    total = 0.0
    for _, (scores, _) in sorted(made.items()):
        whole = _total(scores)
        total = total + np.divide(scores, whole, out=np.zeros_like(scores), where=whole != 0)
    return {name: (half_up(total / len(made)), None)}


Shape = Callable[[pa.RecordBatch, np.ndarray, np.ndarray | None], dict[str, pa.Array]]


def _chosen_special(special: np.ndarray | None, n: int) -> pa.Array:
    return pa.nulls(n, pa.int32()) if special is None else pa.array(special.astype(np.int32))


def ranked_shape(pick: int) -> Shape:
    """score, ranked, picks, special_pick."""

    def shape(batch, scores, special):
        ranked = ranks(scores)
        return {"score": _as_lists(scores), "ranked": _as_lists(ranked), "picks": _as_lists(ranked[:, :pick]), "special_pick": _chosen_special(special, len(scores))}

    return shape


def picks_shape(pick: int) -> Shape:
    """picks, special_pick and the largest score."""

    def shape(batch, scores, special):
        return {"picks": _as_lists(ranks(scores)[:, :pick]), "special_pick": _chosen_special(special, len(scores)), "best_score": pa.array(scores.max(axis=1))}

    return shape


def outcome_shape(pick: int) -> Shape:
    """special_pick, hits and mean_rank of the items that came up; a rank is the number of scores above, and of equal ones of lower items."""

    def shape(batch, scores, special):
        n, width = scores.shape
        at, value = _lists(_column(batch, "items"))
        value = value.astype(np.int64) - 1
        row, own = scores[at], scores[at, value][:, None]
        rank = 1 + ((row > own) | (row == own) & (np.arange(width) < value[:, None])).sum(axis=1)
        met = np.zeros((n, width), bool)
        met[at[rank <= pick], value[rank <= pick]] = True
        size = np.bincount(at, minlength=n)
        mean = np.bincount(at, rank, n) / np.maximum(size, 1)
        return {"special_pick": _chosen_special(special, n), "hits": pa.array(met.sum(axis=1).astype(np.int32)), "mean_rank": pa.array(mean, mask=size == 0)}

    return shape


def ranking_kernel(
    state: Callable[[Batches], Batches], keep: list[str], lowest: int, score: Callable[[pa.RecordBatch], dict[str, Scored]], shape: Shape
) -> Callable[[Batches], Batches]:
    """One row per step from ord `lowest` on and model: `keep`, model and the columns of `shape`; nothing else leaves the task."""

    def run(batches: Batches) -> Batches:
        for whole in state(batches):
            batch = whole.filter(pa.array(_numbers(whole, "ord") >= lowest))
            if not batch.num_rows:
                continue
            for model, (scores, special) in score(batch).items():
                made = shape(batch, scores, special)
                yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, pa.array([model] * batch.num_rows), *made.values()], names=[*keep, "model", *made])

    return run


def grid_features(batch: pa.RecordBatch, items: int, low_max: int) -> dict[str, np.ndarray]:
    """The 18 features of `signal.feature_grid` as (step, item) arrays, and `y`; what is the same for all items of a step has one column."""
    n, ords, number = batch.num_rows, _numbers(batch, "ord")[:, None], np.arange(1, items + 1)[None, :]
    state = {c: _matrix(batch, c)[:, :items] for c in ("cnt", "last", "first", "gsq", "r5", "r10", "r30", "r100")}
    gap, more = (ords - 1 - state["last"]).astype(np.float64), state["cnt"] > 1
    gaps = np.maximum(state["cnt"] - 1, 1)
    mean = np.where(more, (state["last"] - state["first"]) / gaps, ords)
    spread = np.sqrt(np.maximum(state["gsq"] / gaps - mean * mean, 0.0))
    f5, f30 = state["r5"] / 5.0, state["r30"] / 30.0
    at, value = _lists(_column(batch, "prev_items"))
    value, follows = value.astype(np.int64), np.concatenate([at[1:] == at[:-1], [False]]) if len(at) else np.zeros(0, bool)

    def per_step(x: np.ndarray) -> np.ndarray:
        return np.bincount(at, x, n)[:, None]

    def came(name: str) -> np.ndarray:
        hot = np.zeros((n, items), bool)
        row, item = _lists(_column(batch, name))
        hot[row, item.astype(np.int64) - 1] = True
        return hot

    return {
        "y": came("items"), "current_gap": gap, "avg_gap": mean, "gap_ratio": np.where(mean > 0, gap / np.where(mean > 0, mean, 1.0), 1.0),
        "gap_zscore": np.where(more, (gap - mean) / np.maximum(spread, 1.0), 0.0), "freq_5": f5, "freq_10": state["r10"] / 10.0, "freq_30": f30,
        "freq_100": state["r100"] / np.minimum(100, ords), "freq_ratio_5_30": f5 / np.maximum(f30, 1e-6),
        "appeared_last": came("prev_items"), "appeared_prev2": came("prev2_items"), "cooccur_last": np.where(ords >= 2, _matrix(batch, "score") / ords, 0.0),
        "last_sum": per_step(value), "last_odd_cnt": per_step(value % 2 == 1), "last_high_cnt": per_step(value > low_max),
        "last_consec": per_step(follows & (np.concatenate([value[1:], value[:1]]) - value == 1)), "ball_is_odd": number % 2, "ball_zone": (number - 1) // 10,
    }


def _grids(state: Callable[[Batches], Batches], items: int, low_max: int, warm_up: int, rows: int = 4096) -> Callable[[Batches], Iterator[dict[str, np.ndarray]]]:
    def run(batches: Batches) -> Iterator[dict[str, np.ndarray]]:
        for whole in state(batches):
            kept = whole.filter(pa.array((_numbers(whole, "ord") >= warm_up) & _column(whole, "prev_items").is_valid().to_numpy(zero_copy_only=False)))
            for at in range(0, kept.num_rows, rows):
                yield grid_features(kept.slice(at, rows), items, low_max)

    return run


def moments_kernel(state: Callable[[Batches], Batches], items: int, low_max: int, warm_up: int, centre: dict[str, float]) -> Callable[[Batches], Batches]:
    """One row per task and feature of `centre`: n, and sums of y, x, x^2 and xy, where x is the feature less its centre."""
    grids = _grids(state, items, low_max, warm_up)

    def run(batches: Batches) -> Batches:
        sums = np.zeros((len(centre), 5))
        for grid in grids(batches):
            y = grid["y"]
            for k, (name, middle) in enumerate(centre.items()):
                x = np.broadcast_to(grid[name] - middle if middle else grid[name].astype(np.float64), y.shape)
                sums[k] += y.size, y.sum(), x.sum(), (x * x).sum(), x[y].sum()
        columns = [pa.array(list(centre)), pa.array(sums[:, 0].astype(np.int64)), *[pa.array(sums[:, k]) for k in range(1, 5)]]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "n", "sy", "sx", "sxx", "sxy"])

    return run


def rates_kernel(state: Callable[[Batches], Batches], items: int, low_max: int, warm_up: int, group: Callable[[dict[str, np.ndarray]], np.ndarray]) -> Callable[[Batches], Batches]:
    """Rows of a task and group (small whole numbers from -1 on): bin, n, and how many labels are 1."""
    grids = _grids(state, items, low_max, warm_up)

    def run(batches: Batches) -> Batches:
        for grid in grids(batches):
            key, y = group(grid).astype(np.int64).reshape(-1) + 1, grid["y"].reshape(-1)
            n, hit = np.bincount(key), np.bincount(key, y)
            found = np.flatnonzero(n)
            columns = [pa.array((found - 1).astype(np.int32)), pa.array(n[found].astype(np.int64)), pa.array(hit[found].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["bin", "n", "hit"])

    return run


def left_open_bins(x: np.ndarray, edges: list[float]) -> np.ndarray:
    """`signal.binned` of numbers."""
    at = np.searchsorted(np.array(edges, np.float64), x, "left") - 1
    return np.where((at < 0) | (at >= len(edges) - 1), -1, at)


def quanta(scores: np.ndarray) -> np.ndarray:
    """Scores of rows as whole numbers: units of 1e-9, or of 1e-9 times the power of ten above the row's largest score.

    Whole scores stay exact up to 10^9, and sums of whole numbers have no order of addition.
    """
    digits = np.array([len(str(int(top))) if top >= 1 else 0 for top in scores.max(axis=1)])
    return np.floor(scores * 10.0 ** (9 - digits)[:, None] + 0.5)


def ticket_kernel(keep: list[str], pool: int, pick: int, tickets: int, rows: int = 4096) -> Callable[[Batches], Batches]:
    """The `tickets` best combinations of the `pool` first-ranked items of each row, and how many of the row's items each holds.

    Combinations rank by the sum of whole-number scores, the lexicographically later one first on equal sums. All sums of a
    block of rows are one product with the 0/1 matrix of combinations; sums times their number stay below 2^53, so they are exact.
    """
    table = np.array(list(itertools.combinations(range(pool), pick)))
    member = np.zeros((pool, len(table)))
    member[table.T, np.arange(len(table))] = 1

    def best(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        n = batch.num_rows
        score = _lists(_column(batch, "score"))[1].reshape(n, -1).astype(np.float64)
        ranked = _lists(_column(batch, "ranked"))[1].reshape(n, -1)
        chosen = np.sort(ranked[:, :pool], axis=1)  # index order is item order
        whole = np.take_along_axis(quanta(score), chosen - 1, axis=1)
        key = (whole @ member) * len(table) + np.arange(len(table))
        few = np.argpartition(key, len(table) - tickets, axis=1)[:, -tickets:]
        at = np.take_along_axis(few, np.argsort(-np.take_along_axis(key, few, axis=1), axis=1), axis=1)
        numbers = np.take_along_axis(chosen, table[at].reshape(n, -1), axis=1).reshape(n, tickets, pick)
        hot = np.zeros((n, score.shape[1] + 1), np.int32)
        hot[_lists(_column(batch, "items"))] = 1
        hits = np.take_along_axis(hot, numbers.reshape(n, -1), axis=1).reshape(n, tickets, pick).sum(axis=2)
        return numbers, hits

    def run(batches: Batches) -> Batches:
        for whole in batches:
            if not whole.num_rows:
                continue
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                numbers, hits = best(batch)
                each = _as_lists(numbers.reshape(-1, pick).astype(np.int32))
                offsets = pa.array(np.arange(0, (len(hits) + 1) * tickets, tickets, dtype=np.int32))
                made = [pa.ListArray.from_arrays(offsets, each), _as_lists(hits.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, *made], names=[*keep, "tickets", "ticket_hits"])

    return run
