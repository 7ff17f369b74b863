"""Learned scorers: a planted pattern is found, fits see only earlier steps, trees agree with plain growing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import FOLDER, Step, make_steps
from setstride.operators import evaluate, learners, scorers, trees
from setstride.operators.evaluate import outcomes, prequential
from setstride.plans import QUERIES


def periodic(n=420, jump=None):
    """Items come back every ninth step, five at a time; from step `jump` on in another grouping."""
    rng = random.Random(4)
    order = rng.sample(range(1, 46), 45)
    steps = []
    for t in range(n):
        group = order if jump is None or t < jump else order[2:] + order[:2]
        steps.append(Step(1, t, t, group[t % 9 * 5 : t % 9 * 5 + 5], 1 + t % 27))
    return steps


@pytest.fixture(scope="module")
def planted(spark):
    return make_steps(spark, periodic())


def mean_hits(scores, table):
    return outcomes(scores, table.domain).agg(F.avg("hits")).first()[0]


@pytest.mark.parametrize(
    "walk", [lambda *a: learners.tree_walk(*a, least=5), lambda *a: learners.forest_walk(*a, count=4), lambda *a: learners.boosted_walk(*a, rounds=12), learners.network_walk]
)
def test_planted_pattern_is_found(planted, walk):
    scores = walk(planted, [250, 330], 400)
    rows = scores.select("ord").collect()
    assert sorted(r["ord"] for r in rows) == list(range(250, 400))
    assert mean_hits(scores, planted) > 4.5  # random picking: 0.53


def test_prequential_walks_learned_models(planted):
    walked = prequential(planted, ("decision_tree", "frequency", "mlp"), 250, 60, {"decision_tree": 25, "mlp": 40, "frequency": 3})
    fits = {m: set() for m in ("decision_tree", "frequency", "mlp")}
    for r in walked.select("model", "ord", "fit_ord").collect():
        assert r["fit_ord"] <= r["ord"] < 310
        fits[r["model"]].add(r["fit_ord"])
    assert fits["decision_tree"] == {250, 275, 300} and fits["mlp"] == {250, 290} and fits["frequency"] == set(range(250, 310, 3))
    assert mean_hits(walked.where("model = 'decision_tree'"), planted) > 3  # leaves of 20 rows are coarse here


def test_a_fit_sees_only_earlier_steps(spark, planted):
    """Changing the steps from 300 on changes no score up to there, and later fits follow the change."""
    other = make_steps(spark, periodic(jump=300))
    a, b = (
        {(r["ord"], r["model"]): r["score"] for r in walk.select("ord", "model", "score").collect()}
        for walk in (learners.tree_walk(t, [200, 300, 380], 420) for t in (planted, other))
    )
    assert all(a[k] == b[k] for k in a if k[0] <= 300)
    assert any(a[k] != b[k] for k in a if k[0] > 320)


def test_trees_agree_with_plain_growing(spark, planted):
    matrix = learners.state_matrix(planted)
    models = trees.fit_gini(matrix, [300], 3, 10)
    rows = matrix.rows.where("ord < 300").orderBy("ord").collect()
    b = np.array([np.frombuffer(r["b"], np.uint8) for r in rows])
    for m in range(0, 47, 9):
        y = np.array([m + 1 in r["items"] for r in rows])
        if not y.any():
            continue
        weight = np.where(y, len(y) / (2 * y.sum()), len(y) / (2 * (~y).sum()))

        def impure(rows):
            w, p = weight[rows].sum(), weight[rows][y[rows]].sum()
            return 2 * p * (w - p) / w if w else 0.0

        def grow(rows, node, depth):
            w = weight[rows].sum()
            assert models.value[m, node] == pytest.approx(weight[rows][y[rows]].sum() / w)
            if depth == 3:
                return
            best = (1e-9, None, None)
            for f in range(b.shape[1]):
                for t in range(trees.BINS):
                    left = rows[b[rows, f] <= t]
                    if 10 <= len(left) <= len(rows) - 10:
                        gain = round(impure(rows) - impure(left) - impure(rows[b[rows, f] > t]), 9)
                        if gain > best[0]:
                            best = (gain, f, t)
            if best[1] is None:
                assert models.feature[m, node] == -1
                return
            assert (models.feature[m, node], models.bin[m, node]) == best[1:]
            grow(rows[b[rows, best[1]] <= best[2]], 2 * node + 1, depth + 1)
            grow(rows[b[rows, best[1]] > best[2]], 2 * node + 2, depth + 1)

        grow(np.arange(len(y)), 0, 0)


def test_blocks_and_batches_change_nothing(planted, monkeypatch):
    whole = learners.tree_walk(planted, [300], 320).orderBy("ord").collect()
    monkeypatch.setattr(trees, "BLOCK_ROWS", 64)
    monkeypatch.setattr(trees, "LEVEL_BYTES", 1 << 22)
    assert learners.tree_walk(planted, [300], 320).orderBy("ord").collect() == whole


def test_margins_written_between_rounds_change_nothing(planted, monkeypatch):
    scores = []
    for keep in (2, 100):
        monkeypatch.setattr(trees, "KEEP_ROUNDS", keep)
        rows = learners.boosted_walk(planted, [300], 310, rounds=5).orderBy("ord").collect()
        scores.append(np.array([r["score"] for r in rows]))
    assert np.allclose(*scores, atol=1e-6)


def test_a_pair_code_counts_as_its_features_do():
    rng = np.random.default_rng(1)
    n, items = 5000, 3
    b = np.minimum(rng.geometric(0.1, (n, 7)), 31).astype(np.uint8)
    y = rng.integers(0, 2, (n, items)).astype(np.uint8)
    row = {"n": n, "ords": np.arange(n).astype("<i8").tobytes(), "keys": rng.integers(0, 1 << 60, n).tobytes(), "b": b.tobytes(), "y": y.tobytes()}
    rows = trees._Rows([row], items, 4000)
    models = trees.Models(np.array([1]), np.array([3000]), np.array([4]), 2)
    sample, node = trees._sample(rows, models, 0, None, None), rng.integers(0, 4, n)
    times = trees.drawn(rows.keys, 4, 1)[:3000]
    sample.place(node[:3000][times > 0])
    every, some = trees._channels(sample.counts(4))
    below, splits = sample.counts(4), np.array([2, -1, 3, 0])
    sample.split((splits, np.array([5, 0, 9, 12]), None))
    assert (sample.counts(8, below, splits) == sample.counts(8)).all()
    for f in range(7):
        for counts, weight in ((every, times), (some, times * y[:3000, 1])):
            plain = np.bincount(node[:3000] * trees.BINS + b[:3000, f], weight, 4 * trees.BINS)
            assert (counts[:, f].ravel() == plain).all()


@pytest.mark.parametrize(
    "walk", [lambda *a: learners.forest_walk(*a, count=3, depth=4), lambda *a: learners.boosted_walk(*a, rounds=3, depth=3, least=1.0)]
)
def test_whole_and_level_by_level_growing_agree(spark, planted, monkeypatch, walk):
    """Whole growing is one job whatever the rounds, and its trees are those of blocks that meet level by level."""
    collected = []
    take = trees._take
    monkeypatch.setattr(trees, "_take", lambda *a: (collected.append(1), take(*a)))
    whole = [r["score"] for r in walk(planted, [300], 310).orderBy("ord").collect()]
    assert len(collected) == 1
    monkeypatch.setattr(trees, "WHOLE_ROWS", 0)
    monkeypatch.setattr(trees, "BLOCK_ROWS", 100)
    parts = [r["score"] for r in walk(planted, [300], 310).orderBy("ord").collect()]
    assert np.allclose(whole, parts, atol=1e-6)


def test_a_followed_tree_is_the_tree_grown_anew_at_every_fit(spark, monkeypatch):
    """Steps without a pattern: splits lead by little and change often."""
    rng = random.Random(3)
    table = make_steps(spark, [Step(1, t, t, rng.sample(range(1, 48), 5), 1 + t % 27) for t in range(250)], block=128)
    matrix, fits = learners.state_matrix(table), list(range(180, 250, 2))
    followed = {r["ord"]: r["score"] for r in learners.tree_walk(table, fits, 250, matrix, least=8).collect()}
    monkeypatch.setattr(trees, "FEW_FITS", 1000)
    assert followed == {r["ord"]: r["score"] for r in learners.tree_walk(table, fits, 250, matrix, least=8).collect()}
    monkeypatch.setattr(learners, "FITS_AT_ONCE", 15)
    assert followed == {r["ord"]: r["score"] for r in learners.tree_walk(table, fits, 250, matrix, least=8).collect()}


def test_a_run_of_networks_is_fitted_as_each_alone(planted, monkeypatch):
    fits = [250, 262, 274, 286, 298]
    monkeypatch.setattr(type(planted.spark.sparkContext), "defaultParallelism", property(lambda self: 0.5))  # runs of three fits
    run = {r["ord"]: r["score"] for r in learners.network_walk(planted, fits, 310, epochs=2).collect()}
    monkeypatch.undo()
    alone = [r for f in fits for r in learners.network_walk(planted, [f], f + 12, epochs=2).collect()]
    assert run == {r["ord"]: r["score"] for r in alone}


def test_learned_walk_is_fitted_on_its_whole_schedule(spark, monkeypatch):
    asked = {}

    def stub(model):
        def walk(table, fits, end):
            asked[model] = fits
            return scorers.count_scores(table, (fits[0], end), ("frequency",)).withColumn("model", F.lit(model))

        return None if model == "knn" else walk

    monkeypatch.setattr(evaluate, "refitted", stub)
    QUERIES["learned_walk"](spark, FOLDER)
    assert asked == {"decision_tree": list(range(200, 1500)), "mlp": list(range(200, 1500, 10)), "genetic": list(range(200, 1500, 10))}


def test_importance_finds_the_gap(planted):
    rows = learners.tree_importance(planted).collect()
    assert len(rows) == 188 and sum(r["importance"] for r in rows) <= 1 + 1e-9
    assert sum(r["importance"] for r in rows if r["feature_name"].startswith("gap")) > 0.5


def test_network_on_counted_inputs_learns_and_equals_single_rows():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (4000, 2))
    y = (x[:, 0] >= 8).astype(int)
    keys, at = np.unique(x, axis=0, return_inverse=True)
    n, present = np.bincount(at.ravel()), np.bincount(at.ravel(), y)
    net = learners.Network().fit(keys.astype(float), n, present)
    assert net.losses[-1] < net.losses[0] / 5 and len(net.losses) == learners.EPOCHS
    assert ((net.predict(x.astype(float)) > 0.5) == (y == 1)).mean() > 0.98


def test_search_keeps_the_best_settings(planted):
    found = learners.halving_search(planted, trials=3, first=1, most=2, last=40).collect()
    assert len(found) == 3 and found[0]["trees"] == 2 and found[0]["avg_hits"] >= 4
