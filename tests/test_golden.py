"""Walk of 150 steps after 200 against values from an independent naive loop."""

import pytest

from conftest import FOLDER
from setstride.operators.evaluate import against_random, date_histogram, drift, fold_summary, outcomes, prequential, summary
from setstride.operators.pairs import cooccurrence
from setstride.operators.state import ball_stats
from setstride.plans.common import draws


@pytest.fixture(scope="module")
def walk(spark):
    table = draws(spark, FOLDER)
    return table, outcomes(prequential(table, test=150, every={}), table.domain).cache()


def test_first_predictions(walk):
    picks = {r["model"]: (sorted(r["picks"]), r["special_pick"]) for r in walk[1].where("ord = 200").collect()}
    assert picks == {
        "frequency": ([19, 23, 24, 28, 34], 5),
        "markov": ([1, 10, 16, 28, 34], 2),
        "bayesian": ([23, 24, 26, 28, 34], None),
    }


def test_metrics(walk):
    table, rows = walk
    got = {r["model"]: r for r in against_random(summary(rows, ["model"], table.domain), table.domain).collect()}
    expect = {
        "frequency": ([88, 61, 1, 0, 0, 0], -2.695075, 0.013333),
        "markov": ([88, 50, 11, 1, 0, 0], -0.589538, 0.106667),
        "bayesian": ([93, 51, 5, 1, 0, 0], -2.167583, 0.148642),
    }
    for model, (dist, t, ev) in expect.items():
        row = got[model]
        assert [row[f"hit{h}"] for h in range(6)] == dist
        assert row["t_stat"] == pytest.approx(t, abs=1e-6)
        assert row["ev_per_draw"] == pytest.approx(ev, abs=1e-6)
        assert row["direction"] == "worse"


def test_drift(walk):
    table, rows = walk
    got = {(r["model"], r["position"]): r["moving_avg"] for r in drift(rows, table, 200).collect()}
    expect = {"frequency": (0.38, 0.431373, 0.431373), "markov": (0.42, 0.490196, 0.568627), "bayesian": (0.48, 0.470588, 0.333333)}
    for model, values in expect.items():
        assert [got[model, p] for p in (49, 99, 149)] == pytest.approx(values, abs=1e-6)


def test_item_statistics(walk):
    stats = {r["item"]: r for r in ball_stats(walk[0]).collect()}
    for item, expect in {1: (161, 9.25625, 40, 1, 14), 24: (167, 8.981928, 56, 1, 6), 47: (159, 9.455696, 39, 1, 0)}.items():
        row = stats[item]
        got = (row["appearances"], row["avg_gap"], row["max_gap"], row["min_gap"], row["current_gap"])
        assert got == pytest.approx(expect, abs=1e-6)


def test_cooccurrence(walk):
    pairs = cooccurrence(walk[0].df).orderBy("n", ascending=False).collect()
    assert len(pairs) == 1081
    top = min((r["a"], r["b"]) for r in pairs if r["n"] == pairs[0]["n"])
    assert (pairs[0]["n"], top) == (27, (17, 34))


def test_folds(walk):
    folds = fold_summary(date_histogram(walk[0])).orderBy("fold").collect()
    assert len(folds) == 9
    assert (str(folds[0]["window_start"]), folds[0]["n_train"], folds[0]["n_test"]) == ("1997-01-01", 460, 102)
    assert (str(folds[-1]["window_start"]), folds[-1]["n_train"], folds[-1]["n_test"]) == ("2001-01-01", 1378, 90)
