"""Faults that only larger inputs show, brought on by many files, small blocks or the shape of the plan."""

from dataclasses import replace

import numpy as np
from check import compare, connection
from pyspark.sql import functions as F

from conftest import FOLDER, Step, make_steps
from setstride.operators.combinations import combination_walk, fittest
from setstride.operators.evaluate import drift, outcomes, walk_outcomes
from setstride.operators.kernels import half_up
from setstride.operators.neighbours import _state_matrix, _step_blocks, state_vectors
from setstride.operators.pairs import context_state
from setstride.operators.scorers import predictions
from setstride.operators.state import slot_state
from setstride.plans import ORACLES, QUERIES


def agrees(spark, folder, name):
    df = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    expected = connection(FOLDER).execute(ORACLES[name])
    return compare((df.columns, rows), ([c[0] for c in expected.description], expected.fetchall()))


def test_online_state_from_events_in_many_files(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    events.repartition(6, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    note = agrees(spark, str(tmp_path), "stream_state")
    assert note == "" or note.startswith("~"), note


def logical_plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()


def test_states_of_a_step_are_not_joined(spark):
    for name in ("feature_grid", "feature_significance", "response_by_last"):
        assert "Join" not in logical_plan(spark, name), name


def test_votes_and_means_of_a_step_are_not_gathered(spark):
    for name in ("ensemble_picks", "average_picks"):
        assert "any_value" not in logical_plan(spark, name), name


def test_folds_score_the_walk_once(spark):
    for name in ("fold_comparison", "fold_significance"):
        assert logical_plan(spark, name).count("MapInArrow") == 1, name


def test_count_models_rank_inside_the_kernel(spark):
    for name in ("score_ranks", "drift_all_steps", "fold_metrics", "item_auc"):
        assert "sort_array" not in logical_plan(spark, name), name


def test_outcomes_leave_the_kernel_without_scores(spark):
    """Rank lookups, frames and block totals in rows cost more than the scores themselves."""
    for name in ("drift_all_steps", "fold_metrics", "walk_metrics"):
        plan = logical_plan(spark, name)
        assert "array_position" not in plan and "ranked" not in plan and "flatten" not in plan, name
    assert "avg(hits" not in logical_plan(spark, "drift_all_steps")
    assert "ranked" not in logical_plan(spark, "average_picks")


def test_candidates_do_not_become_rows(spark):
    for name in ("feature_significance", "feature_correlations", "response_by_last", "response_by_gap_ratio", "response_by_freq_ratio"):
        assert "arrays_zip" not in logical_plan(spark, name), name


def test_tickets_are_made_where_the_scores_are(spark):
    assert logical_plan(spark, "prequential_tickets").count("MapInArrow") == 1


def test_kernel_outcomes_are_those_of_the_scores(spark):
    rng = np.random.default_rng(7)
    steps = [Step(k, i, i, rng.choice(47, 5, replace=False) + 1, None if i % 41 == 40 and i > 270 else int(rng.integers(1, 28))) for k in (0, 1) for i in range(300 if k == 0 else 30)]
    t = make_steps(spark, [s._replace(items=[int(n) for n in s.items]) for s in steps], block=128)
    names = ["series_id", "ord", "model", "special_pick", "hits", "special_hit", "prize", "ev", "mean_rank"]
    plain = outcomes(predictions(t), t.domain).select(names)
    assert sorted(map(str, walk_outcomes(t).select(names).collect())) == sorted(map(str, plain.collect()))
    seen = {(r["series_id"], r["model"], r["position"]): r["moving_avg"] for r in drift(walk_outcomes(t), t, 0, 51, 50).collect()}
    hits = {(r["series_id"], r["model"], r["ord"]): r["hits"] for r in plain.collect()}
    for (series, model, at), mean in seen.items():
        if at > 286:  # a step without outcome lies in the frame
            continue
        frame = [hits[series, model, o] for o in range(max(at - 50, 0), at + 1) if (series, model, o) in hits]
        assert abs(mean - sum(frame) / len(frame)) < 1e-12


def test_totals_of_runs_do_not_depend_on_the_order_of_steps(spark):
    steps = [Step(0, i, i, [1 + (i * i + 9 * j) % 47 for j in range(5)], 1 + i % 27) for i in range(400)]
    t = make_steps(spark, steps, block=128)
    mixed = replace(t, df=t.df.repartition(5, "step_id").orderBy("special"))
    for state in (lambda x: slot_state(x, (5,), ("cnt", "last", "first", "gsq")), lambda x: context_state(x, "next")):
        assert sorted(map(str, state(mixed).collect())) == sorted(map(str, state(t).collect()))


def test_halves_go_up():
    assert half_up(np.array([1 / 40960, 0.1, 0.3000000000004, 0.0])).tolist() == [0.000024414063, 0.1, 0.3, 0.0]


def test_fits_meet_the_steps_as_one_row_each(spark):
    t = make_steps(spark, [Step(0, i, i, [1 + (i + 9 * j) % 47 for j in range(5)], 1 + i % 27) for i in range(300)], block=128)
    walk = combination_walk(t, [200, 240, 280], 290)
    assert "sequence(lo" not in walk._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["ord"] for r in walk.collect()) == list(range(200, 290))


def test_many_fits_find_the_fittest_of_all_combinations(spark):
    """Every fit of a dense schedule, across blocks, against scoring all combinations from the counts before it."""
    steps = [Step(0, i, i, [1 + (i * i // 7 + 9 * j) % 47 for j in range(5)], 1 + i % 27) for i in range(330)]
    t = make_steps(spark, steps, block=128)
    fits = list(range(200, 330, 2))
    found = {r["ord"]: sorted(r["picks"]) for r in combination_walk(t, fits, 330).select("ord", "picks").collect()}
    assert sorted(found) == list(range(200, 330))
    for fit in fits:
        counts = np.zeros((47, 47))
        for s in steps[:fit]:
            for a in sorted(s.items):
                for b in s.items:
                    counts[a - 1, b - 1] += a <= b
        best = [i + 1 for i in fittest(counts, 5)[0]]
        assert found[fit] == found[fit + 1] == best


def test_many_fits_take_steps_without_items_as_few_do(spark):
    """Null items and missing lists count for nothing."""
    t = make_steps(spark, [Step(0, i, i, [1 + (i * i // 7 + 9 * j) % 47 for j in range(5)], 1 + i % 27) for i in range(280)], block=128)
    odd = "case when ord % 50 = 7 then transform(items, v -> cast(null as int)) when ord % 50 = 9 then cast(null as array<int>) else items end"
    t = replace(t, df=t.df.withColumn("items", F.expr(odd)))
    many = {r["ord"]: r["picks"] for r in combination_walk(t, list(range(210, 280)), 280).select("ord", "picks").collect()}
    few = {r["ord"]: r["picks"] for r in combination_walk(t, [230, 260], 280).select("ord", "picks").collect()}
    assert many[230] == few[230] and many[260] == few[260] and len(many) == 70


def test_combinations_are_fitted_on_their_whole_schedule(spark):
    rows = QUERIES["combination_picks"](spark, FOLDER).select("ord", "fit_ord").collect()
    assert sorted({r["fit_ord"] for r in rows}) == list(range(200, 1500, 10))
    assert all(0 <= r["ord"] - r["fit_ord"] < 10 for r in rows)


def test_rolled_values_join_narrow_steps(spark):
    plan = logical_plan(spark, "feature_matrix")
    assert plan.index("MapInArrow") < plan.index("Join")


def test_tail_of_a_series_is_found_by_block(spark):
    plan = logical_plan(spark, "item_frequency")
    assert "block" in plan


def test_packed_states_are_the_state_vectors_and_narrow(spark):
    t = make_steps(spark, [Step(0, i, i, [1 + (i * i + 9 * j) % 47 for j in range(5)], 1 + i % 27) for i in range(900)], block=512)
    wanted = {r["ord"]: list(r["vec"]) for r in state_vectors(t).collect()}
    blocks = _step_blocks(t, 512, 20, 25).collect()
    assert sorted(r["block"] for r in blocks) == [0, 1]
    for r in blocks:
        ords = np.frombuffer(r["ords"], "<i8")
        assert _state_matrix(r["states"], ords).tolist() == [wanted[o] for o in ords]
        assert len(r["states"]) < 300 * len(ords)  # the vectors take 1504 bytes each
