"""Naive loops, no look-ahead, and independence from blocks, partitions and neighbouring series."""

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import FOLDER, Step, make_steps
from setstride.operators import neighbours
from setstride.operators.layout import SERIES, ordinal
from setstride.operators.neighbours import nearest
from setstride.operators.pairs import context_state, sparse_transitions, transition_matrix
from setstride.operators.scorers import block_scorer, predictions
from setstride.operators.signal import feature_grid
from setstride.operators.state import as_of_previous, gap_stats, slot_state, sparse_gaps
from setstride.streaming.incremental import STATE, advance_state


def random_steps(n, series=0, seed=1):
    rng = random.Random(seed)
    return [Step(series, 1000 * (series + 1) + i, i // 2, rng.sample(range(1, 48), 5), rng.randint(1, 27)) for i in range(n)]


@pytest.fixture(scope="module")
def steps():
    return random_steps(300)


@pytest.fixture(scope="module")
def small_blocks(spark, steps):
    return make_steps(spark, steps, block=128)


def picks_by_naive_loop(steps, i):
    seen, recent = [s.items for s in steps[:i]], lambda w: [s.items for s in steps[max(0, i - w):i]]
    count = lambda rows: Counter(n for r in rows for n in r)
    every, last50, last20 = count(seen), count(recent(50)), count(recent(20))
    frequency = {n: 50 * every[n] + 30 * last50[n] + 20 * last20[n] for n in range(1, 48)}
    gap = {n: next((k for k, r in enumerate(reversed(seen)) if n in r), i) for n in range(1, 48)}
    weight = {n: np.exp(gap[n] - max(gap.values())) for n in gap}
    blend = {n: round(0.5 * every[n] / (5 * i) + 0.5 * weight[n] / sum(weight.values()), 12) for n in gap}
    moves = defaultdict(Counter)
    for a, b in zip(seen, seen[1:]):
        for x in a:
            moves[x].update(b)
    markov = Counter()
    for c in sorted(seen[-1]):
        total = sum(moves[c].values())
        for n in range(1, 48):
            markov[n] += moves[c][n] / total if total else 1 / 47
    markov = {n: round(markov[n], 12) for n in range(1, 48)}
    top = lambda s: [n for n, _ in sorted(s.items(), key=lambda e: (-e[1], e[0]))[:5]]
    return {"frequency": top(frequency), "bayesian": top(blend), "markov": top(markov)}


def test_scorers_match_a_naive_loop(small_blocks, steps):
    got = defaultdict(dict)
    for r in predictions(small_blocks).collect():
        got[r["ord"]][r["model"]] = r["picks"]
    for i in (1, 2, 21, 127, 128, 129, 255, 256, 299):
        assert got[i] == picks_by_naive_loop(steps, i), i


def test_span_equals_full_walk(small_blocks):
    full = {(r["model"], r["ord"]): r["score"] for r in predictions(small_blocks).where("ord between 120 and 139").collect()}
    part = {(r["model"], r["ord"]): r["score"] for r in predictions(small_blocks, span=(120, 140)).collect()}
    assert part == full and len(part) == 60


def test_no_look_ahead(spark, steps, small_blocks):
    changed = steps[:200] + [s._replace(items=[1, 2, 3, 4, 5], special=1) for s in steps[200:]]
    other = make_steps(spark, changed, block=128)
    keep = lambda t: {(r["model"], r["ord"]): (r["score"], r["special_pick"]) for r in predictions(t).where("ord <= 200").collect()}
    assert keep(other) == keep(small_blocks)


def test_block_size_does_not_matter(spark, steps, small_blocks):
    whole = make_steps(spark, steps)
    assert whole.block > 300
    windows, want = (5, 100), ("cnt", "last", "first", "gsq")
    for a, b in [(slot_state(whole, windows, want), slot_state(small_blocks, windows, want)),
                 (context_state(whole, "same"), context_state(small_blocks, "same")), (feature_grid(whole), feature_grid(small_blocks))]:
        drop = [c for c in ("block",) if c in a.columns]
        assert sorted(map(str, a.drop(*drop).collect())) == sorted(map(str, b.drop(*drop).collect()))


def test_series_are_independent(spark, steps, small_blocks):
    """One long series beside many short ones gives each the same state as alone."""
    others = [s for k in range(1, 6) for s in random_steps(20, series=k, seed=k)]
    both = make_steps(spark, steps + others, block=128)
    alone = sorted(map(str, slot_state(small_blocks, (20,)).collect()))
    assert sorted(map(str, slot_state(both, (20,)).where(F.col(SERIES) == 0).collect())) == alone
    third = make_steps(spark, [s for s in others if s.series == 3])
    assert sorted(map(str, context_state(both).where(F.col(SERIES) == 3).collect())) == sorted(map(str, context_state(third).collect()))


def test_ordinal_does_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 0, 0, 1, 2]), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, f"{SERIES} int, ts int, id int")
    expect = {}
    for s in (0, 1, 2):
        expect |= {r[2]: k for k, r in enumerate(sorted(r for r in rows if r[0] == s))}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert {r["id"]: r["ord"] for r in ordinal(df, ["ts", "id"]).collect()} == expect
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_transition_rows_sum_to_one(small_blocks):
    rows = transition_matrix(small_blocks).groupBy("from_item").agg(F.sum("prob").alias("p"), F.count("*").alias("n")).collect()
    assert len(rows) == 47 and all(r["n"] == 47 and r["p"] == pytest.approx(1) for r in rows)


def hot_events(n=2000):
    """Events of which one user holds two thirds and one item most."""
    rng = random.Random(5)
    return [(rng.choice([1, 1, 2]), i, i, rng.choice("aaaab"), float(i)) for i in range(n)]


def test_hot_series_in_small_blocks(spark):
    rows = hot_events()
    df = ordinal(spark.createDataFrame(rows, f"{SERIES} int, ts int, event_id int, item string, value double"), ["ts", "event_id"])
    by_user, gaps, moves, asked = defaultdict(list), {}, Counter(), {}
    for user, _, event, item, value in rows:
        past = by_user[user]
        if past:
            moves[past[-1][1], item] += 1
        if item == "b":
            asked[event] = next((v for _, i, v in reversed(past) if i == "a"), None)
        back = next((k + 1 for k, (_, i, _) in enumerate(reversed(past)) if i == item), None)
        gaps[event] = back
        past.append((event, item, value))
    for size in (16, 4096):
        assert {r["event_id"]: r["gap"] for r in sparse_gaps(df, size).collect()} == gaps
        assert {(r["from_item"], r["to_item"]): r["n"] for r in sparse_transitions(df, size).collect()} == moves
        found = as_of_previous(df, F.col("item") == "b", {"v": F.when(F.col("item") == "a", F.col("value"))}, size)
        assert {r["event_id"]: r["prev_v"] for r in found.collect()} == asked


def test_online_state_equals_batch(spark):
    schema = f"{SERIES} long, ts int, event_id int, item string, value double"
    rows = hot_events(600)
    state, emitted = spark.createDataFrame([], STATE), {}
    for part in (rows[:100], rows[100:450], rows[450:]):
        out, state = advance_state(state, spark.createDataFrame(part, schema).drop("value"))
        emitted |= {r["event_id"]: r["gap"] for r in out.collect()}
        state = spark.createDataFrame(state.collect(), STATE)
    whole = ordinal(spark.createDataFrame(rows, schema), ["ts", "event_id"])
    assert emitted == {r["event_id"]: r["gap"] for r in sparse_gaps(whole, 4096).collect()}
    batch = {(r[SERIES], r["item"]): (r["appearances"], r["last_ord"]) for r in gap_stats(whole, 4096).collect()}
    assert {(r[SERIES], r["item"]): (r["appearances"], r["last_ord"]) for r in state.collect()} == batch


def test_nearest_paths_agree_with_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    vectors = rng.integers(0, 4, size=(200, 3)).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vec array<double>").repartition(5)
    queries = df.where("id < 20")
    expect = {
        q: [i for _, i in sorted((np.sqrt(((vectors[i] - vectors[q]) ** 2).sum()), i) for i in range(200) if i != q)[:4]] for q in range(20)
    }
    def gather(frame):
        got = defaultdict(list)
        for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["distance"], r["neighbour_id"])):
            got[r["query_id"]].append(r["neighbour_id"])
        return {q: ids[:4] for q, ids in got.items()}
    assert gather(nearest(queries, df, 4, skip_self=True)) == expect
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    monkeypatch.setattr(neighbours, "BASE_BLOCK", 30)
    assert gather(nearest(queries, df, 4, skip_self=True)) == expect


def test_user_scorer_sees_its_halo(small_blocks, steps):
    def last_seen_twice(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for j, own in enumerate(pdf["own"]):
            if own:
                past = pdf["items"].iloc[max(0, j - 2):j]
                rows.append((pdf["ord"].iloc[j], [float(sum(n in p for p in past)) for n in range(1, 48)]))
        return pd.DataFrame(rows, columns=["ord", "score"])

    got = {r["ord"]: r["score"] for r in block_scorer("twice", 2, last_seen_twice)(small_blocks, None).collect()}
    for i in (2, 127, 128, 129, 299):
        assert got[i] == [float(sum(n in s.items for s in steps[i - 2:i])) for n in range(1, 48)]


def test_neighbour_queries_grow_with_the_table(spark):
    from setstride.plans import QUERIES
    from setstride.plans.common import table

    ids = {r["vec_id"] for r in table(spark, FOLDER, "embeddings").select("vec_id").collect()}
    found = QUERIES["embedding_neighbours_by_50"](spark, FOLDER).collect()
    assert sorted((r["query_id"], r["rank"]) for r in found) == [(q, k) for q in sorted(ids) if q % 50 == 0 for k in range(1, 11)]
