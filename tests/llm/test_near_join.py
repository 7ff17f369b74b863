"""The n-gram Jaccard join against all pairs."""

import itertools
import random

import numpy as np
import pytest
from llm_cases import LOWER, WORD, awkward, empty  # noqa: F401

from setstride.llm import near_join
from setstride.llm.components import components
from setstride.llm.near_join import Similarity


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, rule):
    sets = {i: shingles(t, rule.words) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= rule.per_hundred * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("rule", [Similarity(3, 90), Similarity(5, 80), Similarity(2, 50)])
def test_classes_are_those_of_all_pairs(spark, awkward, rule):
    rows = {r["doc_id"]: r["text"] for r in awkward.collect() if r["doc_id"] is not None}
    found = near_join.classes(awkward, rule).collect()
    assert len(found) == awkward.count()
    expected = brute(rows.items(), rule)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]]


def test_one_document_of_each_stays(awkward):
    rule = Similarity(3, 90)
    kept = near_join.one_of_each(awkward, rule)
    assert kept.columns == awkward.columns
    expected = {i for i, (_, c) in brute({r["doc_id"]: r["text"] for r in awkward.collect() if r["doc_id"] is not None}.items(), rule).items() if i == c}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 1


def test_empty_table(empty):
    assert near_join.classes(empty).count() == 0
    assert near_join.one_of_each(empty).count() == 0


@pytest.mark.parametrize("rule", [Similarity(3, 90), Similarity(5, 80), Similarity(3, 60)])
@pytest.mark.parametrize("bounds", [(300, 300), (0, 0), (0, 128), (100, 180)])
def test_similar_sets_share_a_signature(rule, bounds):
    """For any split of tokens into classes, whichever they are."""
    rng = random.Random(repr((rule, bounds)))
    order = np.random.default_rng(1).integers(0, 256, 1 << near_join.CELL_BITS).astype(np.uint8)
    bounds = np.array(bounds)
    tried = 0
    for _ in range(400):
        n = rng.choice([4, 5, 8, 9, 10, 11, 15, 16, 17, 31, 33, 60, 130, 700])
        x = [rng.getrandbits(64) for _ in range(n)]
        y = x[: n - rng.randint(0, n // 5 + 1)] + [rng.getrandbits(64) for _ in range(rng.randint(0, n // 8 + 1))]
        a, b = np.unique(np.array(x, np.uint64)), np.unique(np.array(y or x, np.uint64))
        common = len(np.intersect1d(a, b))
        if np.array_equal(a, b) or 100 * common < rule.per_hundred * (len(a) + len(b) - common):
            continue
        tried += 1
        s, t = near_join.signatures(a, order, bounds, rule), near_join.signatures(b, order, bounds, rule)
        assert len(np.intersect1d(s, t)), (len(a), len(b), common)
    assert tried > 40


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + [(7, 7), (3, 2), (500, 499)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 180)}, 499: 499, 500: 499}


def test_members_meet_without_lists_of_their_signatures(spark, monkeypatch):
    """Such a list in every row of a node grew the disk with the square of its signatures."""
    from setstride.llm import near_join

    dealt = []
    plain = near_join._dealt
    monkeypatch.setattr(near_join, "_dealt", lambda members, *more: dealt.append((members.dtypes, more)) or plain(members, *more))
    words = [f"w{i}" for i in range(120)]
    texts = [(k, " ".join([*words[: 100 + k], *[f"x{k}y{j}" for j in range(25 * (k % 2))]])) for k in range(8)]
    docs = spark.createDataFrame([*texts, (9, None)], "doc_id long, text string")
    near_join.classes(docs, near_join.Similarity(words=5, per_hundred=80)).collect()
    assert len(dealt) == 2
    for types, more in dealt:
        assert not any(t.startswith("array<bigint") for _, t in types) and "all" not in more


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"x{rng.getrandbits(40)}"
    return " ".join(words)


def test_pairs_do_not_leave_every_group_they_share(spark, monkeypatch):
    """Near copies that just miss the threshold share hundreds of signatures; each pair left that many times."""
    dealt = []
    plain = near_join._dealt
    monkeypatch.setattr(near_join, "_dealt", lambda *args: dealt.append(plain(*args)) or dealt[-1])
    rng, rule = random.Random(3), Similarity(5, 80)
    words = [f"w{i}" for i in range(1504)]
    rows = [(k, edited(rng, words, 25)) for k in range(10)]
    found = near_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows, rule)
    met = dealt[1].mapInArrow(near_join._meet(rule), "a long, b long")
    pairs = met.distinct().count()
    assert pairs > 20 and met.count() <= 2 * pairs


def test_links_that_no_leader_has_seen_are_found_by_the_closest(spark):
    """Two families around a text that is like neither: its groups hold both, and each family's links are its own."""
    rng, rule = random.Random(4), Similarity(3, 60)
    words = [f"w{i}" for i in range(200)]
    families = [edited(rng, words, 12).split(" ") for _ in range(3)]
    rows = [(k, edited(rng, families[k % 3], k % 5)) for k in range(30)] + [(30, " ".join(words))]
    found = near_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows, rule)


@pytest.mark.parametrize("together", [True, False])
def test_pairs_without_a_common_first_signature_leave_each_group(together):
    import pyarrow as pa

    size, groups = 5, [3, 5, 9]
    sketch = near_join._sketches([near_join._sketch(np.arange(100, dtype=np.uint64) << np.uint64(20))] * size * len(groups))
    node = np.tile(np.arange(size), len(groups))
    columns = {"signature": np.repeat(groups, size), "low": 0 * node, "high": 0 * node, "block": 0 * node, "node": node, "root": node, "n": 100 + 0 * node, "shared": 100 + 0 * node}
    firsts = {name: 0 * node + min(5, 3 + 2 * i) if together else 100 + node for i, name in enumerate(near_join._FIRSTS)}
    batch = pa.record_batch([*[pa.array(c) for c in columns.values()], sketch, *[pa.array(c) for c in firsts.values()]], [*columns, "sketch", *firsts])
    met = [(a, b) for out in near_join._meet(Similarity())(iter([batch])) for a, b in zip(*(c.to_pylist() for c in out.columns))]
    assert sorted(met) == sorted(list(itertools.combinations(range(size), 2)) * (1 if together else len(groups)))


@pytest.mark.parametrize("share", [0.95, 0.9, 0.85])
def test_sketches_tell_sets_below_the_threshold_apart(spark, share):
    """Never a linked pair; sets of 150 tokens with a similarity of 0.74 could hold by the sums of 64 cells."""
    rng, rule = np.random.default_rng(6), Similarity(5, 80)
    sets = [[rng.integers(0, 2**63, 150, np.uint64) for _ in range(200)] for _ in range(2)]
    for x, y in zip(*sets):
        y[: round(150 * share)] = x[: round(150 * share)]
    rows = [(150, 150, near_join._sketch(x).tolist(), near_join._sketch(y).tolist()) for x, y in zip(*sets)]
    could = spark.createDataFrame(rows, "na int, nb int, sa array<int>, sb array<int>").where(rule.could_hold("na", "nb", "sa", "sb")).count()
    linked = sum(rule.per_hundred * len(np.union1d(x, y)) <= 100 * len(np.intersect1d(x, y)) for x, y in zip(*sets))
    assert linked <= could <= linked + 20
