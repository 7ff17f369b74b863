"""The conversation trie against a plain one."""

import hashlib
import random
import zlib

import pytest

from setstride.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, top long, m string, pos int"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    members = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out, sums = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves = sum(sums[k][0] for k in kids) if kids else 1
        saved = sum(sums[k][1] for k in kids) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        sums[p] = leaves, saved
        ends = ",".join(str(c) for c in sorted(members[p]) if len(made[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out[min(members[p]), len(p)] = (parent, len(members[p]), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    assert len({(r["conv_id"], r["depth"]) for r in rows}) == len(rows)
    names = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return {(r["conv_id"], r["depth"]): tuple(r[n] for n in names) for r in rows}


def some_conversations():
    rng = random.Random(3)
    rows = []
    for c in range(60):
        if c in (10, 35):
            continue  # groups without a first conversation
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "ok é", "", None, f"t{t}"])))
    for c in range(100, 140):  # copies, each a turn longer than some other
        rows += [(c, t, "user", f"same {t}") for t in range((c - 100) // 2)]
    rows += [(200, t, "user", f"long {t % 7}") for t in range(900)] + [(205, t, "user", f"long {t % 7}") for t in range(700)]
    rows += [(300, None, "user", "no turn"), (300, 0, "user", "first"), (300, None, "user", "no turn"), (300, 4, None, None), (None, 1, "user", "no id")]
    rows += [(305, 1, "user", "x")] * 3
    return rows


@pytest.mark.parametrize("local", [0, 40, 10**6])
def test_nodes_are_those_of_a_plain_trie(spark, monkeypatch, local):
    monkeypatch.setattr(prefix_trie, "ID_BITS", 3)
    rows = some_conversations()
    df = spark.createDataFrame([(*r, 7, "m", 1) for r in rows], SCHEMA).repartition(5)
    if local == 0:
        small = [r for r in rows if r[0] is None or r[0] < 30 or r[0] == 305]
        rows, df = small, spark.createDataFrame([(*r, 7, "m", 1) for r in small], SCHEMA)
    assert found(prefix_trie.rebuilt_trie(df, local=local)) == brute(rows)


def test_prefix_keys_do_not_depend_on_blocks(spark):
    df = spark.createDataFrame([(*r, 7, "m", 1) for r in some_conversations()], SCHEMA)
    turns, _ = prefix_trie.rebuilt(prefix_trie.numbered_turns(df))
    whole = {(r["conv_id"], r["pos"]): (r["k1"], r["k2"], r["p1"], r["p2"]) for r in prefix_trie.prefixes(turns).collect()}
    cut = {(r["conv_id"], r["pos"]): (r["k1"], r["k2"], r["p1"], r["p2"]) for r in prefix_trie.prefixes(turns, 16).collect()}
    assert whole == cut


def test_turnless_and_empty(spark):
    only = spark.createDataFrame([(3, 1, "user", "a", 1, "m", 1), (7, 1, "user", "a", 1, "m", 1)], SCHEMA)
    assert found(prefix_trie.rebuilt_trie(only)) == brute([(3, 1, "user", "a"), (7, 1, "user", "a")])
    assert prefix_trie.rebuilt_trie(only.limit(0)).count() == 0
