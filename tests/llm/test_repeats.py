"""Suffix sorting and the removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from llm_cases import awkward, empty  # noqa: F401

from setstride.llm import repeats
from setstride.llm.suffix_sort import common_prefix_reaches, suffix_array


def brute(texts, length):
    """Removed bytes of each text: windows counted in a dictionary."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


def expected(rows, length):
    rows = [(i, (t or "").encode()) for i, t in rows]
    out = []
    for (i, t), gone in zip(rows, brute([t for _, t in rows], length)):
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("alphabet", [b"ab", b"abc\xff", b"a", bytes(range(1, 256))])
def test_suffix_array_is_sorted(alphabet):
    rng = random.Random(alphabet)
    for _ in range(60):
        t = bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 90)))
        data = np.frombuffer(t, np.uint8)
        order = suffix_array(data, 4096)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        same = common_prefix_reaches(data, order, 8)
        assert same.tolist() == [t[a : a + 8] == t[b : b + 8] and max(a, b) + 8 <= len(t) for a, b in zip(order, order[1:])]


@pytest.mark.parametrize("length, hot", [(200, 4096), (70, 3), (12, 2)])
def test_cut_equals_brute_force(spark, length, hot):
    rng = random.Random(length)
    passages = [" ".join(f"p{rng.randrange(10**5)}" for _ in range(60)) for _ in range(4)]
    texts = [" ".join([f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))] + [rng.choice(passages)[: rng.randint(1, 400)] for _ in range(rng.randint(0, 3))]) for _ in range(60)]
    texts += texts[:5] + ["ab" * 300, "b" * 500, "é€" * 150, "", None, passages[0][:199], passages[0][:200]]
    rows = [(i // 2 if i > 50 else i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[3])]
    found = repeats.cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), length, hot)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in found.collect()), key=repr)
    assert got == expected(rows, length)


def test_awkward_rows_and_empty_table(awkward, empty):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in repeats.cut(awkward).collect()]
    assert sorted(got, key=repr) == expected(rows, 200)
    assert repeats.cut(empty).count() == 0
