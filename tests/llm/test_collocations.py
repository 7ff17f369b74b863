"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import LOWER, awkward, empty  # noqa: F401

from setstride.llm import collocations as col


def brute(rows, least, longest, top, share=100):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        cover = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    cover[p[s : s + m]] = max(cover[p[s : s + m]], a)
        rows = []
        for p, a in found.items():
            cuts = [(1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            if p not in cover or 100 * cover[p] < share * a:
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(df):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def some_texts():
    rng = random.Random(8)
    common = [rng.choice(["of the", "in  spite\tof", "São Paulo é", "New york CITY hall now then", "a a a a"]) for _ in range(500)]
    rows = []
    for i in range(80):
        words = [rng.choice(common) if rng.random() < 0.4 else f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randint(1, 60))]
        rows.append(("".join(w + rng.choice([" "] * 8 + [". ", ",", "\n", "! "]) for w in words), rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", "en"), (" \t ", None), (".;!", "fr"), ("odd\x1cword x " * 40, "fr")] + rows[:3]


@pytest.mark.parametrize("least,longest,top,share", [(5, 5, 2000, 100), (3, 4, 7, 90), (10, 2, 2000, 100)])
def test_collocations_are_those_of_plain_counting(spark, monkeypatch, least, longest, top, share):
    monkeypatch.setattr(col, "CHUNK", 2000)
    rows = some_texts()
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "text string, lang string, n int, phrase string").repartition(4)
    expected = brute(rows, least, longest, top, share)
    assert expected and found(col.collocations(df, least, longest, top, share)) == expected


def test_awkward_rows_and_empty_table(awkward, empty):
    rows = [(r["text"], r["lang"]) for r in awkward.collect()]
    assert found(col.collocations(awkward, 20)) == brute(rows, 20, 5, 2000)
    assert col.collocations(empty).count() == 0


@pytest.mark.parametrize("merge", [1, 1 << 20])
def test_summary_keeps_every_frequent_value(monkeypatch, merge):
    monkeypatch.setattr(col, "MERGE", merge)
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(0, 1 << 62, 40000, dtype=np.uint64), np.repeat(np.arange(30, dtype=np.uint64), 100), np.repeat(np.arange(100, 130, dtype=np.uint64), 99)])
    rng.shuffle(values)
    summary = col.Summary(len(values) // 100 + 1)
    for block in np.array_split(values, 300):
        summary.add(*np.unique(block, return_counts=True))
    kept = set(summary.frequent(100).tolist())
    assert kept >= set(range(30)) and len(kept) <= summary.capacity and summary.lost < 100
