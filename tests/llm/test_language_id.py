"""Language identification: held-out accuracy, and its parts against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_cases import awkward, empty  # noqa: F401

from setstride.llm import language_id as lid

# invented languages: two pairs that share most of their syllables, and one apart
SYLLABLES = {
    "aa": ["ka", "to", "mi", "ru", "sen", "lo"], "ab": ["ka", "to", "mi", "ru", "sen", "va"],
    "ba": ["schn", "ug", "elt", "wo", "br", "än"], "bb": ["schn", "ug", "elt", "wo", "br", "øn"], "cc": ["жи", "ло", "бы"],
}


def text_of(rng, lang, words=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(words))


def corpus(n=300, words=60):
    rng = random.Random(1)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    return [(i, text_of(rng, lang, words), lang, "lang") for i, lang in enumerate(langs)]


def test_held_out_languages_are_found_and_labels_of_held_out_rows_never_read(spark):
    rows = corpus()
    out = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    hidden = [(i, t, "wrong" if i in out else lang, s) for i, t, lang, s in rows]
    schema = "doc_id long, text string, lang string, score string"
    found = {r["doc_id"]: r for r in lid.identify(spark.createDataFrame(hidden, schema).repartition(4)).collect()}
    assert {i for i, r in found.items() if r["held_out"]} == out
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in SYLLABLES for r in found.values())
    assert np.mean([found[i]["lang_pred"] == lang for i, _, lang, _ in rows if i in out]) > 0.97
    none = [(i, t, None if i in out else lang, s) for i, t, lang, s in rows]
    again = {r["doc_id"]: r for r in lid.identify(spark.createDataFrame(none, schema).repartition(2)).collect()}
    assert {i: (r["lang_pred"], round(r["score"], 9)) for i, r in found.items()} == {i: (r["lang_pred"], round(r["score"], 9)) for i, r in again.items()}


def test_related_languages_make_a_family():
    profiles = {}
    for _, text, lang, _ in corpus():
        counts = next(lid._profiles(pa.array([text])))[1][0]
        profiles[lang] = profiles.get(lang, 0) + counts
    assert lid.families(profiles) == [["aa", "ab"], ["ba", "bb"], ["cc"]]
    assert lid.families({}) == [] and lid.families({"x": np.ones(4)}) == [["x"]]


def test_profiles_are_counted_byte_grams():
    texts = ["Ab, 12 cd", None, "", "é" * 5, "x", "A" * 3000, "a b  c"]
    got = np.concatenate([c for _, c in lid._profiles(pa.array(texts))])
    assert len(got) == len(texts)
    for text, counts in zip(texts, got):
        raw = bytes((b + 32 if 65 <= b <= 90 else b) if b > 127 or chr(b).isalpha() else 32 for b in (text or "").encode())
        cells = Counter()
        for n in lid.ORDERS:
            for i in range(len(raw) - n + 1):
                if raw[i : i + 2] != b"  " or n == 1:
                    value = int.from_bytes(raw[i : i + n], "little") + n
                    cells[(value * 0x9E3779B97F4A7C15 % 2**64) >> (64 - lid.CELL_BITS)] += 1
        assert dict(zip(np.flatnonzero(counts).tolist(), counts[counts > 0].tolist())) == dict(cells)


def test_machine_reaches_the_minimum():
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(60, 6))).astype(np.float32)
    y = np.where(x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    w = lid.fit_pair(x, y)
    full = np.hstack([x, np.ones((60, 1))])
    share = np.where(y > 0, (y < 0).sum(), (y > 0).sum()) * 2 / 60

    def value(v):
        return v @ v / 2 + lid.PENALTY * (share * np.maximum(0, 1 - y * (full @ v)) ** 2).sum()

    v = np.zeros(7)
    for _ in range(20000):  # plain gradient descent
        loss = np.maximum(0, 1 - y * (full @ v))
        v -= 1e-4 * (v - 2 * lid.PENALTY * full.T @ (share * loss * y))
    assert value(w) <= value(v) * 1.01


def test_awkward_rows_and_nothing_to_learn_from(spark, awkward, empty):
    found = lid.identify(awkward).collect()
    assert len(found) == awkward.count()
    texts = {r["doc_id"]: r["text"] for r in awkward.collect()}
    for r in found:
        lettered = any(c.isalpha() for c in texts[r["doc_id"]] or "")
        assert r["lang_pred"] == ("en" if lettered else "und") and (lettered or r["score"] == 0)
    assert lid.identify(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in lid.identify(unlabelled).collect()} == {("und", 0.0)}
