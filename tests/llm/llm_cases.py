"""Texts and word rules that the llm tests share."""

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, rules string, h int, root double"


def sentence(rng, n, words=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(n))


def awkward_texts():
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(30, 120)) for _ in range(25)]
    texts = list(base)
    for t in base[:12]:  # near copies of near copies
        words = t.split(" ")
        for _ in range(4):
            words = list(words)
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += base[:5]  # exact copies
    texts += [None, "", "   \t\n", "one", "one", "two words", "two words", "three short words", "Three SHORT words"]
    texts += [sentence(rng, 9, 10**6), "a " * 3000, "x" * 5000, "x" * 5000, "é ü " * 40, "\x1c\x85 odd blank " * 3]
    texts += [" ".join(f"line{i}" for i in range(20000))]
    return texts


@pytest.fixture(scope="module")
def awkward(spark):
    """Rows with nulls, empty, short and very long texts, copies, a repeated row, and extra columns of clashing names."""
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), "x", None, i, 0.5) for i, t in enumerate(awkward_texts())]
    rows += [rows[3], (None, "a text without id " * 20, "en", None, 5, None, "y", None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    """Labels for the awkward rows: copies of the first texts are good, later ones not; some null and repeated."""
    rows = [(i, int(i < 60), int(i % 7 == 0)) for i in range(0, 90, 2)] + [(2, 1, 0), (4, None, 0), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
