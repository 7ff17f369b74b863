"""Hierarchical language identification: the family first, then one-versus-one linear support vector machines inside it.

A text's features are counts of its byte n-grams (1 to 4 bytes of the lower-cased text, what is no letter in ASCII read as a blank) in
2^`CELL_BITS` hashed cells; the machines see them in groups of `GROUP` neighbouring cells, as square roots of shares.

* Profiles: counts of every learned language over all of its learned texts. They leave each task as dense pieces, so what is shuffled is bounded by
  tasks x languages x cells, not by words.
* Families are learned, not given: languages are joined by average linkage while two groups are more alike (Bhattacharyya
  coefficient of their profiles) than two languages are on average. A family's model is multinomial over the sum of its profiles.
* Machines: for every two languages of a family, L2-regularised squared hinge loss, solved by dual coordinate descent inside one task
  per pair. They are fitted on at most `SAMPLE` learned texts per language, those of smallest hashed id (a documented parameter; all else covers all rows).
  The language with the most wins is predicted, then the larger sum of margins, then the smaller name.
* The score is the family's posterior (by the mean log-likelihood of the n-grams, at most `EVIDENCE` of them) times the mean logistic margin of the winner.

Only text and language of learned rows are used; languages, sources and ids are no input of a prediction. Null texts and texts without a letter are `und` with score 0, as is everything where
nothing was learned. Null ids are neither held out nor learned from. Repeated rows count as often as they stand. Other columns are ignored.
What is collected and shipped to tasks grows with the number of languages only (256 KB each, 8 KB a pair).
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setstride.llm.tables import stored
from setstride.llm.textkit import LOWER, text_chunks

CELL_BITS = 14
GROUP = 8
ORDERS = (1, 2, 3, 4)
ROWS = 128
SAMPLE = 1500
EVIDENCE = 40.0
PENALTY = 10.0
EPOCHS = 300
UNKNOWN = "und"
_CELLS = 1 << CELL_BITS
_FOLD = LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _profiles(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts of cells per row) for consecutive rows; a few MB at a time besides the longest text."""
    for row, data, offsets in text_chunks(column):
        letters = _FOLD[data].astype(np.uint64)
        blank = letters == 32
        for a in range(0, len(offsets) - 1, ROWS):
            b = min(a + ROWS, len(offsets) - 1)
            lo, hi = int(offsets[a]), int(offsets[b])
            of = np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1]))
            counts = np.zeros((b - a) * _CELLS, np.int64)
            value = letters[lo:hi].copy()
            for n in ORDERS:
                size = hi - lo - n + 1
                if size <= 0:
                    break
                if n > 1:
                    value = value[:size] | (letters[lo + n - 1 : hi] << np.uint64(8 * (n - 1)))
                keep = of[:size] == of[n - 1 :]
                if n > 1:
                    keep &= ~(blank[lo : lo + size] & blank[lo + 1 : lo + 1 + size])
                cell = ((value + np.uint64(n)) * _SPREAD >> np.uint64(64 - CELL_BITS)).astype(np.int64)
                counts += np.bincount((of[:size] * _CELLS + cell)[keep], minlength=len(counts))
            yield row + a, counts.reshape(b - a, _CELLS)


def _shares(counts: np.ndarray) -> np.ndarray:
    """Square roots of shares of grouped cells; rows of length 1."""
    grouped = counts.reshape(len(counts), -1, GROUP).sum(axis=2).astype(np.float32)
    return np.sqrt(grouped / np.maximum(grouped.sum(axis=1, keepdims=True), 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, counts): the task's profile of every language that it meets."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for row, counts in _profiles(batch.column(0)):
            here = langs[row : row + len(counts)]
            for lang in set(here):
                held[lang] = held.get(lang, 0) + counts[here == lang].sum(axis=0)
    if held:
        yield pa.record_batch([pa.array(list(held)), pa.array([_packed(c) for c in held.values()], pa.binary())], ["lang", "counts"])


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob), "<i8")


def _add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CELLS, np.int64)
    for batch in batches:
        for blob in batch.column("counts"):
            total = total + _unpacked(blob.as_py())
    yield pa.record_batch([pa.array([key[0].as_py()], pa.string()), pa.array([_packed(total)], pa.binary())], ["lang", "counts"])


def families(profiles: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages joined by average linkage while two groups are more alike than two languages on average."""
    names = sorted(profiles)
    if len(names) < 2:
        return [[n] for n in names]
    roots = np.array([np.sqrt(profiles[n] / max(profiles[n].sum(), 1)) for n in names])
    alike = roots @ roots.T
    least = alike[np.triu_indices(len(names), 1)].mean()
    groups = [[i] for i in range(len(names))]
    while len(groups) > 1:
        best, a, b = max((alike[np.ix_(groups[i], groups[j])].mean(), -i, -j) for i, j in itertools.combinations(range(len(groups)), 2))
        if best <= least:
            break
        groups[-a] += groups.pop(-b)
    return [[names[i] for i in sorted(g)] for g in groups]


def fit_pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of min |w|^2 / 2 + PENALTY * sum max(0, 1 - y w.x)^2, by dual coordinate descent; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    share = np.where(y > 0, max((y < 0).sum(), 1), max((y > 0).sum(), 1)) * 2.0 / max(len(y), 1)
    diagonal = 0.5 / (PENALTY * share)
    norm = (x * x).sum(axis=1) + diagonal
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in rng.permutation(len(x)):
            slope = y[i] * (w @ x[i]) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - slope / norm[i], 0.0)
            if new != alpha[i]:
                worst = max(worst, abs(new - alpha[i]))
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def _fit(batch: pa.Table) -> pa.Table:
    """The machine of one pair of languages from its bounded sample (first, second, lang, shares)."""
    first, second = batch.column("first")[0].as_py(), batch.column("second")[0].as_py()
    rows = sorted((n, blob) for n, blob in zip(batch.column("lang").to_pylist(), batch.column("shares").to_pylist()))
    x = np.array([np.frombuffer(b, np.float32) for _, b in rows])
    w = fit_pair(x, np.array([1.0 if n == first else -1.0 for n, _ in rows]))
    return pa.table({"first": [first], "second": [second], "weights": pa.array([w.astype("<f8").tobytes()], pa.binary())})


def _sampled_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, counts in _profiles(batch.column(0)):
            blobs = [s.tobytes() for s in _shares(counts)]
            yield pa.record_batch([batch.column(1).slice(row, len(blobs)), pa.array(blobs, pa.binary())], ["lang", "shares"])


@dataclass
class Hierarchy:
    """Families, their log probabilities of cells, and the machines (first, second) -> weights and bias."""

    groups: list[list[str]]
    models: np.ndarray
    machines: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, counts: np.ndarray) -> tuple[list[str], list[float]]:
        total = np.maximum(counts.sum(axis=1), 1)
        mean = counts @ self.models.T / total[:, None]
        odds = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(total, EVIDENCE)[:, None])
        posterior = odds / odds.sum(axis=1, keepdims=True)
        family = mean.argmax(axis=1)
        names, scores = np.empty(len(counts), object), posterior[np.arange(len(counts)), family]
        shares = _shares(counts)
        for f in np.unique(family):
            here = np.flatnonzero(family == f)
            names[here], scores[here] = self._within(self.groups[f], shares[here], scores[here])
        return names.tolist(), scores.tolist()

    def _within(self, langs: list[str], shares: np.ndarray, scores: np.ndarray):
        if len(langs) == 1:
            return langs[0], scores
        wins, margins, sure = (np.zeros((len(shares), len(langs))) for _ in range(3))
        for i, j in itertools.combinations(range(len(langs)), 2):
            w = self.machines[langs[i], langs[j]]
            margin = shares @ w[:-1] + w[-1]
            chance = 1 / (1 + np.exp(-2 * margin))
            wins[:, i] += margin >= 0
            wins[:, j] += margin < 0
            margins[:, i] += margin
            margins[:, j] -= margin
            sure[:, i] += chance
            sure[:, j] += 1 - chance
        best = np.array([max(range(len(langs)), key=lambda k: (wins[r, k], margins[r, k], -k)) for r in range(len(shares))])
        return np.array(langs, object)[best], scores * sure[np.arange(len(best)), best] / (len(langs) - 1)


def learn(learned: DataFrame, sample: int = SAMPLE) -> Hierarchy | None:
    """The hierarchy of (doc_id, text, lang) rows without nulls; None where there are none."""
    counted = learned.select("text", "lang").mapInArrow(_count, "lang string, counts binary").withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(32)).cast("int"))
    total = counted.groupBy("lang", "part").applyInArrow(_add, "lang string, counts binary").groupBy("lang").applyInArrow(_add, "lang string, counts binary")
    profiles = {r["lang"]: _unpacked(r["counts"]) for r in total.toLocalIterator()}  # one row per language
    if not profiles:
        return None
    groups = families(profiles)
    sums = np.array([sum(profiles[n] for n in g) for g in groups], float) + 0.5
    hierarchy = Hierarchy(groups, np.log(sums / sums.sum(axis=1, keepdims=True)))
    pairs = [p for g in groups for p in itertools.combinations(g, 2)]
    if pairs:
        spark = learned.sparkSession
        place = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = learned.select("doc_id", "lang").distinct().withColumn("at", F.row_number().over(place)).where(F.col("at") <= sample)
        picked = F.broadcast(chosen.select("doc_id", "lang"))  # `sample` rows per language at most
        texts = learned.join(picked, ["doc_id", "lang"]).select("doc_id", "lang", "text").dropDuplicates(["doc_id", "lang"])
        shares = stored(texts.select("text", "lang").mapInArrow(_sampled_shares, "lang string, shares binary"), "language-sample")
        of = spark.createDataFrame([(n, *p) for p in pairs for n in p], "lang string, first string, second string")
        fitted = shares.join(of, "lang").groupBy("first", "second").applyInArrow(_fit, "first string, second string, weights binary")
        hierarchy.machines = {(r["first"], r["second"]): np.frombuffer(r["weights"], "<f8") for r in fitted.toLocalIterator()}  # one row per pair
    return hierarchy


def _predict(hierarchy: Hierarchy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = np.array(batch.column("lettered").to_pylist(), bool)
            names, scores = [], []
            for _, counts in _profiles(batch.column("text")):
                n, s = hierarchy.predict(counts)
                names += n
                scores += s
            names = [n if ok else UNKNOWN for n, ok in zip(names, lettered)]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(np.where(lettered, scores, 0.0) if len(scores) else [], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the rows that are not held out."""
    text = F.col("text").cast("string")
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text.alias("text"), F.col("lang").cast("string").alias("lang"))
    learned = rows.where(~F.col("held_out") & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    hierarchy = learn(learned.select("doc_id", "text", "lang"), sample)
    asked = rows.select("doc_id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    if hierarchy is None:
        return asked.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = f"doc_id {asked.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double"
    return asked.mapInArrow(_predict(hierarchy), schema)
