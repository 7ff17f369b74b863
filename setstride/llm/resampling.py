"""Importance resampling: the ratio of two hashed n-gram models as weight, Gumbel top-k as the draw.

Both models are bags of unigrams and bigrams in 2^20 cells: the target over the labelled good documents, the raw one over all
documents. A document's log weight is the sum of the log ratios of its n-grams; adding an independent Gumbel variable and taking the
k largest draws k documents without replacement, with chances by weight. The variables come from a hash of the id and the seed, so a
re-run task draws the same.

* Raw counts cover all documents. The target model is fitted on at most `sample` labelled documents, those of smallest hash.
* Counts leave each task as dense pieces of the two tables, so what is shuffled is bounded by the tables, not by the words.
* The k-th largest key is found by counting keys by their leading bits, 12 bits a round; no global sort, no row moves.

By default k is the share of good documents among the labelled times the number of documents. Null and blank texts weigh 0, as the empty product. Equal keys are
taken in the order of the id, null ids first; exact repeats of a row share their key and may exceed k. Without good labels all weights are 0: a uniform draw.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.llm.tables import stored
from setstride.llm.textkit import grams, mix, text_chunks, word_hashes

CELL_BITS = 20
RANGES = 64
SAMPLE = 20_000
PRIOR = 8.0
DIGIT = 12


def _cells(words: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all unigrams and of the bigrams inside rows, and the row of each."""
    rows = np.repeat(np.arange(len(index) - 1), np.diff(index))
    one, two = mix(words), grams(words, 2)
    inside = rows[:-1] == rows[1:] if len(rows) else np.zeros(0, bool)
    shift = np.uint64(64 - CELL_BITS)
    return np.concatenate([one >> shift, two[inside] >> shift]).astype(np.int64), np.concatenate([rows, rows[:-1][inside]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, target): the task's counts of raw and target cells in `RANGES` pieces."""
    raw, target = np.zeros(1 << CELL_BITS, np.int64), np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        chosen = np.array(batch.column(1).to_pylist(), bool)
        for row, data, offsets in text_chunks(batch.column(0)):
            words, index, _, _ = word_hashes(data, offsets)
            cells, of = _cells(words, index)
            raw += np.bincount(cells, minlength=len(raw))
            own = chosen[row : row + len(offsets) - 1]
            if own.any():
                target += np.bincount(cells[own[of]], minlength=len(raw))
    if raw.any():
        yield _pieces(raw, target)


def _pieces(raw: np.ndarray, target: np.ndarray) -> pa.RecordBatch:
    cut = lambda x: [p.astype("<i8").tobytes() for p in np.split(x, RANGES)]
    return pa.record_batch([pa.array(range(RANGES), pa.int32()), pa.array(cut(raw), pa.binary()), pa.array(cut(target), pa.binary())], ["range", "raw", "target"])


def _add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the pieces of one range, one piece in memory at a time."""
    raw, target = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for batch in batches:
        for a, b in zip(batch.column("raw"), batch.column("target")):
            raw = raw + np.frombuffer(a.as_buffer(), "<i8")
            target = target + np.frombuffer(b.as_buffer(), "<i8")
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([raw.tobytes()], pa.binary()), pa.array([target.tobytes()], pa.binary())], ["range", "raw", "target"])


_TABLES = "range int, raw binary, target binary"


def log_ratios(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Log ratio of target to raw share of every cell (2^20 floats)."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    good = _good(labels).where("good").orderBy(*order).limit(sample).select("doc_id", F.lit(True).alias("target"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    flagged = rows.join(F.broadcast(good), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))  # `sample` rows at most
    parts = flagged.mapInArrow(_count, _TABLES).withColumn("part", F.pmod(F.xxhash64("raw"), F.lit(32)))
    total = parts.groupBy("range", "part").applyInArrow(_add, _TABLES).groupBy("range").applyInArrow(_add, _TABLES)
    raw, target = np.zeros((RANGES, (1 << CELL_BITS) // RANGES)), np.zeros((RANGES, (1 << CELL_BITS) // RANGES))
    for row in total.collect():  # RANGES rows
        raw[row["range"]] = np.frombuffer(row["raw"], "<i8")
        target[row["range"]] = np.frombuffer(row["target"], "<i8")
    raw, target = raw.ravel(), target.ravel()
    if not target.sum():
        return np.zeros(len(raw), np.float32)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + PRIOR) / (expected + PRIOR)).astype(np.float32)


def _good(labels: DataFrame) -> DataFrame:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return known.where("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))


def _weigh(ratios: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, counts = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for row, data, offsets in text_chunks(batch.column(1)):
                words, index, _, _ = word_hashes(data, offsets)
                cells, of = _cells(words, index)
                n = len(offsets) - 1
                weights[row : row + n] = np.bincount(of, ratios[cells], n)
                counts[row : row + n] = np.diff(index)
            yield pa.record_batch([batch.column(0), pa.array(counts), pa.array(weights)], ["doc_id", "n_words", "log_weight"])

    return run


def scored(documents: DataFrame, ratios: np.ndarray, seed: int = 0) -> DataFrame:
    """doc_id, n_words, log_weight and the Gumbel key of every document."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weighed = rows.mapInArrow(_weigh(ratios), "doc_id long, n_words long, log_weight double")
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11).cast("double")
    uniform = (bits + 0.5) / F.lit(float(1 << 53))
    return weighed.withColumn("sample_key", F.col("log_weight") - F.log(-F.log(uniform)))


def _ordered(key) -> Column:
    """A long that orders as the double does, unsigned."""
    # 2^20 steps a unit over +-2^42: finer than the weights' own single precision
    return F.least(F.greatest(F.floor(key * F.lit(float(1 << 20))), F.lit(-(1 << 62))), F.lit((1 << 62) - 1)) + F.lit(1 << 62)


def top_k(rows: DataFrame, key: str, k: int, tie: str) -> DataFrame:
    """The k rows with the largest `key`, ties by the least `tie`; rows equal in both come together.

    The place of the k-th key is found 12 bits at a time; each round counts at most 4,096 groups.
    """
    if k <= 0:
        return rows.limit(0)
    coded = rows.withColumn("_code", _ordered(F.col(key)).cast("long"))
    fixed, width, left = 0, 63, k
    while width > 0:
        step = min(DIGIT, width)
        inside = coded.where(F.shiftright("_code", width) == fixed) if width < 63 else coded
        digit = F.shiftright("_code", width - step).bitwiseAND(F.lit((1 << step) - 1))
        counts = dict(map(tuple, inside.groupBy(digit.alias("digit")).count().collect()))
        chosen = 0
        for d in sorted(counts, reverse=True):
            chosen = d
            if counts[d] >= left:
                break
            left -= counts[d]
        else:
            return rows  # fewer rows than k
        fixed, width = (fixed << step) | chosen, width - step
    edge = coded.where(F.col("_code") == fixed).orderBy(F.col(key).desc(), F.col(tie).asc_nulls_first()).limit(left)
    return coded.where(F.col("_code") > fixed).unionByName(edge).drop("_code")


def resample(documents: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 0, sample: int = SAMPLE) -> DataFrame:
    """The drawn documents: doc_id, n_words, log_weight, sample_key and kept (true)."""
    rows = stored(scored(documents, log_ratios(documents, labels, sample), seed), "weights")
    if k is None:
        share = _good(labels).agg(F.avg(F.col("good").cast("int"))).first()[0]
        k = round(rows.count() * (1.0 if share is None else share))
    return top_k(rows, "sample_key", k, "doc_id").withColumn("kept", F.lit(True))
