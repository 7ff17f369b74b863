"""Phrase collocations by Misra-Gries summaries per hash partition and an exact second pass.

Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?\\x0A-\\x0D]` and into words between blanks and tabs; phrases are runs of words
inside a piece. Everything is counted per language. A phrase is a candidate when it has 2 to `longest` words and occurs at least `least`
times, overlaps included.

* First pass, for single words, then pairs, then longer phrases: the mass of each hash partition (the leading bits of the hash) is counted; then a task
  counts the hashes of one chunk of text and sends the counts as blocks, one per partition. A block is a summary without error; a partition merges its blocks
  into one Misra-Gries summary whose capacity exceeds the partition's mass divided by `least`, so no phrase with `least`
  occurrences is lost. Memory of a merge is its partition's mass / `least` counters; more partitions make them smaller.
* What survives is kept as one bit per hash cell in a table of 2^`FILTER_BITS` bits, of fixed size whatever the corpus. Longer phrases are only sent where all their shorter ones survive.
* Second pass: occurrences whose cell is set are counted exactly, in a task by 64-bit hash, over all tasks by language and words, again in blocks by hash partition. Cells that others
  share only add phrases whose exact count then rules them out.
* A cut of a candidate into its first k words and the rest scores floor(1000 * count * words / (count of first * count of rest)), in
  whole numbers of any size; the lowest-scoring cut counts, then the smallest k.
* A candidate goes if its words lie inside a longer candidate, gone or not, that occurs at least `share` hundredths as often.

Null texts are empty; null languages are `und`. Repeated rows count as often as they stand. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setstride.llm.tables import n_partitions, stored
from setstride.llm.textkit import LOWER, grams, mix, text_chunks, word_hashes

FILTER_BITS = 27
CHUNK = 4 << 20
MERGE = 1 << 20
HELD = 1 << 19
_U = np.uint64
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAPS = _ENDS.copy()
_GAPS[[32, 9]] = True
_BLOCKS = "part int, mass long, hashes binary, counts binary"


class _Words:
    """Words of consecutive rows: hashes that differ by language, their bytes, and where phrases may run."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        hashes, index, self.first, self.last = word_hashes(data, offsets, blank=_GAPS)
        self.data = data
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(index))
        self.hashes = mix(hashes + langs[self.row])
        ends = np.cumsum(_ENDS[data], dtype=np.int64)
        self.piece = ends[self.first] + self.row if len(self.first) else self.row  # both only grow, so equal sums are equal pieces

    def runs(self, k: int) -> np.ndarray:
        """Whether a phrase of k words starts at each word."""
        n = len(self.piece) - k + 1
        return self.piece[:n] == self.piece[k - 1 :] if n > 0 else np.zeros(0, bool)

    def phrases(self, k: int) -> np.ndarray:
        return mix(self.hashes) if k == 1 else grams(self.hashes, k)

    def texts(self, at: np.ndarray, k: np.ndarray) -> pa.Array:
        """The words of phrases, joined by one space each."""
        size = self.last - self.first
        start = np.concatenate(([0], np.cumsum(size + 1)))
        flat = np.full(int(start[-1]), 32, np.uint8)
        inside = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
        source = np.arange(int(size.sum())) + np.repeat(self.first - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        flat[inside] = LOWER[self.data[source]]
        length = start[at + k] - 1 - start[at]
        ends = np.concatenate(([0], np.cumsum(length)))
        taken = flat[np.arange(int(ends[-1])) + np.repeat(start[at] - ends[:-1], length)]
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(taken.tobytes())])
        return made.cast(pa.string())


def _lang_hash(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(v) for v in langs], _U)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Words, pa.Array]]:
    """Words of chunks of (text, lang) rows, with the rows' languages."""
    for batch in batches:
        langs = batch.column(1).dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        hashes = _lang_hash(langs.dictionary.to_pylist())
        for row, data, offsets in text_chunks(batch.column(0), CHUNK):
            to = row + len(offsets) - 1
            yield _Words(data, offsets, hashes[codes[row:to]]), batch.column(1).slice(row, to - row)


def _is_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cell = hashes >> _U(64 - FILTER_BITS)
    return (bits[(cell >> _U(3)).astype(np.int64)] >> (cell & _U(7)).astype(np.uint8)) & 1 == 1


def _packed(bits: np.ndarray) -> bytes:
    """The filter as it goes to tasks: compressed, so that few survivors are few bytes."""
    return zlib.compress(bits.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def _possible(words: _Words, k: int, known: int, bits: np.ndarray) -> np.ndarray:
    """Where a phrase of k words starts all of whose phrases of `known` words survived."""
    ok = words.runs(k)
    if known and len(ok):
        short = _is_set(bits, words.phrases(known)) & words.runs(known)
        for j in range(k - known + 1):
            ok &= short[j : j + len(ok)]
    return ok


def _blocks(sizes: tuple[int, ...], known: int, packed: bytes, part_bits: int, only_mass: bool = False):
    """Counted hashes of every chunk, cut by hash partition; or only the mass of each partition in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _unpacked(packed)
        mass = np.zeros(1 << part_bits, np.int64)
        for words, _ in _chunks(batches):
            found = [words.phrases(k)[_possible(words, k, known, bits)] for k in sizes if len(words.first) >= k]
            if not found or not sum(map(len, found)):
                continue
            if only_mass:
                for f in found:
                    mass += np.bincount((f >> _U(64 - part_bits)).astype(np.int64), minlength=len(mass))
                continue
            hashes, counts = np.unique(np.concatenate(found), return_counts=True)
            part = (hashes >> _U(64 - part_bits)).astype(np.int64)
            edges = np.searchsorted(part, np.arange((1 << part_bits) + 1))
            rows = [(p, a, b) for p, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
            yield pa.record_batch(
                [
                    pa.array([p for p, _, _ in rows], pa.int32()), pa.array([int(counts[a:b].sum()) for _, a, b in rows], pa.int64()),
                    pa.array([hashes[a:b].tobytes() for _, a, b in rows], pa.binary()), pa.array([counts[a:b].astype("<u4").tobytes() for _, a, b in rows], pa.binary()),
                ],
                ["part", "mass", "hashes", "counts"],
            )
        if mass.any():
            yield pa.record_batch([pa.array(np.arange(len(mass)), pa.int32()), pa.array(mass)], ["part", "mass"])

    return run


class Summary:
    """Misra-Gries summary of a hash partition: counts are too low by at most `lost`, which stays below mass / capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.hashes, self.counts = np.zeros(0, _U), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, counts))
        self.held += len(hashes)
        if self.held > max(MERGE, self.capacity):
            self.merge()

    def merge(self) -> None:
        """Add what waits; if more than the capacity is held, take the largest count beyond it off all of them."""
        hashes = np.concatenate([self.hashes, *(h for h, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.held = [], 0
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, np.int64)
        hashes, counts = hashes[starts], np.add.reduceat(counts, starts) if len(starts) else counts
        if len(hashes) > self.capacity:
            off = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            keep = counts > off
            hashes, counts = hashes[keep], counts[keep] - off
            self.lost += off
        self.hashes, self.counts = hashes, counts

    def frequent(self, least: int) -> np.ndarray:
        """All hashes that may have occurred `least` times."""
        if self.waiting:
            self.merge()
        return self.hashes[self.counts + self.lost >= least]


def _surviving(masses: dict[int, int], least: int, part_bits: int):
    """Rows of whole hash partitions to the bits of what survives in them."""
    cells = 1 << (FILTER_BITS - part_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries: dict[int, Summary] = {}
        for batch in batches:
            for p, hashes, counts in zip(batch.column("part").to_pylist(), batch.column("hashes"), batch.column("counts")):
                if p not in summaries:
                    summaries[p] = Summary(masses[p] // least + 1)
                summaries[p].add(np.frombuffer(hashes.as_buffer(), _U), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))
        for p, summary in summaries.items():
            cell = (summary.frequent(least) >> _U(64 - FILTER_BITS)) & _U(cells - 1)
            marked = np.zeros(cells, bool)
            marked[cell.astype(np.int64)] = True
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([_packed(np.packbits(marked, bitorder="little"))], pa.binary())], ["part", "bits"])

    return run


def _part_bits(partitions: int) -> int:
    return min(max(partitions - 1, 1).bit_length(), FILTER_BITS - 3)


def survivors(texts: DataFrame, sizes: tuple[int, ...], least: int, known: int, bits: np.ndarray) -> np.ndarray:
    """The filter: cells set in `bits`, and those of all phrases of the given sizes that may occur `least` times."""
    spark = texts.sparkSession
    part_bits = _part_bits(n_partitions(spark))
    packed = _packed(bits)
    weighed = texts.mapInArrow(_blocks(sizes, known, packed, part_bits, True), "part int, mass long")
    masses = {r["part"]: r["mass"] for r in weighed.groupBy("part").agg(F.sum("mass").alias("mass")).collect()}  # a number per hash partition
    blocks = texts.mapInArrow(_blocks(sizes, known, packed, part_bits), _BLOCKS)
    merged = blocks.repartition(n_partitions(spark), "part").mapInArrow(_surviving(masses, least, part_bits), "part int, bits binary")
    out = np.zeros((1 << part_bits, 1 << (FILTER_BITS - part_bits - 3)), np.uint8)
    for row in merged.toLocalIterator():  # 2^FILTER_BITS bits in all
        out[row["part"]] = _unpacked(row["bits"])
    return out.ravel() | bits


class _Held:
    """Counts of a task's surviving phrases by hash, with the words of each once; at most `HELD` of them and one chunk's."""

    def __init__(self):
        self.hashes, self.counts, self.sizes = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.langs, self.texts = pa.array([], pa.string()), pa.array([], pa.string())

    def add(self, words: _Words, langs: pa.Array, hashes: np.ndarray, at: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        """Sorted distinct `hashes`, each with a place where it stands and its size and count."""
        place = np.searchsorted(self.hashes, hashes)
        known = (place < len(self.hashes)) & (self.hashes[np.minimum(place, max(len(self.hashes) - 1, 0))] == hashes) if len(self.hashes) else np.zeros(len(hashes), bool)
        self.counts[place[known]] += counts[known]
        new = ~known
        if not new.any():
            return
        order = np.argsort(np.concatenate([self.hashes, hashes[new]]), kind="stable")
        self.hashes = np.concatenate([self.hashes, hashes[new]])[order]
        self.counts = np.concatenate([self.counts, counts[new]])[order]
        self.sizes = np.concatenate([self.sizes, sizes[new]])[order]
        self.langs = pa.concat_arrays([self.langs, langs.take(pa.array(words.row[at[new]]))]).take(pa.array(order))
        self.texts = pa.concat_arrays([self.texts, words.texts(at[new], sizes[new])]).take(pa.array(order))

    def blocks(self, part_bits: int) -> Iterator[pa.RecordBatch]:
        """One row per hash partition: its phrases as parallel lists."""
        edges = np.searchsorted(self.hashes >> _U(64 - part_bits), np.arange((1 << part_bits) + 1, dtype=_U))
        for p, (a, b) in enumerate(zip(edges.tolist(), edges.tolist()[1:])):
            if a < b:
                yield _count_block(p, self.langs[a:b], self.texts[a:b], self.sizes[a:b], self.counts[a:b])


_COUNTS = "part int, langs array<string>, phrases array<string>, sizes array<long>, counts array<long>"


def _count_block(part: int, langs: pa.Array, phrases: pa.Array, sizes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    ends = pa.array([0, len(langs)], pa.int32())
    lists = [pa.ListArray.from_arrays(ends, v) for v in (langs.cast(pa.string()), phrases, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()))]
    return pa.record_batch([pa.array([part], pa.int32()), *lists], ["part", "langs", "phrases", "sizes", "counts"])


def _counted(longest: int, packed: bytes, part_bits: int):
    """Occurrences of surviving phrases in a task, in blocks by hash partition, and its words per language as phrases of size 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _unpacked(packed)
        held, totals = _Held(), Counter()
        for words, langs in _chunks(batches):
            if not len(words.first):
                continue
            codes = langs.dictionary_encode()
            counts = np.bincount(codes.indices.to_numpy(zero_copy_only=False)[words.row], minlength=len(codes.dictionary))
            totals.update(dict(zip(codes.dictionary.to_pylist(), counts.tolist())))
            for k in range(1, longest + 1):
                phrases, ok = words.phrases(k), words.runs(k)
                at = np.flatnonzero(ok & _is_set(bits, phrases[: len(ok)])) if len(ok) else np.zeros(0, np.int64)
                if len(at):
                    hashes, first, times = np.unique(phrases[at], return_index=True, return_counts=True)
                    held.add(words, langs, hashes, at[first], np.full(len(first), k), times)
            if len(held.hashes) > HELD:
                yield from held.blocks(part_bits)
                held = _Held()
        yield from held.blocks(part_bits)
        if totals:
            yield _count_block(0, pa.array(list(totals), pa.string()), pa.array([""] * len(totals)), np.zeros(len(totals), np.int64), np.array(list(totals.values())))

    return run


def _exact(least: int):
    """Whole hash partitions of blocks to the exact counts of their phrases: those of `least` occurrences, and the totals."""

    def merged(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(["lang", "phrase", "size"]).aggregate([("n", "sum")]).rename_columns(["lang", "phrase", "size", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        waiting, kept = 0, 0
        for batch in batches:
            columns = [batch.column(c).flatten() for c in ("langs", "phrases", "sizes", "counts")]
            held.append(pa.table(columns, ["lang", "phrase", "size", "n"]))
            waiting += len(columns[0])
            if waiting > max(MERGE, 2 * kept):
                held = [merged(held)]
                waiting = kept = held[0].num_rows
        if held:
            table = merged(held)
            wanted = pc.or_(pc.greater_equal(table["n"], least), pc.equal(table["size"], 0))
            yield from table.filter(wanted).combine_chunks().to_batches(max_chunksize=1 << 16)

    return run


def phrase_counts(documents: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, phrase, size, n): exact counts of all phrases of 1 to `longest` words that occur `least` times, and of all words (size 0)."""
    texts = documents.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    bits = survivors(texts, (1,), least, 0, np.zeros(1 << (FILTER_BITS - 3), np.uint8))
    if longest > 1:
        bits = survivors(texts, (2,), least, 1, bits)
    if longest > 2:
        bits = survivors(texts, tuple(range(3, longest + 1)), least, 2, bits)
    parts = n_partitions(texts.sparkSession)
    blocks = texts.mapInArrow(_counted(longest, _packed(bits), _part_bits(parts)), _COUNTS)
    counts = blocks.repartition(parts, "part").mapInArrow(_exact(least), "lang string, phrase string, size long, n long")
    return stored(counts.withColumn("size", F.col("size").cast("int")), "phrase-counts")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, n, left, right = (batch.column(c).to_pylist() for c in ("a", "n", "l", "r"))
        score = pa.array([1000 * w * x // (y * z) for w, x, y, z in zip(a, n, left, right)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "score"])


def _words(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def collocations(documents: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases by score, count (both falling) and words."""
    counts = phrase_counts(documents, least, longest)
    totals = counts.where("size = 0").select("lang", "n")
    parts = counts.where("size > 0")
    candidates = parts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _words(F.lit(1), F.col("k")).alias("left"), _words(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang").select("lang", "phrase", "a", "k", "l", "r", "n")
    scored = cuts.mapInArrow(_scored, "lang string, phrase string, a long, k int, l long, r long, n long, score long")
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s")).select("lang", "phrase", "s.*")

    longer = candidates.where("size > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
    inner = longer.select("lang", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1), lambda s: _words(s, F.col("m")))).alias("phrase"))
    cover = inner.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    kept = lowest.join(cover, ["lang", "phrase"], "left").where(F.col("cover").isNull() | (F.col("cover") * 100 < F.col("a") * share))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
