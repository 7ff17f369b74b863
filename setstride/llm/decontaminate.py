"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items meet through shared seeds (hashes of `seed` consecutive words). Of a pair that could
reach the threshold, tiles are taken greedily: the longest unmarked common run of words first, found with Karp-Rabin
hashes of falling lengths, then marked, until no run of `seed` words is left. Tiles don't overlap and may stand in any
order, so passages whose parts were moved about are caught too. A document is contaminated by an item when the tiles cover at least
`cover` of the item's words.

The benchmark is the query set: it goes to the tasks in blocks of at most `BLOCK_WORDS` words, each over all documents. Words are
separated by blanks, A to Z count as lower case. Items shorter than a seed are met as one whole run; null or blank items and texts meet nothing.
Repeated rows of documents or items give repeated pairs once. Equal runs go to the earliest place in the item, then in the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setstride.llm.textkit import grams, text_chunks, word_hashes

BLOCK_WORDS = 1 << 20


@dataclass(frozen=True)
class Tiling:
    seed: int = 4
    cover: float = 0.6


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(place in item, place in doc, words) of greedy tiles of at least `least` equal words, longest first."""
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    out: list[tuple[int, int, int]] = []
    length = max(least, len(item) // 2)
    while True:
        found = _runs(item, doc, free_item, free_doc, length)
        if found and found[0][2] > 2 * length:  # a much longer run than looked for: start from its length
            length = found[0][2]
            found = [r for r in found if r[2] >= length]
        for i, j, n in found:
            if free_item[i : i + n].all() and free_doc[j : j + n].all():
                free_item[i : i + n] = False
                free_doc[j : j + n] = False
                out.append((i, j, n))
        again = _runs(item, doc, free_item, free_doc, length) if found else []
        if again:
            continue
        if length == least:
            return out
        length = max(least, length // 2)


def _runs(item, doc, free_item, free_doc, length) -> list[tuple[int, int, int]]:
    """Maximal common runs of unmarked words, at least `length` long; longest first, then earliest."""
    if min(len(item), len(doc)) < length:
        return []
    whole = np.ones(length, np.int64)
    own = np.flatnonzero(np.convolve(free_item, whole, "valid") == length)
    sums = np.concatenate(([0], np.cumsum(free_doc)))
    there = np.flatnonzero(sums[length:] - sums[:-length] == length)
    if not len(own) or not len(there):
        return []
    a, b = grams(item, length)[own], grams(doc, length)[there]
    both = np.isin(b, a)
    there, b = there[both], b[both]
    found: set[tuple[int, int, int]] = set()
    places: dict[int, list[int]] = {}
    for i, h in zip(own.tolist(), a.tolist()):
        places.setdefault(h, []).append(i)
    reached: dict[int, int] = {}  # by diagonal: how far a run has been followed
    for j, h in zip(there.tolist(), b.tolist()):
        for i in places[h]:
            if reached.get(j - i, -1) > j:
                continue
            n = length
            if not np.array_equal(item[i : i + n], doc[j : j + n]):
                continue
            while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_item[i + n] and free_doc[j + n]:
                n += 1
            reached[j - i] = j + n - length + 1
            found.add((i, j, n))
    return sorted(found, key=lambda r: (-r[2], r[0], r[1]))


class Benchmark:
    """Words and seeds of a block of benchmark items."""

    def __init__(self, ids: list[int], texts: list[str], rule: Tiling):
        self.rule, self.ids, self.items, seeds = rule, [], [], {}
        for row, data, offsets in text_chunks(pa.array(texts, pa.string())):
            words, index, _, _ = word_hashes(data, offsets)
            for i in range(len(offsets) - 1):
                own = words[index[i] : index[i + 1]]
                if len(own):
                    self.ids.append(ids[row + i])
                    self.items.append(own)
        for n, own in enumerate(self.items):
            k = min(rule.seed, len(own))
            g = grams(own, k)
            seeds.setdefault(k, []).append((g, np.full(len(g), n), np.arange(len(g))))
        self.seeds = {}
        for k, parts in seeds.items():
            g, n, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(g, kind="stable")
            self.seeds[k] = (g[order], n[order], at[order])

    def pairs(self, column: pa.Array) -> Iterator[tuple[int, int, float, int]]:
        """(row, item, share of the item's words in tiles, number of tiles) of contaminated pairs."""
        for row, data, offsets in text_chunks(column):
            words, index, _, _ = word_hashes(data, offsets)
            met: dict[tuple[int, int], list] = {}
            for k, (seeds, item, at) in self.seeds.items():
                g = grams(words, k)
                if not len(g):
                    continue
                low = np.searchsorted(seeds, g, "left")
                hit = np.flatnonzero(seeds[np.minimum(low, len(seeds) - 1)] == g)
                if not len(hit):
                    continue
                of = np.searchsorted(index, hit, "right") - 1
                inside = hit + k <= index[of + 1]
                hit, of = hit[inside], of[inside]
                low, high = low[hit], np.searchsorted(seeds, g[hit], "right")
                for r, a, b in zip(of.tolist(), low.tolist(), high.tolist()):
                    for x in range(a, b):
                        met.setdefault((r, int(item[x])), []).append((int(at[x]), k))
            for (r, n), places in sorted(met.items()):
                own = self.items[n]
                could = np.zeros(len(own), bool)
                for p, k in set(places):
                    could[p : p + k] = True
                if could.sum() < self.rule.cover * len(own):
                    continue
                least = min(self.rule.seed, len(own))
                found = tiles(own, words[index[r] : index[r + 1]], least)
                share = sum(t[2] for t in found) / len(own)
                if share >= self.rule.cover:
                    yield row + r, self.ids[n], share, len(found)


def _blocks(benchmark: DataFrame, rule: Tiling) -> Iterator[Benchmark]:
    """The benchmark in blocks of bounded size, in the order of the ids."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    ids, texts, held = [], [], 0
    for r in rows.distinct().orderBy("item_id", "text").toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        held += 1 + len(r["text"]) // 2
        if held >= BLOCK_WORDS:
            yield Benchmark(ids, texts, rule)
            ids, texts, held = [], [], 0
    if ids:
        yield Benchmark(ids, texts, rule)


_PAIRS = "doc_id long, item_id long, coverage double, n_tiles long"


def _pairs_of(block: Benchmark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(ids[i], n, share, count) for i, n, share, count in block.pairs(batch.column(1))]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "item_id", "coverage", "n_tiles"])

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame, rule: Tiling = Tiling()) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles): one row per document and item that contaminates it."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.sparkSession.createDataFrame([], _PAIRS)
    for block in _blocks(benchmark, rule):
        out = out.unionByName(rows.mapInArrow(_pairs_of(block), _PAIRS))
    return out.groupBy("doc_id", "item_id").agg(F.max("coverage").alias("coverage"), F.max("n_tiles").alias("n_tiles"))


def _clean_of(block: Benchmark, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = np.ones(batch.num_rows, bool)
            for i, *_ in block.pairs(batch.column(at)):
                stays[i] = False
            yield batch.filter(pa.array(stays))

    return run


def clean(documents: DataFrame, benchmark: DataFrame, rule: Tiling = Tiling()) -> DataFrame:
    """The rows of `documents` that no item contaminates, with their columns."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in documents.schema])
    for block in _blocks(benchmark, rule):
        documents = documents.mapInArrow(_clean_of(block, schema.names.index("text")), schema)
    return documents
