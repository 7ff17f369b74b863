"""Removal of repeated byte strings with partitioned suffix arrays.

A byte goes when some string of `LENGTH` bytes over it also starts anywhere else in the corpus. Every such string (a window) has an anchor: its
least hashed `GRAM`-byte gram, the leftmost of equals. Equal windows have equal anchors, so windows are dealt out by
the anchor's hash, as runs: all windows of a text that share one anchor are one piece of bytes (its content).

1. Anchors of all texts are counted by (anchor, content). A content found twice repeats as a whole. An anchor found once repeats nowhere.
2. Anchors with several contents ("mixed") send one copy of every content to the tasks; a task sorts the suffixes of some megabytes of
   contents in two stages and marks the windows whose neighbours share a prefix of `LENGTH` bytes. An anchor with very many
   contents is split: a content goes to every split that owns one of its windows, by a hash of the whole window.
3. Marked windows come back to their texts, which are cut there.

Comparison is of whole windows, byte for byte; hashes of contents (64 bits, beside the anchor's) only tell equal contents. Matches never cross texts.
Null and short texts lose nothing. Repeated rows are texts of their own, and so lose everything if long enough. Null ids are kept apart by their text.
An empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setstride.llm.suffix_sort import common_prefix_reaches, suffix_array
from setstride.llm.tables import n_partitions, stored
from setstride.llm.textkit import mix, text_chunks

LENGTH = 200
GRAM = 64
CHUNK = 1 << 20
SORT_BYTES = 2 << 20
HOT = 4096
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=_U))
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n."""
    size = 1 << max(n, CHUNK).bit_length()
    if size not in _TABLES:
        _TABLES.clear()
        both = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, b, _U)
            p[0] = _U(1)
            both.append(np.multiply.accumulate(p))
        _TABLES[size] = (both[0], both[1])
    return _TABLES[size]


class _Hashes:
    """Hashes of any pieces of a byte string from prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(_U))

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` consecutive keys, from running minima of both directions in blocks of that width."""
    n = len(keys) - width + 1
    padded = np.concatenate([keys, np.full(-len(keys) % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Runs of windows with one anchor: row, first window, last window, anchor hash, content hash (places in `data`)."""
    none = np.zeros(0, np.int64)
    if len(data) < length or not (np.diff(offsets) >= length).any():
        return none, none, none, none.astype(_U), none.astype(_U)
    gram = min(GRAM, length)
    hashes = _Hashes(data)
    grams = hashes.every(gram)
    keys = (grams & ~_U(0xFFFFFFFF)) | np.arange(len(grams), dtype=_U)
    anchor = (_sliding_least(keys, length - gram + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    valid = np.flatnonzero(np.arange(len(anchor)) + length <= offsets[1:][row])
    a, r = anchor[valid], row[valid]
    begins = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (r[1:] != r[:-1]))))
    first = valid[begins]
    last = valid[np.append(begins[1:] - 1, len(valid) - 1)]
    return r[begins], first, last, grams[a[begins]], hashes.of(first, last + length)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


_ANCHORS = "doc_id long, text_key long, anchor long, content long, n long"


def _write_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for at, data, offsets in text_chunks(batch.column(2), CHUNK):
                row, _, _, anchor, content = runs_of(data, offsets, length)
                if not len(row):
                    continue
                order = np.lexsort((content, anchor, row))
                row, anchor, content = row[order], anchor[order], content[order]
                new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))))
                n = np.diff(np.append(new, len(row)))
                row = pa.array(row[new] + at)
                yield pa.record_batch(
                    [ids.take(row), keys.take(row), _signed(anchor[new]), _signed(content[new]), pa.array(n, pa.int64())],
                    ["doc_id", "text_key", "anchor", "content", "n"],
                )

    return run


_FOUND = "kind int, doc_id long, text_key long, covers binary, anchor long, split int, splits int, reported boolean, start long, content binary"


def _covers(starts: np.ndarray, ends: np.ndarray) -> bytes:
    return np.stack([starts, ends], 1).astype("<i8").tobytes()


def _write_contents(length: int):
    """Whole contents are marked at once (kind 0); contents of mixed anchors are sent on (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split(" ")[0] for p in _FOUND.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
        for batch in batches:
            ids, keys, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for at, data, offsets in text_chunks(batch.column(2), CHUNK):
                out = []
                row, first, last, anchor, content = runs_of(data, offsets, length)
                edges = np.searchsorted(row, np.arange(len(offsets)))
                signed, signed_content = anchor.view(np.int64).tolist(), content.view(np.int64).tolist()
                windows = None
                for r in range(len(offsets) - 1):
                    told = {(w["anchor"], w["content"]): w for w in wanted[at + r].as_py()}
                    begin = int(offsets[r])
                    whole, sent = [], set()
                    for i in range(edges[r], edges[r + 1]):
                        w = told.get((signed[i], signed_content[i]))
                        if w is None:
                            continue
                        if w["whole"]:
                            whole.append(i)
                        if w["sends"] and (signed[i], signed_content[i]) not in sent:
                            sent.add((signed[i], signed_content[i]))
                            a, b = int(first[i]), int(last[i])
                            splits = {0}
                            if w["splits"] > 1:
                                windows = windows if windows is not None else _Hashes(data).every(length)
                                splits = set((windows[a : b + 1] % _U(w["splits"])).tolist())
                            for s in splits:
                                out.append((1, ids[at + r], keys[at + r], None, signed[i], s, w["splits"], not w["whole"], a - begin, data[a : b + length].tobytes()))
                    if whole:
                        covers = _covers(first[whole] - begin, last[whole] + length - begin)
                        out.append((0, ids[at + r], keys[at + r], covers, None, None, None, None, None, None))
                if out:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


_MARKS = "doc_id long, text_key long, covers binary"


def _mark(rows: list[dict], length: int) -> list[tuple]:
    """Covers of the windows of some contents that also start elsewhere among them."""
    sizes = np.array([len(r["content"]) for r in rows])
    begins = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(r["content"] for r in rows), np.uint8)
    order = suffix_array(text, length)
    same = common_prefix_reaches(text, order, length)
    of = np.repeat(np.arange(len(rows)), sizes)
    window = order + length <= (begins + sizes)[of[order]]  # the others run over the end of their content
    splits = np.array([r["splits"] for r in rows])
    if (splits > 1).any():
        hashed = _Hashes(text).every(length)
        split = np.array([r["split"] for r in rows])
        owned = np.zeros(len(order), bool)
        place = order[window]
        owned[window] = (hashed[place] % splits[of[place]].astype(_U)).astype(np.int64) == split[of[place]]
        window &= owned
    group = np.concatenate(([0], np.cumsum(~same)))
    many = np.bincount(group[window], minlength=group[-1] + 1) > 1
    hit = np.zeros(len(text), bool)
    hit[order[window & many[group]]] = True
    out = []
    for r, b, n in zip(rows, begins.tolist(), sizes.tolist()):
        if r["reported"] and hit[b : b + n].any():
            starts = np.flatnonzero(hit[b : b + n]) + r["start"]
            cuts = np.flatnonzero(np.diff(starts) > 1)
            heads, tails = starts[np.append(0, cuts + 1)], starts[np.append(cuts, len(starts) - 1)] + length
            out.append((r["doc_id"], r["text_key"], _covers(heads, tails)))
    return out


def _sort_contents(length: int):
    """Rows sorted by (anchor, split): some megabytes of whole groups at a time."""

    def emit(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        found = _mark(rows, length)
        if found:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), (pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "text_key", "covers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= SORT_BYTES and (row["anchor"], row["split"]) != (held[-1]["anchor"], held[-1]["split"]):
                    yield from emit(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["content"])
        if held:
            yield from emit(held)

    return run


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, lists in zip(*batch.columns):
                data = text.as_py() or b""
                gone = np.zeros(len(data) + 1, np.int32)
                for covers in lists.as_py() or ():
                    pairs = np.frombuffer(covers, "<i8").reshape(-1, 2)
                    np.add.at(gone, pairs[:, 0], 1)
                    np.add.at(gone, pairs[:, 1], -1)
                removed = np.cumsum(gone)[: len(data)] > 0
                n = int(removed.sum())
                spans = int((removed & ~np.concatenate(([False], removed[:-1]))).sum()) if n else 0
                kept = np.frombuffer(data, np.uint8)[~removed].tobytes() if n else data
                out.append((key.as_py(), len(data), n, spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def _covered(rows: DataFrame, length: int, hot: int) -> DataFrame:
    """(id, text_key, covers) of `rows` (id, text_key, text): all windows that start twice, as lists of byte ranges."""
    anchors = stored(rows.select("id", "text_key", "text").mapInArrow(_write_anchors(length), _ANCHORS), "anchors").withColumnRenamed("doc_id", "id")
    tag = F.xxhash64("id", "text_key")
    contents = anchors.groupBy("anchor", "content").agg(F.sum("n").alias("n"), F.min(tag).alias("sender"))
    by_anchor = contents.groupBy("anchor").agg(F.sum("n").alias("places"), F.count("*").alias("contents"))
    by_anchor = by_anchor.where("places > 1")
    told = stored(
        contents.join(by_anchor, "anchor").where("n > 1 or contents > 1").select(
            "anchor", "content", (F.col("n") > 1).alias("whole"), F.when(F.col("contents") > 1, F.col("sender")).alias("sender"),
            F.ceil(F.col("contents") / F.lit(hot)).cast("int").alias("splits"),
        ),
        "contents",
    )
    of_text = anchors.join(told, ["anchor", "content"]).select(
        "id", "text_key", F.struct("anchor", "content", "whole", F.coalesce(F.col("sender") == tag, F.lit(False)).alias("sends"), "splits").alias("told")
    )
    lists = stored(of_text.where("told.whole or told.sends").groupBy("id", "text_key").agg(F.collect_list("told").alias("told")), "told")
    texts = rows.join(lists, ["id", "text_key"])
    found = stored(texts.select("id", "text_key", "text", "told").mapInArrow(_write_contents(length), _FOUND), "found")
    mixed = found.where("kind = 1").select("doc_id", "text_key", "anchor", "split", "splits", "reported", "start", "content")
    dealt = mixed.repartition(n_partitions(rows.sparkSession), "anchor", "split").sortWithinPartitions("anchor", "split")
    marks = dealt.mapInArrow(_sort_contents(length), _MARKS).unionByName(found.where("kind = 0").select("doc_id", "text_key", "covers"))
    return stored(marks.groupBy(F.col("doc_id").alias("id"), "text_key").agg(F.collect_list("covers").alias("covers")), "covers")


def cut(documents: DataFrame, length: int = LENGTH, hot: int = HOT, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every row of `documents`."""
    missing = F.lit(-(1 << 63))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), missing).alias("id"), text.alias("text"))
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    covers = _covered(keyed, length, hot)
    whole = keyed.join(covers, ["id", "text_key"], "left")
    out = whole.select(F.when(F.col("id") != missing, F.col("id")).alias("doc_id"), "text", "covers").mapInArrow(_cut(with_kept), _RESULT)
    return out if with_kept else out.drop("kept")

