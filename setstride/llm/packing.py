"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

Documents are tokenised, cut into pieces of at most `most` tokens, and the pieces packed in blocks: a block is one task's
share of some `BLOCK` pieces, by a hash of the piece. A block wastes part of one sequence at the most against packing all at once.

Inside a block, pieces go best-fit in falling length. Where more sequences are used than the total length needs, the underfull ones, the emptiest
first, give their pieces away: each exchanges one for one, two for one or one for two, or moves a piece, with any other underfull sequence, whenever the squared fill of
the two grows, until it is empty or nothing helps. The search ends when no sequence can give anything, or at the bound of the total length;
a partner is looked up by the length it holds and its room.

Null texts are empty; an empty document is its end token alone. Equal lengths are taken in the order of (doc_id, piece), null ids first.
Repeated rows are pieces of their own. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

import bisect
import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setstride.llm.tables import stored
from setstride.llm.tokens import WordTokenizer

MOST = 4096
BLOCK = 1 << 16
END = 1
CHUNK_CHARS = 1 << 20
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(ids: np.ndarray, most: int = MOST) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, checksum) of a document's ids with the end token."""
    whole = np.append(ids.astype("<u4"), np.array([END], "<u4"))
    return [(i, s, min(most, len(whole) - s), zlib.crc32(whole[s : s + most].tobytes())) for i, s in enumerate(range(0, len(whole), most))]


def _tokenise(path: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(path)
        for batch in batches:
            keys, texts, held = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= CHUNK_CHARS:
                    yield _rows(keys, tokenizer.encode(texts), most)
                    keys, texts, held = [], [], 0
            if keys:
                yield _rows(keys, tokenizer.encode(texts), most)

    return run


def _rows(keys: list, coded: list[np.ndarray], most: int) -> pa.RecordBatch:
    rows = [(k, *p) for k, ids in zip(keys, coded) for p in pieces_of(ids, most)]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(documents: DataFrame, tokenizer: str, most: int = MOST) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tokenise(tokenizer, most), _PIECES)


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Bins of piece numbers: every piece, in falling length, goes where it leaves the least room."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(most + 1)]
    rooms = 0  # bit r is set when some bin has room r
    for n in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        size = lengths[n]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = most, len(bins)
            bins.append([])
        bins[b].append(n)
        left = room - size
        if left:
            with_room[left].append(b)
            rooms |= 1 << left
    return bins


class _Underfull:
    """Bins with room, found by what they hold: for every length of a piece (kind 1) or of a pair of pieces (kind 2), the bins that hold it, by room.

    Kind 0 holds nothing: a bin that only receives. `reach` is the largest sum of a length and a room beside it, so that one
    comparison rules out all lengths that cannot take part in an exchange.
    """

    def __init__(self, most: int):
        self.most = most
        self.places: list[dict[int, list[tuple[int, int]]]] = [{}, {}, {}]
        self.reach = [np.full(s * most + 1, -1, np.int64) for s in (1, 1, 2)]

    def _entries(self, held: list[int]) -> list[tuple[int, int]]:
        distinct = sorted(set(held))
        pairs = {x + y for x, y in itertools.combinations(distinct, 2)} | {2 * x for x in distinct if held.count(x) > 1}
        return [(0, 0), *((1, x) for x in distinct), *((2, t) for t in pairs)]

    def add(self, b: int, room: int, held: list[int]) -> None:
        for kind, t in self._entries(held):
            place = self.places[kind].setdefault(t, [])
            bisect.insort(place, (room, b))
            self.reach[kind][t] = place[-1][0] + t

    def remove(self, b: int, room: int, held: list[int]) -> None:
        for kind, t in self._entries(held):
            place = self.places[kind][t]
            place.pop(bisect.bisect_left(place, (room, b)))
            self.reach[kind][t] = place[-1][0] + t if place else -1

    def best(self, own: list[int], room: int) -> tuple[int, tuple[int, ...], int, int] | None:
        """(bin, lengths given, kind and length taken) of the exchange that moves the most tokens out of a bin, or None.

        The bin that receives must end up fuller than the one that gives was: then the sum of squared fills grows.
        """
        singles = sorted(set(own), reverse=True)
        pairs = {tuple(p) for p in itertools.combinations(sorted(own), 2)}
        best, most_moved = None, 0
        for kind, gifts in ((0, [(y,) for y in singles]), (1, [*((y,) for y in singles), *sorted(pairs, key=lambda p: (-sum(p), p))]), (2, [(y,) for y in singles])):
            for given in gifts:
                total = sum(given)
                if total <= most_moved:
                    continue
                # a longer taken part moves less, so the first that fits is the best of this gift
                for t in np.flatnonzero(self.reach[kind][: max(total - most_moved, 0)] >= total).tolist():
                    place = self.places[kind][t]
                    at = bisect.bisect_left(place, (total - t, -1))
                    if at < len(place) and place[at][0] < total - t + room:
                        most_moved, best = total - t, (place[at][1], given, kind, t)
                        break
        return best


def _taken(held: list[int], kind: int, total: int) -> list[int]:
    """Lengths of the piece or the pair of that total among those held."""
    if kind < 2:
        return [total] * kind
    counts = Counter(held)
    return next([x, total - x] for x in sorted(counts) if total - x in counts and (2 * x != total or counts[x] > 1))


def improved(bins: list[list[int]], lengths: list[int], most: int) -> list[list[int]]:
    """Local search: every underfull bin, the emptiest first, gives pieces away while exchanges with other underfull bins raise the
    sum of squared fills. It ends when as few bins are left as the total needs, or when no bin could give anything."""
    least = math.ceil(sum(lengths) / most)
    alive = len(bins)
    if alive <= least:
        return bins
    bins = [list(b) for b in bins]
    held = [[lengths[p] for p in b] for b in bins]
    room = [most - sum(h) for h in held]
    index = _Underfull(most)
    for b in range(len(bins)):
        if room[b]:
            index.add(b, room[b], held[b])

    def hand_over(giver: int, receiver: int, sizes: list[int]) -> None:
        for x in sizes:
            at = held[giver].index(x)
            bins[receiver].append(bins[giver].pop(at))
            held[receiver].append(held[giver].pop(at))
            room[giver], room[receiver] = room[giver] + x, room[receiver] - x

    moved = True
    while moved and alive > least:
        moved = False
        for source in sorted((b for b in range(len(bins)) if bins[b] and room[b]), key=lambda b: (-room[b], b)):
            if alive <= least:
                break
            if not room[source]:
                continue
            index.remove(source, room[source], held[source])
            while bins[source]:
                step = index.best(held[source], room[source])
                if step is None:
                    break
                target, given, kind, total = step
                index.remove(target, room[target], held[target])
                taken = _taken(held[target], kind, total)
                hand_over(source, target, list(given))
                hand_over(target, source, taken)
                if room[target]:
                    index.add(target, room[target], held[target])
                moved = True
            if not bins[source]:
                alive -= 1
            elif room[source]:
                index.add(source, room[source], held[source])
    return [b for b in bins if b]


def pack(lengths: list[int], most: int = MOST) -> list[list[int]]:
    return improved(best_fit(lengths, most), lengths, most)


_PACKED = _PIECES + ", sequence_id long, offset long"


def _pack_block(most: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table["length"].to_pylist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for n, held in enumerate(pack(lengths, most)):
            at = 0
            for p in held:
                sequence[p], offset[p] = (key[0].as_py() << 32) + n, at
                at += lengths[p]
        return table.drop_columns(["block"]).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def packed(documents: DataFrame, tokenizer: str, most: int = MOST) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    pieces = stored(token_pieces(documents, tokenizer, most), "pieces")
    blocks = max(1, math.ceil(pieces.count() / BLOCK))
    key = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("long")
    return pieces.withColumn("block", key).groupBy("block").applyInArrow(_pack_block(most), _PACKED)
