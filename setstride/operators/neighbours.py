"""Exact nearest neighbours: blocks of vectors meet inside tasks, which keep only k candidates per query.

One plan serves any number of queries: queries and base are packed into blocks of bounded size, every query block meets every base
block that may hold a neighbour, and the k best of each meeting are merged per query.

* `nearest` compares query vectors with all base vectors.
* `neighbour_walk` scores every step by the steps that followed the k earlier states closest to its own, each dimension scaled by its deviation over the
  states known before that step. All of a step's past is its base, so the work grows with the square of a walk; `span` limits it to the steps asked for.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setstride.operators.kernels import slot_kernel
from setstride.operators.layout import SERIES, StepTable, by_block
from setstride.operators.scorers import KEYS, Span, register, scored
from setstride.operators.state import average_gap, current_gap, item_part, slot_rows, slot_state
from setstride.session import materialise

QUERY_BLOCK = 1 << 12
BASE_BLOCK = 1 << 14
STEP_BLOCK = 1 << 12
#: States known at least before a step is scored by its neighbours, as `k`; candidates beyond k that are measured again.
NEIGHBOURS = 10
SPARE = 16
_FLAT = 1e-7


def _lists(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _first(distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest distances, smaller ids first on ties."""
    if len(distance) > 4 * k:
        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((ids[near], distance[near]))[:k]]


def _packed(frame: DataFrame, size: int, name: str) -> DataFrame:
    """(block, ids binary, vecs binary) of (id, vec), in blocks of about `size` vectors."""
    blocks = max(1, -(-frame.count() // size))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        ids, vecs = table.column("id").to_numpy().astype("<i8"), _lists(table.column("vec").combine_chunks())
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([vecs.tobytes()], pa.binary())], ["block", "ids", "vecs"])

    rows = frame.select(F.col("id").cast("long").alias("id"), "vec").where("id is not null and vec is not null")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return materialise(dealt.groupBy("block").applyInArrow(run, "block long, ids binary, vecs binary"), name)


def nearest(queries: DataFrame, base: DataFrame, k: int, skip_self: bool = False, scale: np.ndarray | float = 1.0) -> DataFrame:
    """(query_id, neighbour_id, distance, rank) of the k nearest base vectors of every query; ties keep the smaller id.

    Both frames are (id long, vec array); `scale` divides each dimension (distances between standardised
    vectors need no means). Rows without id or vector take no part.
    """
    asked = _packed(queries, QUERY_BLOCK, "queries").select(F.col("block").alias("asked"), F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"))
    known = _packed(base, BASE_BLOCK, "base")
    groups = asked.select("asked").agg(F.collect_list("asked").alias("asked"))  # block numbers
    both = known.join(groups, how="cross").withColumn("asked", F.explode("asked")).join(asked, "asked")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, qids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["qids"], "<i8")
                vecs, qvecs = np.frombuffer(row["vecs"]).reshape(len(ids), -1), np.frombuffer(row["qvecs"]).reshape(len(qids), -1)
                found = []
                for q, vec in zip(qids, qvecs):
                    distance = np.sqrt((((vecs - vec) / scale) ** 2).sum(axis=1))
                    use = np.flatnonzero(ids != q) if skip_self else np.arange(len(ids))
                    best = use[_first(distance[use], ids[use], k)]
                    found.append((np.full(len(best), q), ids[best], distance[best]))
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found)], ["query_id", "neighbour_id", "distance"])

    candidates = both.repartition("asked", "block").mapInArrow(meet, "query_id long, neighbour_id long, distance double")
    order = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def vector_moments(vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """Mean and population deviation of every dimension: (dim, mean, std), from one summary per task."""
    seen = vectors.select(array_to_vector(vec).alias("_v")).agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("_v")).alias("_s")
    )
    arrays = F.arrays_zip(vector_to_array("_s.mean").alias("mean"), vector_to_array("_s.variance").alias("variance"))
    n = F.col("n")
    return (
        seen.select(F.col("_s.count").alias("n"), F.posexplode(arrays).alias("dim", "_m"))
        .select("dim", F.col("_m.mean").alias("mean"), F.sqrt(F.col("_m.variance") * (n - 1) / n).alias("std"))
    )


def state_vector(table: StepTable, short: int) -> Column:
    """[gap, gap / max(mean gap, 1), appearances in the last `short`, in the last 100] for every item."""
    cnt, last, first = (item_part(table, n) for n in ("cnt", "last", "first"))
    gap = current_gap(last)
    ratio = F.zip_with(gap, average_gap(cnt, last, first), lambda g, a: g / F.greatest(a, F.lit(1.0)))
    parts = [gap, ratio, item_part(table, f"r{short}"), item_part(table, "r100")]
    return F.concat(*[F.transform(p, lambda x: x.cast("double")) for p in parts])


def state_vectors(table: StepTable, short: int = 20, span: tuple[int, int] | None = None) -> DataFrame:
    state = slot_state(table, (short, 100), ("cnt", "last", "first"), span)
    return state.select(SERIES, "ord", "step_id", "ts", "items", "special", state_vector(table, short).alias("vec"))


# ---------------------------------------------------------------------------------------------------
# Every step by its own past


def _packed_state(state: np.ndarray) -> bytes:
    """Whole numbers that change little from step to step, as compressed differences."""
    return zlib.compress(np.ascontiguousarray(np.diff(state.astype("<i4"), axis=0, prepend=np.int32(0)).T).tobytes(), 1)


def _state_matrix(packed: bytes, ords: np.ndarray) -> np.ndarray:
    """The vectors of `state_vector` from packed last, first, count and both recent counts."""
    whole = np.cumsum(np.frombuffer(zlib.decompress(packed), "<i4").reshape(-1, len(ords)).T, axis=0, dtype=np.int64)
    last, first, cnt, short, recent = np.split(whole, 5, axis=1)
    at = ords[:, None]
    gap = at - 1 - last
    mean = np.where(cnt > 1, (last - first) / np.maximum(cnt - 1, 1), at.astype(np.float64))
    return np.hstack([gap, gap / np.maximum(mean, 1.0), short, recent]).astype(np.float64)


def _step_blocks(table: StepTable, size: int, short: int, warm_up: int) -> DataFrame:
    """One row per (series, block of `size`): packed ordinals, states, revealed items, and the sums of the revealed states.

    States are packed where the slot kernel makes them, so no vector is shuffled or written.
    """
    windows, want, items = (short, 100), ("cnt", "last", "first"), table.domain.items
    rows = by_block(slot_rows(table, windows, want, None), table.rows)
    kernel = slot_kernel([SERIES, "ord", "items", "special"], table.domain.slots, windows, want)

    def pack(key: tuple, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        steps = pa.Table.from_batches(held).combine_chunks()
        ords = steps.column("ord").to_numpy().astype("<i8")
        known = ~steps.column("special").is_null().to_numpy().astype(bool)
        lists = steps.column("items").combine_chunks()
        hot = np.zeros((len(ords), items), np.uint8)
        hot[np.repeat(np.arange(len(ords)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy(zero_copy_only=False) - 1] = 1
        state = _packed_state(np.hstack([_lists(steps.column(c).combine_chunks())[:, :items] for c in ("last", "first", "cnt", f"r{short}", "r100")]))
        seen = _state_matrix(state, ords)[known]
        blobs = [ords.tobytes(), state, zlib.compress(hot.tobytes(), 1), known.astype(np.uint8).tobytes(), seen.sum(axis=0).tobytes(), (seen * seen).sum(axis=0).tobytes()]
        arrays = [pa.array([key[0]], steps.schema.field(SERIES).type), pa.array([int(key[1])], pa.int64()), pa.array([int(known.sum())], pa.int64())]
        return pa.record_batch([*arrays, *[pa.array([b], pa.binary()) for b in blobs]], [SERIES, "block", "n", "ords", "states", "hot", "known", "one", "two"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for whole in kernel(batches):
            batch = whole.filter(pa.array(whole.column("ord").to_numpy() >= warm_up))
            if not batch.num_rows:
                continue
            series, block = batch.column(SERIES).to_pylist(), batch.column("ord").to_numpy() // size
            edges = [i for i in range(1, len(block)) if series[i] != series[i - 1] or block[i] != block[i - 1]]
            for start, end in zip([0, *edges], [*edges, len(block)]):
                key = (series[start], block[start])
                if held and key != at:
                    yield pack(at, held)
                    held = []
                at = key
                held.append(batch.slice(start, end - start))
        if held:
            yield pack(at, held)

    kind = rows.schema[SERIES].dataType.simpleString()
    return materialise(rows.mapInArrow(run, f"{SERIES} {kind}, block long, n long, ords binary, states binary, hot binary, known binary, one binary, two binary"), "states")


def _sums_before(blocks: DataFrame) -> DataFrame:
    """(series, block, before_n, before_one, before_two): sums over all earlier blocks; only the blocks' sums pass through a series' task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, one, two = None, 0, 0.0, 0.0
        for batch in batches:
            for row in batch.to_pylist():
                if row[SERIES] != last:
                    last, n, one, two = row[SERIES], 0, np.zeros(len(row["one"]) // 8), np.zeros(len(row["one"]) // 8)
                yield pa.RecordBatch.from_pylist([{SERIES: last, "block": row["block"], "before_n": n, "before_one": one.tobytes(), "before_two": two.tobytes()}], schema=schema)
                n, one, two = n + row["n"], one + np.frombuffer(row["one"]), two + np.frombuffer(row["two"])

    series = blocks.schema[SERIES].dataType
    made = f"{SERIES} {series.simpleString()}, block long, before_n long, before_one binary, before_two binary"
    schema = pa.schema([(SERIES, pa.int32() if series.simpleString() == "int" else pa.int64() if series.simpleString() == "bigint" else pa.string()), ("block", pa.int64()), ("before_n", pa.int64()), ("before_one", pa.binary()), ("before_two", pa.binary())])
    return blocks.select(SERIES, "block", "n", "one", "two").repartition(SERIES).sortWithinPartitions(SERIES, "block").mapInArrow(run, made)


def _meet_past(k: int, items: int, span: Span):
    """(ord, near) of the query steps of a pair of blocks: the k closest earlier states there, with the items that followed them."""
    entry = pa.struct([("distance", pa.float64()), ("ord", pa.int64()), ("items", pa.list_(pa.int32()))])

    def scales(row: dict, vecs: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Deviation of every dimension over the states known before each row, + 1e-8."""
        seen = np.where(known[:, None], vecs, 0.0)
        one = np.frombuffer(row["before_one"]) + np.vstack([np.zeros(vecs.shape[1]), np.cumsum(seen, axis=0)[:-1]])
        two = np.frombuffer(row["before_two"]) + np.vstack([np.zeros(vecs.shape[1]), np.cumsum(seen * seen, axis=0)[:-1]])
        n = np.maximum(row["before_n"] + np.concatenate([[0], np.cumsum(known)[:-1]]), 1)[:, None]
        return np.sqrt(np.maximum(two / n - (one / n) ** 2, 0.0)) + 1e-8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ords, ords = np.frombuffer(row["q_ords"], "<i8"), np.frombuffer(row["ords"], "<i8")
                q_vecs, vecs = _state_matrix(row["q_states"], q_ords), _state_matrix(row["states"], ords)
                known = np.frombuffer(row["known"], np.uint8).astype(bool)
                hot = np.frombuffer(zlib.decompress(row["hot"]), np.uint8).reshape(len(ords), items)
                scale = scales(row, q_vecs, np.frombuffer(row["q_known"], np.uint8).astype(bool))
                wanted = np.ones(len(q_ords), bool) if span is None else (q_ords >= span[0]) & (q_ords < span[1])
                rows = []
                for part in np.array_split(np.flatnonzero(wanted), max(1, wanted.sum() // 256)):
                    # squared distances of all pairs by two products, then the closest anew; dimensions that never varied take no part
                    weight = np.where(scale[part] > _FLAT, 1 / scale[part] ** 2, 0.0)
                    rough = (vecs * vecs) @ weight.T - 2 * (vecs @ (q_vecs[part] * weight).T)
                    for j, q in enumerate(part):
                        past = np.flatnonzero(known & (ords < q_ords[q]))
                        if not len(past):
                            continue
                        if len(past) > k + SPARE:
                            past = past[np.argpartition(rough[past, j], k + SPARE)[: k + SPARE]]
                        exact = np.sqrt(((vecs[past] - q_vecs[q]) ** 2 * weight[j]).sum(axis=1))
                        best = past[_first(exact, ords[past], k)]
                        near = dict(zip(past.tolist(), exact.tolist()))
                        rows.append((int(q_ords[q]), [{"distance": near[i], "ord": int(ords[i]), "items": (np.flatnonzero(hot[i]) + 1).tolist()} for i in best.tolist()]))
                if rows:
                    key = batch.column(SERIES).type
                    yield pa.record_batch([pa.array([row[SERIES]] * len(rows), key), pa.array([o for o, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.list_(entry))], [SERIES, "ord", "near"])

    return run


def nearest_past(table: StepTable, span: Span = None, k: int = NEIGHBOURS, short: int = 20, warm_up: int = 25) -> DataFrame:
    """series, ord, near: the k earlier states closest to each step's own, as (distance, ord, items that followed), the closest first."""
    items = table.domain.items
    size = table.block if table.block <= STEP_BLOCK else math.gcd(table.block, STEP_BLOCK)  # lies within the blocks of the table
    blocks = _step_blocks(table, size, short, warm_up)
    asked = blocks.join(_sums_before(blocks), [SERIES, "block"])
    if span is not None:
        asked = asked.where(F.col("block").between(span[0] // size, (span[1] - 1) // size))
    queries = asked.select(
        SERIES, F.col("block").alias("asked"), *[F.col(c).alias(f"q_{c}") for c in ("ords", "states", "known")], "before_n", "before_one", "before_two",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("block"))).alias("block"),
    )
    pairs = queries.join(blocks.select(SERIES, "block", "ords", "states", "known", "hot"), [SERIES, "block"])
    kind = blocks.schema[SERIES].dataType.simpleString()
    parts = int(table.spark.conf.get("spark.sql.shuffle.partitions"))
    met = pairs.repartition(parts, SERIES, "asked", "block").mapInArrow(
        _meet_past(k, items, span), f"{SERIES} {kind}, ord long, near array<struct<distance double, ord long, items array<int>>>"
    )
    merged = met.groupBy(SERIES, "ord").agg(F.flatten(F.collect_list("near")).alias("near"))  # k per block of the past
    return merged.select(SERIES, "ord", F.slice(F.array_sort("near"), 1, k).alias("near"))


def neighbour_walk(table: StepTable, span: Span = None, k: int = NEIGHBOURS, short: int = 20, warm_up: int = 25) -> DataFrame:
    """Scores of every step with a past: how many of its k neighbours each item followed."""
    near = nearest_past(table, span, k, short, warm_up).select(SERIES, "ord", F.flatten(F.transform("near", lambda e: e["items"])).alias("_voted"))
    rows = table.df.select(*KEYS).join(near, [SERIES, "ord"])
    votes = F.transform(F.sequence(F.lit(1), F.lit(table.domain.items)), lambda n: F.size(F.filter("_voted", lambda v: v == n)).cast("double"))
    return scored(rows, table, ("knn", votes, F.lit(None).cast("int")))


register("knn", neighbour_walk)


def neighbour_votes(table: StepTable, k: int = NEIGHBOURS, short: int = 20, warm_up: int = 25) -> DataFrame:
    """(item, votes) for the open step of a table of one series; the state before step i votes with step i."""
    scores = neighbour_walk(table.with_request(), (table.longest, table.longest + 1), k, short, warm_up)
    return scores.select(F.posexplode("score").alias("at", "votes")).select((F.col("at") + 1).alias("item"), F.col("votes").cast("long").alias("votes"))
