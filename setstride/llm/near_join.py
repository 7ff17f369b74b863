"""N-gram Jaccard join with token-combination prefixes.

Two documents link when the Jaccard similarity of their distinct k-word shingles ("tokens") reaches a threshold.

* Every token has a global order: the load of its cell in a hashed frequency table that counts all documents
  (rarest first), then its hash. Loads also give its class: 1 rare, 2 frequent, 3 very frequent.
* A document indexes single tokens of class 1, but pairs of class 2 and triples of class 3, so that no signature
  is shared merely because of a boilerplate passage. Classes 2 and 3 are cut into parts so that long documents
  have few combinations. Documents linked at threshold t miss at most n - ceil(t n) of each other's tokens;
  a part of which c tokens stand in the prefix surely loses none of its k-combinations only by missing
  c - k + 1 of them, so the prefix is extended until these sums reach n - ceil(t n) + 1. Then two linked documents
  share a signature.
* Equal sets are one node from the start. In every signature group each member is verified against one leader (the member with
  the fewest rare tokens, most like the others), a count linear in the group. Only members of groups that are still in different
  components are then compared with each other, inside tasks, in blocks of bounded size, by sketches: whether the tokens in each of
  `SKETCH` cells are odd in number. Every cell in which two sketches differ holds a token that only one set has, which bounds the
  overlap from above, closely up to some 2 * `SKETCH` tokens. What leaves these tasks first are the *members* that have a
  partner, each with its closest one, not the pairs. The closest pairs, linear in the members, are verified first, so that components
  grow together before pairs are made. For members with a partner, and only those, the tokens that any other of them also has are
  counted exactly (`shared`): a token that is nowhere else cannot be in an overlap, so two texts with edits of their own are told apart
  without a comparison, however many of them a group holds. Pairs of different components that sizes, sketches and shared tokens still
  allow leave one of the groups they share, not all: that of the least signature among the `FIRST` least of both members, which every
  row carries. Only pairs with none in common there leave each group. They are verified on whole sets. No link is lost, and groups of
  copies never expand into pairs.

Null, empty and blank texts have no tokens and link with nothing. Texts shorter than a shingle are one token.
Repeated rows of one doc_id are one document in the classes; null ids are left out of the index. Sets are of 64-bit hashes, nodes 64-bit
digests of sets; the verification compares whole sets.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.llm.components import components
from setstride.llm.tables import discard, n_partitions, stored
from setstride.llm.textkit import shingle_sets

CELL_BITS = 22
RANGES = 64
SKETCH = 1024
BLOCK = 1024
FIRST = 16
_SETS = "doc_id long, node long, n int, sketch array<int>"
_INDEX = "signature long, node long, rare int"
_FIRSTS = [f"first{i}" for i in range(FIRST)]


@dataclass(frozen=True)
class Similarity:
    """`per_hundred` of 100: a link needs 100 * common >= per_hundred * united; `words` in a shingle."""

    words: int = 5
    per_hundred: int = 80

    def least(self, n: int) -> int:
        """Tokens that a set of n shares at least with any partner."""
        return -(-self.per_hundred * n // 100)

    def could_hold(self, na: str, nb: str, sa: str, sb: str) -> Column:
        """False only where sizes and sketches rule a link out: no overlap exceeds half of what the sketches have in common."""
        n = F.col(na) + F.col(nb)
        fits = (F.col(na) * 100 >= self.per_hundred * F.col(nb)) & (F.col(nb) * 100 >= self.per_hundred * F.col(na))
        differ = F.zip_with(sa, sb, lambda x, y: F.bit_count(x.bitwiseXOR(y).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))
        apart = F.aggregate(differ, F.lit(0), lambda t, d: t + d)
        return fits & (100 * (n - apart) >= self.per_hundred * (n + apart))

    def holds(self, common: Column, left: Column, right: Column) -> Column:
        return 100 * common >= self.per_hundred * (left + right - common)


def _digest(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """A bit for each of `SKETCH` cells: set if an odd number of tokens falls into it."""
    counts = np.bincount(((tokens >> np.uint64(16)) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int32)


def _sketches(rows: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (SKETCH // 32)), pa.array(flat, pa.int32()))


def _read_sets(rule: Similarity):
    """One row per document, then the task's share of the frequency table in `RANGES` dense pieces."""

    def run(batches):
        counts = np.zeros(1 << CELL_BITS, np.int64)
        piece = len(counts) // RANGES
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = ([], [], [], [])
            waiting: list[np.ndarray] = []
            held = 0
            for i, tokens in shingle_sets(batch.column(1), rule.words):
                rows[0].append(ids[i])
                rows[1].append(_digest(tokens) if len(tokens) else None)
                rows[2].append(len(tokens))
                rows[3].append(_sketch(tokens))
                waiting.append(tokens)
                held += len(tokens)
                if held > 1 << 20:
                    counts += _loads(waiting)
                    waiting, held = [], 0
            counts += _loads(waiting)
            n = len(rows[0])
            yield pa.record_batch(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int32()), _sketches(rows[3]), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                ["doc_id", "node", "n", "sketch", "range", "loads"],
            )
        if counts.any():
            blobs = [np.minimum(counts[r * piece : (r + 1) * piece], 2**32 - 1).astype("<u4").tobytes() for r in range(RANGES)]
            yield pa.record_batch(
                [pa.nulls(RANGES, pa.int64()), pa.nulls(RANGES, pa.int64()), pa.nulls(RANGES, pa.int32()), pa.nulls(RANGES, pa.list_(pa.int32())), pa.array(range(RANGES), pa.int32()), pa.array(blobs, pa.binary())],
                ["doc_id", "node", "n", "sketch", "range", "loads"],
            )

    return run


def _loads(sets: list[np.ndarray]) -> np.ndarray:
    if not sets:
        return np.zeros(1, np.int64)
    return np.bincount((np.concatenate(sets) >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=1 << CELL_BITS)


def _add_loads(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the dense pieces of one range; one piece is held at a time."""
    total = np.zeros(1, np.int64)
    for batch in batches:
        for blob in batch.column("loads"):
            total = total + np.frombuffer(blob.as_buffer(), "<u4")
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())], ["range", "loads"])


def frequency_classes(loads: DataFrame) -> np.ndarray:
    """Order of every cell of the frequency table, 0 to 255 on a logarithmic scale, and so its class.

    The table has 2^22 cells whatever the input, so the driver and each task hold 4 MB.
    """
    part = loads.withColumn("part", F.pmod(F.xxhash64("loads"), F.lit(64)).cast("int"))
    first = part.groupBy("range", "part").applyInArrow(_add_loads, "range int, loads binary")
    total = first.groupBy("range").applyInArrow(_add_loads, "range int, loads binary")
    cells = np.zeros((RANGES, (1 << CELL_BITS) // RANGES), np.int64)
    for row in total.toLocalIterator():
        cells[row["range"]] = np.frombuffer(row["loads"], "<u4")
    cells = cells.ravel()
    return _order_of(cells), _order_of(np.array(_class_bounds(cells.mean())))


def _order_of(loads: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.round(11.5 * np.log2(1 + loads))).astype(np.uint8)


def _class_bounds(mean: float) -> list[float]:
    """Largest load of class 1 and of class 2."""
    rare = mean + 4 * math.sqrt(mean) + 16
    return [rare, 16 * rare]


def _parts(level: int, rule: Similarity) -> int:
    """Parts of each frequent class for sets of 2^level tokens and more: some three prefix tokens in each."""
    return max(1, (100 - rule.per_hundred) * (1 << level) // 300)


def signatures(tokens: np.ndarray, order: np.ndarray, bounds: np.ndarray, rule: Similarity) -> np.ndarray:
    """Signatures of one set (see the module): hashes of single tokens, pairs and triples."""
    n = len(tokens)
    least = rule.least(n)
    missing = n - least + 1
    if not n or n * 100 < rule.per_hundred * (n + 1) and (n - 1) * 100 < rule.per_hundred * n:
        return tokens[:0]  # no set of another size or other tokens can reach the threshold
    rank = order[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    key = (rank.astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8))
    place = np.argsort(key, kind="stable")
    rank, ordered = rank[place], tokens[place]
    rare = int(np.searchsorted(rank, bounds[0], "right"))
    if rare >= missing:
        return ordered[:missing]
    out = [ordered[:rare]]
    frequent = ordered[rare:]
    size = np.where(rank[rare:] > bounds[1], 3, 2)
    low = max(1, least)
    for level in range(low.bit_length() - 1, n.bit_length()):
        out.append(_combinations(frequent, size, missing - rare, level, rule))
    return np.unique(np.concatenate(out))


def _combinations(tokens: np.ndarray, size: np.ndarray, missing: int, level: int, rule: Similarity) -> np.ndarray:
    parts = _parts(level, rule)
    if rule.least(1 << level) - 1 < 3 * parts:  # too few tokens for combinations of this many parts
        size = np.ones_like(size)
    part = (tokens % np.uint64(parts)).astype(np.int64) * 4 + size
    found: dict[int, list[int]] = {}
    for t, p, k in zip(tokens.tolist(), part.tolist(), size.tolist()):
        held = found.setdefault(p, [])
        held.append(t)
        if len(held) >= k:
            missing -= 1
            if not missing:
                break
    out = [xxhash.xxh3_64_intdigest(np.array((level, p, *c), np.uint64).tobytes()) for p, held in found.items() for c in itertools.combinations(sorted(held), p % 4)]
    return np.array(out, np.uint64)


def _write_index(order: np.ndarray, bounds: np.ndarray, rule: Similarity):
    def run(batches):
        for batch in batches:
            sigs, nodes, rares, held = [], [], [], 0
            for _, tokens in shingle_sets(batch.column(0), rule.words):
                if not len(tokens):
                    continue
                s = signatures(tokens, order, bounds, rule)
                rare = int((order[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)] <= bounds[0]).sum())
                if len(s):
                    sigs.append(s)
                    nodes.append(np.full(len(s), _digest(tokens), np.int64))
                    rares.append(np.full(len(s), rare, np.int32))
                    held += len(s)
                if held > 1 << 18:
                    yield _index_batch(sigs, nodes, rares)
                    sigs, nodes, rares, held = [], [], [], 0
            if held:
                yield _index_batch(sigs, nodes, rares)

    return run


def _index_batch(sigs, nodes, rares):
    return pa.record_batch([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(rares))], ["signature", "node", "rare"])


def _write_tokens(rule: Similarity):
    def run(batches):
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            out, ids, held = [], [], 0
            for i, tokens in shingle_sets(batch.column(1), rule.words):
                out.append(tokens.view(np.int64))
                ids.append(nodes[i])
                held += len(tokens)
                if held > 1 << 19:
                    yield _token_batch(ids, out)
                    out, ids, held = [], [], 0
            if ids:
                yield _token_batch(ids, out)

    return run


def _token_batch(ids, out):
    offsets = np.concatenate(([0], np.cumsum([len(o) for o in out]))).astype(np.int32)
    return pa.record_batch([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out)))], ["node", "tokens"])


def _tokens_of(wanted: DataFrame, texts: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """(node, tokens) of the wanted nodes, from one text each."""
    one = sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    chosen = texts.join(one, "doc_id").select("node", "text")
    return stored(chosen.mapInArrow(_write_tokens(rule), "node long, tokens array<long>"), "near-tokens")


def _verified(pairs: DataFrame, texts: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """(a, b, linked) for candidate pairs of nodes, decided on whole token sets read again from one text per node."""
    tokens = _tokens_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), texts, sets, rule)
    left = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("left", "right"))
    return both.select("a", "b", rule.holds(common, F.size("left"), F.size("right")).alias("linked")).distinct()


def _dealt(members: DataFrame, *more: str) -> DataFrame:
    """Members of each group (signature, node, root, n, sketch, members) in the order of their units: a group of more than
    `BLOCK` members is cut into blocks, and every two blocks are a unit, so that a task holds two blocks."""
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    rows = members.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    units = other.select("signature", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "root", "n", "sketch", *more)
    key = ["signature", "low", "high"]
    return units.repartition(n_partitions(members.sparkSession), *key).sortWithinPartitions(*key)


def _partners(unit: dict[str, np.ndarray], rule: Similarity) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each member of a unit with the later ones, of other components, that sizes, sketches and shared tokens allow it to link with, and how far these are apart."""
    low, high = int(unit["low"][0]), int(unit["high"][0])
    block, root, n, sketch = unit["block"], unit["root"], unit["n"].astype(np.int64), unit["sketch"]
    if (root == root[0]).all():
        return
    most = unit.get("shared", n).astype(np.int64)
    within = low == high
    for i in np.flatnonzero(block == low) if not within else range(len(root)):
        other = np.arange(len(root)) > i if within else block == high
        bound = np.minimum(most, most[i])
        other = np.flatnonzero(other & (root != root[i]) & (100 * np.minimum(np.minimum(n, n[i]), bound) >= rule.per_hundred * (n + n[i] - bound)))
        if len(other):
            apart = np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            total = n[other] + n[i]
            near = 100 * (total - apart) >= rule.per_hundred * (total + apart)
            if near.any():
                yield i, other[near], apart[near]


def _by_unit(names: tuple[str, ...], found, out: list[str]):
    """A kernel over units: `found` gives rows for each, as tuples of the columns `out`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            if held and (batch is None or _unit(held[-1], -1) != _unit(batch, 0)):
                yield from units(held)
                held = []
            if batch is not None:
                held.append(batch)
                ends = _ends(batch)
                if len(ends) > 1:  # all but the last unit are whole
                    yield from units([*held[:-1], batch.slice(0, ends[-2])])
                    held = [batch.slice(ends[-2])]

    def units(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        batch = table.to_batches()[0]
        column = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("signature", "low", "high", "block", "node", "root", "n", *names)}
        column["sketch"] = batch.column("sketch").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, SKETCH // 64)
        rows: list[tuple] = []
        at = 0
        for end in _ends(batch):
            rows.extend(found({name: c[at:end] for name, c in column.items()}))
            at = end
            if len(rows) > 1 << 16 or end == batch.num_rows and rows:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], out)
                rows = []

    return run


def _open(rule: Similarity):
    """(signature, node, closest): the members of a unit that have a partner there, each with the one least apart."""

    def found(unit: dict[str, np.ndarray]):
        size = len(unit["node"])
        least, closest = np.full(size, np.iinfo(np.int64).max), np.full(size, -1)
        for i, other, apart in _partners(unit, rule):
            j = int(apart.argmin())
            if apart[j] < least[i]:
                least[i], closest[i] = apart[j], other[j]
            nearer = apart < least[other]
            least[other[nearer]], closest[other[nearer]] = apart[nearer], i
        paired = np.flatnonzero(closest >= 0)
        node = unit["node"]
        return [(int(unit["signature"][0]), v, c) for v, c in zip(node[paired].tolist(), node[closest[paired]].tolist())]

    return _by_unit((), found, ["signature", "node", "closest"])


def _meet(rule: Similarity):
    """(a, b): pairs of members of a unit that are in different components and could link.

    A pair leaves only the group of the least signature that both have among their `FIRST` least ones, and every group it shares if there is none.
    To name the least of all, each row would have to hold all signatures of its node."""

    def found(unit: dict[str, np.ndarray]):
        node, signature = unit["node"].tolist(), unit["signature"][0]
        firsts = np.stack([unit[name] for name in _FIRSTS], axis=1)
        none = np.iinfo(np.int64).max
        for i, other, _ in _partners(unit, rule):
            theirs = firsts[other]
            least = np.where(np.isin(theirs, firsts[i]), theirs, none).min(axis=1)
            for j in other[(least == signature) | (least == none)].tolist():
                yield (node[i], node[j]) if node[i] < node[j] else (node[j], node[i])

    return _by_unit(("shared", *_FIRSTS), found, ["a", "b"])


def _first_signatures(paired: DataFrame) -> DataFrame:
    """(node, first0, first1, ...): the `FIRST` least signatures of each node of `paired`; a node with fewer has its last one repeatedly."""
    lists = paired.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("signature")), 1, FIRST).alias("first"))
    return lists.select("node", *[F.coalesce(F.get("first", F.lit(i)), F.element_at("first", -1)).alias(name) for i, name in enumerate(_FIRSTS)])


def _own_or_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, node, n) from (node, tokens): a token that several nodes of a batch have gives one row with n = 2 and no node, and its nodes a row
    without token that counts it; other tokens go with their node. So a token that very many nodes have is few rows."""
    for batch in batches:
        nodes, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        of = np.repeat(nodes, lists.value_lengths().to_numpy(zero_copy_only=False))
        tokens, at, counts = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        alone = counts[at] == 1
        order = np.flatnonzero(alone)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        known, times = np.unique(of[~alone], return_counts=True)
        both = tokens[counts > 1]
        yield pa.record_batch(
            [
                pa.concat_arrays([pa.array(flat[order]), pa.array(both), pa.nulls(len(known), pa.int64())]),
                pa.concat_arrays([pa.array(of[order]), pa.nulls(len(both), pa.int64()), pa.array(known)]),
                pa.array(np.concatenate([np.ones(len(order), np.int64), np.full(len(both), 2), times])),
            ],
            ["token", "node", "n"],
        )


def _shared_counts(tokens: DataFrame) -> DataFrame:
    """(node, shared): at most so many tokens of each node (node, tokens) some other node also has; nodes without any are absent.

    The count is exact unless a node stands repeatedly, which only raises it."""
    met = stored(tokens.mapInArrow(_own_or_known, "token long, node long, n long"), "near-own")
    tall = met.where("token is not null")
    common = tall.groupBy("token").agg(F.sum("n").alias("times")).where("times > 1").select("token")
    elsewhere = tall.where("node is not null").join(common, "token").select("node", F.lit(1).cast("long").alias("n"))
    return elsewhere.unionByName(met.where("token is null").select("node", "n")).groupBy("node").agg(F.sum("n").alias("shared"))


def _unit(batch: pa.RecordBatch, i: int) -> tuple:
    i = i % batch.num_rows
    return tuple(batch.column(k)[i].as_py() for k in ("signature", "low", "high"))


def _ends(batch: pa.RecordBatch) -> list[int]:
    """Ends of the units of sorted rows."""
    change = np.zeros(batch.num_rows - 1, bool)
    for k in ("signature", "low", "high"):
        c = batch.column(k).to_numpy(zero_copy_only=False)
        change |= c[1:] != c[:-1]
    return [*(np.flatnonzero(change) + 1).tolist(), batch.num_rows]


def _joined(pairs: DataFrame, tested: DataFrame, links: DataFrame, component: DataFrame, texts: DataFrame, sets: DataFrame, rule: Similarity) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tested pairs, links and components once the untested ones of `pairs` (a, b) are verified too."""
    known = tested.select("a", "b").unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = stored(pairs.join(known, ["a", "b"], "left_anti"), "near-rest")
    if not rest.limit(1).count():
        return tested, links, component
    more = stored(_verified(rest, texts, sets, rule), "near-rest-tested")
    tested, found = tested.unionByName(more), more.where("linked").select("a", "b")
    if not found.limit(1).count():
        return tested, links, component
    links = links.unionByName(found)
    return tested, links, components(links)


def classes(documents: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of its component, itself included): one row per row of `documents`."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = stored(texts.mapInArrow(_read_sets(rule), f"{_SETS}, range int, loads binary"), "near-sets")
    sets = read.where(F.col("range").isNull()).select("doc_id", "node", "n", "sketch")
    order, bounds = frequency_classes(read.where(F.col("range").isNotNull()).select("range", "loads"))
    index = stored(texts.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(_write_index(order, bounds, rule), _INDEX), "near-index")

    # within a group, members are met by one leader first
    groups = index.groupBy("signature").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("signature")
    near = stored(index.join(groups, "signature"), "near-groups")
    discard(index)
    leaders = near.groupBy("signature").agg(F.min(F.struct("rare", "node")).alias("first")).select("signature", F.col("first.node").alias("a"))
    led = near.join(leaders, "signature").where("node != a").select("a", F.col("node").alias("b")).distinct()
    size = sets.where("node is not null").groupBy("node").agg(F.max("n").alias("n"), F.max("sketch").alias("sketch"))
    left, right = (size.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in ("a", "b"))
    known = stored(led.join(left, "a").join(right, "b").where(rule.could_hold("na", "nb", "sa", "sb")).select("a", "b"), "near-led")
    tested = stored(_verified(known, texts, sets, rule), "near-tested")
    links = tested.where("linked").select("a", "b")
    component = components(links)

    # groups that hold several components: members of different components meet each other
    member = near.join(component.withColumnRenamed("root", "found"), "node", "left").select("signature", "node", F.coalesce("found", "node").alias("root"))
    mixed = member.groupBy("signature").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"))
    mixed = mixed.where("low != high").select("signature", "members")
    open_members = member.distinct().join(mixed, "signature").join(size, "node")
    opened = _dealt(open_members).mapInArrow(_open(rule), "signature long, node long, closest long")
    paired = stored(opened.groupBy("signature", "node").agg(F.min("closest").alias("closest")), "near-paired")
    closest = paired.select(F.least("node", "closest").alias("a"), F.greatest("node", "closest").alias("b")).distinct()
    tested, links, component = _joined(closest, tested, links, component, texts, sets, rule)
    tokens = _tokens_of(paired.select("node").distinct(), texts, sets, rule)
    shared = stored(_shared_counts(tokens), "near-shared")
    discard(tokens)
    nodes = shared.join(size, "node").join(component.withColumnRenamed("root", "found"), "node", "left")
    nodes = nodes.select("node", "n", "sketch", "shared", F.coalesce("found", "node").alias("root"))
    left = paired.join(paired.groupBy("signature").agg(F.count("*").alias("members")), "signature").join(nodes, "node").join(_first_signatures(paired), "node")
    met = stored(_dealt(left, "shared", *_FIRSTS).mapInArrow(_meet(rule), "a long, b long").distinct(), "near-met")
    _, _, component = _joined(met, tested, links, component, texts, sets, rule)

    # least doc_id of each component, then back to all documents
    ids = sets.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    named = ids.join(component, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component"))
    of_node = named.join(lowest, "root").select("node", "component")
    return sets.join(of_node, "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def one_of_each(documents: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """The documents without those that a linked one of smaller doc_id stands for; repeated rows stay once, null ids stay."""
    gone = classes(documents, rule).where("component_id != doc_id").select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti").distinct().select(documents.columns)
