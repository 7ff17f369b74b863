"""Prefix trie of conversations, rolled up by centroid decomposition of its parent-edge forest.

A node of depth d is a distinct sequence of the first d turns (role, text) of a conversation; the root (d = 0) is textless. A node is named by
its smallest member and its depth.

* Turns are numbered by a range partitioning. A prefix is identified by sums of hashes of (place, turn), added up inside
  blocks of `BLOCK` places and over the blocks, so a conversation that holds most of the turns is never in one task.
* Every node starts with its weight, the rows of its members from its depth on. That is the sum, over its subtree, of members, so
  the first grouping already gives each subtree's weight in the whole trie.
* Decomposition: in a component with total m, the nodes of more than m / 2 form the path from the top (the node nearest to the root) to the centroid, its
  deepest one. The centroid's subtree total is added to every node of that path, the path's weights lose the
  centroid's, and the centroid is taken out: each of its children becomes the top of a component of its own. Weights halve, so the
  number of rounds is logarithmic in the rows, whatever the depth of the trie.
* To tell which child of the centroid a node lies under, its smallest member's prefix one turn below the centroid is looked up.
* Components of at most `local` rows are decomposed in the same way inside tasks, one at a time.

Order of turns: `turn`, null first; rows of one turn by digests of role and text. Null roles and texts are empty ones. Rows without conv_id
belong to no conversation. Repeated rows are turns of their own. An empty table has no trie, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setstride.llm.tables import n_partitions, stored
from setstride.operators.layout import ordinal

BLOCK = 4096
LOCAL = 1 << 14
ID_BITS = 12
_PIECES = ("a", "b", "e", "f")
_EMPTY = hashlib.sha256().hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, ord (from 0), two digests of (role, text), and the UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("x"),
        F.xxhash64(F.lit(1), text, role).alias("y"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return ordinal(turns, ["turn", "x", "y"], "conv_id").drop("turn")


def rebuilt(numbered: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Every conversation c anew: the first h turns of c - c % group, then its own after its first h; h = crc32(c) % most.

    Gives the turns (conv_id, pos from 1, x, y, bytes, size) and the conversations (conv_id, size), turnless ones included.
    """
    sizes = numbered.groupBy("conv_id").agg(F.count("*").alias("n"))
    sizes = sizes.select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
    )
    base = sizes.select(F.col("conv_id").alias("base"), F.least("n", F.lit(most)).alias("held"))
    ids = sizes.join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("held", F.lit(0))))
    ids = stored(ids.select("conv_id", "base", "h", "head", (F.col("head") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("size")), "trie-conversations")
    own = numbered.join(ids, "conv_id").where(F.col("ord") >= F.col("h"))
    own = own.select("conv_id", (F.col("head") + F.col("ord") - F.col("h") + 1).alias("pos"), "x", "y", "bytes", "size")
    heads = numbered.where(F.col("ord") < most).withColumnRenamed("conv_id", "base").join(ids.where("head > 0"), "base").where(F.col("ord") < F.col("h"))
    heads = heads.select("conv_id", (F.col("ord") + 1).alias("pos"), "x", "y", "bytes", "size")
    return own.unionByName(heads), ids.select("conv_id", "size")


def _key(at: Column, sums: list[Column]) -> tuple[Column, Column]:
    return F.xxhash64(at, *sums), F.xxhash64(F.lit(1), *reversed(sums), at)


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Turns with the key (k1, k2) of the prefix that ends with each, and (p1, p2) of the one before it."""
    half = F.lit((1 << 32) - 1)
    one, two = F.xxhash64("pos", "x", "y"), F.xxhash64(F.lit(1), "y", "x", "pos")
    pieces = [one.bitwiseAND(half), F.shiftrightunsigned(one, 32), two.bitwiseAND(half), F.shiftrightunsigned(two, 32)]
    rows = turns.select("*", F.call_function("div", F.col("pos") - 1, F.lit(block)).alias("block"), *[p.alias(n) for n, p in zip(_PIECES, pieces)])
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.where(F.col("size") > block).groupBy("conv_id", "block").agg(*[F.sum(n).alias(n) for n in _PIECES])
    carried = totals.select("conv_id", "block", *[F.sum(n).over(before).alias(f"_{n}") for n in _PIECES]).where("block > 0")
    sums = rows.select("*", *[F.sum(n).over(upto).alias(f"s{n}") for n in _PIECES]).join(carried, ["conv_id", "block"], "left")
    here = [F.col(f"s{n}") + F.coalesce(f"_{n}", F.lit(0)) for n in _PIECES]
    k1, k2 = _key(F.col("pos"), here)
    p1, p2 = _key(F.col("pos") - 1, [h - F.col(n) for h, n in zip(here, _PIECES)])
    return sums.select("conv_id", "pos", "bytes", "size", k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"))


def trie(turns: DataFrame, conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie of `turns` (conv_id, pos, x, y, bytes, size) of `conversations` (conv_id, size)."""
    rows = stored(prefixes(turns), "trie-rows")
    key = ["pos", "k1", "k2"]
    below = rows.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.sum(F.col("size") - F.col("pos") + 1).alias("weight"),
    )
    below = stored(below, "trie-below")
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("size") + 1).alias("weight")).where("n_convs > 0")
    root = stored(root.select(zero.alias("pos"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("bytes"), zero.alias("p1"), zero.alias("p2"), "weight"), "trie-root")

    # parents: the children of the root, of which there may be very many, need no join
    upper = below.select((F.col("pos") + 1).alias("pos"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    deep = below.where("pos > 1").join(upper, ["pos", "p1", "p2"])
    first = below.where("pos = 1").join(F.broadcast(root.select(F.col("conv_id").alias("parent"))), how="cross")  # one row
    named = deep.unionByName(first, allowMissingColumns=True).unionByName(root.withColumn("parent", F.lit(None).cast("long")))
    children = named.where("parent is not null").groupBy(F.col("parent").alias("conv_id"), (F.col("pos") - 1).alias("pos")).agg(F.count("*").alias("n_children"))
    nodes = named.join(children, ["conv_id", "pos"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes.drop("p1", "p2"), "trie-nodes")

    values = {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")}
    rolled = rollup(nodes, root, rows, values, local)
    ends = member_digests(rows, conversations, nodes)
    return (
        nodes.join(rolled, ["conv_id", "pos"]).join(ends, ["conv_id", "pos"], "left")
        .select(
            "conv_id", F.col("pos").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def rollup(nodes: DataFrame, root: DataFrame, rows: DataFrame, values: dict[str, Column], local: int = LOCAL) -> DataFrame:
    """(conv_id, pos) with each of `values` summed over the node's subtree; see the module for the method."""
    zero = F.lit(0).cast("long")
    whole = F.broadcast(root.select(F.col("conv_id").alias("top"), F.col("weight").alias("m")))  # one row
    live = nodes.join(whole, how="cross").select(
        "top", zero.alias("top_pos"), "m", "conv_id", "pos", "parent", "k1", "k2", F.col("weight").alias("r"),
        *[v.alias(f"v_{n}") for n, v in values.items()], *[zero.alias(n) for n in values],
    )
    live = stored(live, "trie-live")
    done, small = [], [live.where(F.col("m") <= local)]
    live = live.where(F.col("m") > local)
    while live.limit(1).count():
        level = _split(live, rows, list(values))
        done.append(level.where("centre").select("conv_id", "pos", *values))
        rest = level.where("not centre").drop("centre")
        small.append(rest.where(F.col("m") <= local))
        live = rest.where(F.col("m") > local)
    out = done
    bounded = _union(small)
    component = ["top", "top_pos"]
    within = bounded.repartition(n_partitions(nodes.sparkSession), *component).sortWithinPartitions(*component, "pos")
    kinds = ", ".join(f"{n} long" for n in values)
    out.append(within.mapInArrow(_decompose(list(values)), f"conv_id long, pos long, {kinds}"))
    return _union(out)


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for f in others:
        first = first.unionByName(f)
    return first


def _split(live: DataFrame, rows: DataFrame, names: list[str]) -> DataFrame:
    """One round for all components: take out each centroid (`centre`) and give the other nodes their new component."""
    component = ["top", "top_pos"]
    heavy = F.col("r") * 2 > F.col("m")
    centres = live.where(heavy).groupBy(*component).agg(F.max(F.struct("pos", "conv_id", "r")).alias("z"))
    centres = centres.select(*component, F.col("z.pos").alias("z_pos"), F.col("z.conv_id").alias("z_conv"), F.col("z.r").alias("z_r"))
    tagged = stored(live.join(centres, component).withColumn("centre", (F.col("conv_id") == F.col("z_conv")) & (F.col("pos") == F.col("z_pos"))), "trie-tagged")

    # the child of the centroid that a node lies under, if it does
    asked = tagged.where(F.col("pos") > F.col("z_pos")).select("conv_id", (F.col("z_pos") + 1).alias("at")).distinct()
    child = tagged.where((F.col("parent") == F.col("z_conv")) & (F.col("pos") == F.col("z_pos") + 1))
    child = child.select(F.col("pos").alias("at"), "k1", "k2", F.col("conv_id").alias("new_top"), F.col("r").alias("new_m"))
    prefix = rows.select("conv_id", F.col("pos").alias("at"), "k1", "k2")
    under = asked.join(prefix, ["conv_id", "at"]).join(child, ["at", "k1", "k2"]).select("conv_id", "at", "new_top", "new_m")
    below = F.when(F.col("pos") > F.col("z_pos"), F.col("z_pos") + 1)
    placed = stored(tagged.withColumn("at", below).join(under, ["conv_id", "at"], "left"), "trie-placed")

    totals = placed.where(F.col("centre") | F.col("new_top").isNotNull()).groupBy(*component).agg(*[F.sum(f"v_{n}").alias(f"t_{n}") for n in names])
    moved = F.col("new_top").isNotNull()
    path = heavy & ~moved
    level = placed.join(totals, component).select(
        F.coalesce("new_top", "top").alias("top"),
        F.when(moved, F.col("at")).otherwise(F.col("top_pos")).alias("top_pos"),
        F.coalesce("new_m", F.col("m") - F.col("z_r")).alias("m"),
        "conv_id", "pos", "parent", "k1", "k2",
        (F.col("r") - F.when(path, F.col("z_r")).otherwise(0)).alias("r"),
        *[f"v_{n}" for n in names],
        *[(F.col(n) + F.when(path, F.col(f"t_{n}")).otherwise(0)).alias(n) for n in names],
        "centre",
    )
    return stored(level, "trie-level")


def _decompose(names: list[str]):
    """Whole components, sorted by (top, top_pos, pos): the same rounds over the rows of one component after the other."""

    def one(part: dict[str, list]) -> None:
        size = len(part["pos"])
        place = {k: i for i, k in enumerate(zip(part["conv_id"], part["pos"]))}
        parent = [place.get((p, d - 1), -1) for p, d in zip(part["parent"], part["pos"])]
        weight = part["r"]
        waiting = [list(range(size))]
        while waiting:
            nodes = waiting.pop()  # by depth, the top first
            total = weight[nodes[0]]
            path = [v for v in nodes if 2 * weight[v] > total]
            centre = path[-1]
            label: dict[int, int] = {}
            parts: dict[int, list[int]] = {}
            for v in nodes:
                if v != centre:
                    label[v] = v if parent[v] == centre else label.get(parent[v], -1)
                    parts.setdefault(label[v], []).append(v)
            inside = [centre, *(v for v in nodes if label.get(v, -1) >= 0)]
            for n in names:
                add = sum(part[f"v_{n}"][v] for v in inside)
                for v in path:
                    part[n][v] += add
            lost = weight[centre]
            for v in path:
                weight[v] -= lost
            waiting.extend(parts.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["conv_id", "pos", "parent", "r", *[f"v_{n}" for n in names], *names]
        for table in _groups(batches, ["top", "top_pos"]):
            part = {c: table.column(c).to_pylist() for c in columns}
            one(part)
            yield pa.record_batch([pa.array(part[c], pa.int64()) for c in ("conv_id", "pos", *names)], ["conv_id", "pos", *names])

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal key, one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            here = tuple(c[a] for c in columns)
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = here
    if held:
        yield pa.Table.from_batches(held)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, pos, part, ids): one running SHA-256 per node; only a batch of id texts is held."""
    last, state = None, None

    def row():
        return pa.record_batch([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "pos", "ends_sha256"])

    for batch in batches:
        for c, d, ids in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "pos", "ids"))):
            if (c, d) != last:
                if last is not None:
                    yield row()
                last, state = (c, d), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if last is not None:
        yield row()


def member_digests(rows: DataFrame, conversations: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv_id, pos, ends_sha256) of the nodes that conversations end at. Ids are joined in parts of at most 2^12, then the
    parts of a node pass through one digest in order."""
    part = F.shiftright("conv_id", ID_BITS).alias("part")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    ended = rows.where("pos = size").groupBy("pos", "k1", "k2", part).agg(ids)
    ended = ended.join(nodes.select("pos", "k1", "k2", "conv_id"), ["pos", "k1", "k2"]).select("conv_id", "pos", "part", "ids")
    turnless = conversations.where("size = 0").groupBy(part).agg(ids).join(F.broadcast(nodes.where("pos = 0").select("conv_id", "pos")), how="cross")  # one row
    both = ended.unionByName(turnless.select("conv_id", "pos", "part", "ids"))
    sorted_parts = both.repartition(n_partitions(nodes.sparkSession), "conv_id", "pos").sortWithinPartitions("conv_id", "pos", "part")
    return sorted_parts.mapInArrow(_digest, "conv_id long, pos long, ends_sha256 string")


def rebuilt_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """The trie of all conversations, each rebuilt on the head of its group's first one."""
    numbered = stored(numbered_turns(conversations), "trie-turns")
    turns, ids = rebuilt(numbered)
    return trie(turns, ids, local)
