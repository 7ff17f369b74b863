"""Sharding by jump consistent hashing, as row expressions over the document id.

A key walks from shard to shard with a linear congruential generator until the next jump passes the shard count. The
shard depends on key and count alone, so no ring table is kept; with one more shard, rows move only into the new one.

The 64-bit product of the generator is kept in two halves of 32 bits, as products of longs must not overflow. Slots number the rows of a
shard by (doc_id, size, checksum) through a range partitioning, never in one task per shard. Null ids are key 0; null texts have
no bytes. Repeated rows get slots of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.operators.layout import ordinal

#: Fixed values of the published generator: key * MULTIPLIER + 1 modulo 2^64, 31 bits of which drive the jump.
MULTIPLIER = 2862933555777941757
JUMP_BITS = 31
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
_MASK = (1 << 32) - 1


def _low32(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_MASK))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """Both halves of (high * 2^32 + low) * MULTIPLIER + 1 modulo 2^64, from products below 2^63."""
    small, large = _LOW & 0xFFFF, _LOW >> 16
    first = low * F.lit(small) + 1
    second = low * F.lit(large)
    bottom = first + F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16)
    cross = _low32(high * F.lit(small)) + F.shiftleft(_low32(high * F.lit(large)).bitwiseAND(F.lit(0xFFFF)), 16) + _low32(low * F.lit(_HIGH))
    top = F.shiftright(bottom, 32) + F.shiftright(second, 16) + cross
    return _low32(top), _low32(bottom)


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 .. shards - 1 of a long key (null: key 0)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        _low32(F.shiftright(key, 32)).alias("high"), _low32(key).alias("low"),
        F.lit(0).cast("long").alias("at"), F.lit(False).alias("done"),
    )

    def jump(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        # a jump ahead of the present shard, or the end of the walk; the state of a walk that has ended stays
        to = F.floor((s["at"] + 1).cast("double") * (F.lit(float(1 << JUMP_BITS)) / (F.shiftright(high, 1) + 1).cast("double"))).cast("long")
        ends = s["done"] | (to >= shards)
        return F.struct(
            F.when(ends, s["high"]).otherwise(high).alias("high"), F.when(ends, s["low"]).otherwise(low).alias("low"),
            F.when(ends, s["at"]).otherwise(to).alias("at"), ends.alias("done"),
        )

    # every jump moves ahead, so `shards` steps are enough
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["at"]).cast("int")


def assign(documents: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of `documents`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        shard_of(F.col("doc_id"), shards).alias("shard"),
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )
    numbered = ordinal(placed, ["doc_id", "size", "text_crc32"], series="shard", name="slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )

