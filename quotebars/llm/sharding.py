"""Shards by jump consistent hashing, in DataFrame functions only.

A key's shard follows from the key and the number of shards alone: no ring, no table. With
one more shard a key either stays or moves into the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotebars.llm.ranks import rank, sort_files
from quotebars.session import scratch_dir

#: the generator of the published algorithm: key = key * MULTIPLIER + 1 modulo 2^64
MULTIPLIER = 2862933555777941757
_WRAP = 1 << 64


def jump_hash(key: Column, shards: int) -> Column:
    """The shard (int) of a 64-bit ``key`` among ``shards``; a null key is taken as 0.

    The generator's state is an unsigned 64-bit number in a decimal(20): its product with the
    multiplier stays below 10^38, so decimal arithmetic gives the exact remainder. The loop of
    the algorithm is an ``aggregate`` whose steps after the last jump change nothing; each
    step but the last moves at least one shard on, so ``shards`` steps always suffice."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    number = lambda x: F.lit(str(x)).cast("decimal(38,0)")
    unsigned = F.coalesce(key, F.lit(0)).cast("decimal(20,0)")
    unsigned = F.when(unsigned < 0, unsigned + number(_WRAP)).otherwise(unsigned).cast("decimal(20,0)")
    begin = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), unsigned.alias("k"))

    def step(acc: Column, _: Column) -> Column:
        k = ((acc["k"].cast("decimal(20,0)") * F.lit(str(MULTIPLIER)).cast("decimal(19,0)") + number(1)) % number(_WRAP)).cast("decimal(20,0)")
        high = (k - k % number(1 << 33)) / number(1 << 33)      # a whole number: k >> 33
        j = F.floor((acc["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (high.cast("double") + 1)))
        moved = F.struct(acc["j"].alias("b"), j.alias("j"), k.alias("k"))
        return F.when(acc["j"] < shards, moved).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), begin, step)["b"].cast("int")


def key_number(key: Column) -> Column:
    """The first 64 bits of the MD5 digest of a key, as text, as an unsigned number; a null key counts as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 16), 16, 10).cast("decimal(20,0)")


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``,
    ``law`` = 'key', ``shard``, ``slot`` in the shard and ``grown_shard`` (with one more shard).

    Slots follow the key (null first), the text's CRC and the size; rows alike in all of them take any
    order. Null texts have no bytes; a null key is a key like any other (hashed as such); rows that
    repeat a key share its shard and get slots of their own; an empty table gives no rows. The texts
    are read once."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    hashed = key_number(F.col(key))
    rows = docs.select(F.col(key), (F.octet_length(data) + 8).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"), jump_hash(hashed, shards).alias("shard"),
                       jump_hash(hashed, shards + 1).alias("grown_shard"))
    path = scratch_dir(docs.sparkSession, "shards")
    ranked = rank(sort_files(rows, ["shard", key, "text_crc32", "size"], path), "shard")
    return ranked.select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("rank").alias("slot"), "grown_shard")
