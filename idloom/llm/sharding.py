"""Jump consistent hashing: each row's shard follows from its integer key and
the number of shards alone, without a ring table; one more shard takes rows
only into itself (about 1 / (n + 1) of them).

Defined results: a null key counts as key 0; a null text as empty for its
checksum and as 0 bytes for its size. Rows with one key share a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import rank_in_groups

# Fixed value: the multiplier of the published generator, in 32-bit halves.
_MULTIPLIER = 2862933555777941757
_MH, _ML = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF
_LOW = 0xFFFFFFFF


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * multiplier + 1 modulo 2^64. Every partial product stays
    below 2^63, so ANSI arithmetic does not overflow."""
    p0 = lo.bitwiseAND(0xFFFF) * _ML
    p1 = F.shiftright(lo, 16) * _ML
    low = p0 + F.shiftleft(p1.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(low, 32) + F.shiftright(p1, 16)

    def by(x: Column, factor: int) -> Column:  # x * factor modulo 2^32
        return F.shiftleft((F.shiftright(x, 16) * factor).bitwiseAND(0xFFFF), 16) + x.bitwiseAND(0xFFFF) * factor

    return (by(hi, _ML) + by(lo, _MH) + carry).bitwiseAND(_LOW), low.bitwiseAND(_LOW)


def jump_hash(key: Column, shards: int) -> Column:
    """struct(shard, grown): the shard of an integer key among ``shards``, and
    among one more. Each step jumps ahead by at least one shard, so that
    ``shards + 1`` steps always suffice."""
    if shards < 1:
        raise ValueError("at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(_LOW).alias("lo"),
        F.lit(0).cast("long").alias("jump"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"),
    )

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        # key >> 33 is the upper half without its lowest bit; the jump starts from the last shard + 1
        ahead = F.floor((s["jump"] + 1).cast("double") * (F.lit(2.0**31) / (F.shiftright(hi, 1) + 1).cast("double")))
        return F.when(
            s["jump"] < shards + 1,
            F.struct(
                hi.alias("hi"), lo.alias("lo"), ahead.cast("long").alias("jump"),
                F.when(s["jump"] < shards, s["jump"]).otherwise(s["shard"]).alias("shard"), s["jump"].alias("grown"),
            ),
        ).otherwise(s)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(shards + 1)), start, step,
        lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")),
    )


def shard_documents(docs: DataFrame, shards: int = 16, buckets: int = 256) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of
    ``docs(doc_id, text)``. ``slot`` counts a shard's rows from 0; rows are
    ranked in ``buckets`` parts of each shard, so that no task holds a shard.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    base = docs.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        jump_hash(F.col("doc_id"), shards).alias("_jump"),
    ).select("doc_id", "size", "text_crc32", F.col("_jump.shard").alias("shard"), F.col("_jump.grown").alias("grown_shard"))
    # the size takes part, so that rows without an id (or with one id) spread too
    bucket = F.pmod(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(buckets)) + F.col("size") * 7, F.lit(buckets))
    order = [F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("text_crc32")]
    out = rank_in_groups(base, ["shard"], bucket, order, "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
