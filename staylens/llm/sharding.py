"""Sharding by jump consistent hashing.

A 64-bit key drives a linear congruential generator; its numbers say at which shard counts the key
would have jumped to the newest shard, and the last jump below the wanted count is the shard. There
is no ring table, and one more shard takes its share of rows from all others and moves nothing else.

Rows get a slot in their shard, gapless from 0, without sorting a shard in one task: rows are
counted by (shard, bucket) where the bucket is the start of the key's md5, and numbered within.

Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import text_or_empty

# The generator's fixed values.
_STEP = "2862933555777941757"
_WORD = "18446744073709551616"
#: Hex digits of the md5 that make a bucket: 4096 buckets in a shard.
BUCKET_DIGITS = 3
#: A key jumps about ln(shards) times; no key in 10**60 jumps more often than this.
MAX_JUMPS = 200


def stable_key(key: Column) -> Column:
    """A number below 2**60 that depends on the key's text alone; NULL counts as the empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a non-negative key below 2**64."""
    if shards < 1:
        raise ValueError("at least one shard")
    whole = "decimal(38,0)"

    def number(value: str) -> Column:
        return F.lit(value).cast("decimal(20,0)")

    def jump(state: Column, _: Column) -> Column:
        seed = ((state["seed"].cast("decimal(20,0)") * number(_STEP) + 1) % number(_WORD)).cast(whole)
        high = (seed - seed % number(str(1 << 33))).cast("double") / F.lit(float(1 << 33))
        to = F.floor((state["to"] + 1).cast("double") * (F.lit(float(1 << 31)) / (high + 1.0)))
        moved = F.struct(seed.alias("seed"), state["to"].alias("at"), to.cast("long").alias("to"))
        return F.when(state["to"] < shards, moved).otherwise(state)

    start = F.struct(
        key.cast(whole).alias("seed"), F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("to")
    )
    steps = F.sequence(F.lit(1), F.lit(min(shards, MAX_JUMPS)))
    return F.aggregate(
        steps,
        start,
        jump,
        lambda s: F.when(s["to"] >= shards, s["at"]).otherwise(F.raise_error(F.lit("too many jumps")).cast("long")),
    ).cast("int")


def with_shard(docs: DataFrame, shards: int, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) for each row of ``docs``.

    size: UTF-8 bytes of the text plus 1; a NULL text has none and the crc32 of nothing. shard is
    decided by the key and ``shards``; grown_shard by the key and ``shards`` + 1. Rows that repeat a
    key share its shard and have slots of their own, in the order of crc32 and size."""
    t = text_or_empty(text).cast("binary")
    stable = stable_key(F.col(key))
    rows = docs.select(
        F.col(key).alias("id"),
        (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"),
        F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, BUCKET_DIGITS).alias("bucket"),
        jump_hash(stable, shards).alias("shard"),
        jump_hash(stable, shards + 1).alias("grown_shard"),
    )
    group = Window.partitionBy("shard", "bucket")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        rows.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    within = F.row_number().over(group.orderBy("id", "text_crc32", "size")) - 1
    return (
        rows.withColumn("within", within)
        .join(firsts, ["shard", "bucket"])
        .select(
            F.col("id").alias(key),
            "size",
            "text_crc32",
            "shard",
            (F.col("first") + F.col("within")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
