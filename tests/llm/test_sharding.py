import hashlib
import zlib
from collections import Counter

from llm_rows import no_docs, odd_docs
from pyspark.sql import functions as F

from staylens.llm import sharding as S


def jump(key, shards):
    """The published loop."""
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        to = int((at + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return at


def key_of(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)


def test_jump_hash_against_the_loop(spark):
    df = spark.range(300).select("id", S.stable_key(F.col("id")).alias("k"))
    counts = [1, 2, 8, 9, 100, 1000]
    rows = df.select("id", *[S.jump_hash(F.col("k"), n).alias(f"s{n}") for n in counts]).collect()
    for r in rows:
        for n in counts:
            assert r[f"s{n}"] == jump(key_of(r["id"]), n)


def test_rows_only_move_to_the_new_shard(spark):
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = S.with_shard(docs, 8).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) < 1.15 * 1000
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {8} and 0.09 < len(moved) / len(rows) < 0.13
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    rows = S.with_shard(docs, 8).collect()
    texts = sorted(len((r["text"] or "").encode()) + 1 for r in docs.collect())
    assert sorted(r["size"] for r in rows) == texts
    assert {r["text_crc32"] for r in rows} == {zlib.crc32((r["text"] or "").encode()) for r in docs.collect()}
    assert all(r["shard"] == jump(key_of(r["doc_id"]), 8) for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert S.with_shard(no_docs(spark), 8).count() == 0
