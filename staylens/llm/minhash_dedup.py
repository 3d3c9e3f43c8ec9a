"""MinHash near-duplicates: many universal hash minima, banding, signature verification, components.

Two documents link when 100 * |A & B| >= percent * |A | B| for their sets of word n-grams.

1. A document's signature has the minima of ``HASHES`` universal hashes a * x + b (mod 2^64) over its n-grams,
   32 bits of each. Documents with equal sets form a class; one representative each goes on, so a group of
   thousands of copies costs one row from here.
2. Banding: ``BANDS`` bands of ``ROWS`` minima each. Representatives that agree in a band are a block; its smallest
   id is the hub. Two sets with a likeness of 0.8 miss each other in all bands with a probability of 5e-8. A
   band's rows are aggregated to find the hub and joined back over salted keys, so a band that very many
   documents share isn't gathered in a task.
3. Signature verification: within a block, documents whose signature agrees with no other one's in at
   least ``least_agreement`` places are dropped before any text is read. That bound lies six standard deviations
   under the threshold.
4. Links are confirmed on the full sets of n-grams (:func:`staylens.llm.shingle_links.block_labels`), and joined by
   large-star and small-star (:mod:`staylens.llm.star_components`).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import runs_in_tasks, staged
from staylens.llm.shingle_links import TILE, Words, block_labels, salted_join, shingles, tiles_of
from staylens.llm.star_components import components

runs_in_tasks(__name__)

N = 4
PERCENT = 80
BANDS = 32
ROWS = 4
HASHES = BANDS * ROWS
SEED = 20240229
_rng = np.random.default_rng(SEED)
_A = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
#: N-grams hashed at a time, so that the products stay in the processor's cache.
_CHUNK = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


def signature(codes: np.ndarray) -> np.ndarray:
    """The minima of all hashes over the n-gram hashes of a set; all ones for an empty set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    x = codes.view(np.uint64)
    for first in range(0, len(x), _CHUNK):
        h = x[first : first + _CHUNK, None] * _A
        h += _B
        np.minimum(least, h.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row and band."""
    part = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), part.shape[:2]).copy()
    for i in range(ROWS):
        key = (key ^ part[:, :, i]) * _MIX
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def least_agreement(percent: int) -> int:
    """Agreeing minima under which two signatures aren't those of linked sets (six standard deviations)."""
    p = percent / 100
    return max(1, math.floor(HASHES * p - 6 * math.sqrt(HASHES * p * (1 - p))))


_SET = ["hi", "lo", "n_shingles"]
_SETS = "id long, hi long, lo long, n_shingles long, signature binary"


def _describe(n: int):
    """Id, 128-bit hash of the set, set size and signature of each document; no signature without words."""

    def run(batches):
        known = Words()
        for b in batches:
            hi, lo, size, sig = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingles(text, known, n)
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                hi.append(int.from_bytes(d[:8], "little", signed=True))
                lo.append(int.from_bytes(d[8:], "little", signed=True))
                size.append(len(s))
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (hi, lo, size)), pa.array(sig, pa.binary())],
                names=["id", *_SET, "signature"],
            )

    return run


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _bands(batches):
    """(band, id): a row for each band of a signature."""
    for b in batches:
        if b.num_rows:
            keys = band_keys(_signatures(b.column(1)))
            ids = np.repeat(b.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["band", "id"])


def agreeing(signatures: np.ndarray, least: int) -> np.ndarray:
    """Which rows agree with another one in at least ``least`` places."""
    out = np.zeros(len(signatures), bool)
    for i in range(len(signatures) - 1):
        other = (signatures[i + 1 :] == signatures[i]).sum(axis=1) >= least
        if other.any():
            out[i] = True
            out[i + 1 :] |= other
    return out


def _verified(least: int):
    """(hub, id) of a block's documents with an agreeing signature."""

    def run(table: pa.Table) -> pa.Table:
        keep = agreeing(_signatures(table.column("signature")), least)
        return table.select(["hub", "id"]).filter(pa.array(keep))

    return run


def minhash_components(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", n: int = N, percent: int = PERCENT, tile: int = TILE
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of ``docs``.

    ``component_id`` is the smallest key reachable by links, the row's own included; ``kept`` tells whether it is
    the row's own. A row without words (NULL, empty or blank text) has no n-grams and is linked with
    nothing. Rows that repeat a key are one node and share a component. A row with a NULL key is linked with
    nothing, has a NULL component and is kept."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = staged(source.mapInArrow(_describe(n), _SETS), "signatures")
    with_words = described.where("n_shingles > 0 and id is not null")
    # equal sets have equal signatures
    classes = with_words.groupBy(*_SET).agg(F.min("id").alias("rep"), F.min("signature").alias("signature"))
    classes = staged(classes, "classes")

    bands = classes.select("rep", "signature").mapInArrow(_bands, "band long, id long")
    hubs = bands.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    members = salted_join(bands, hubs.select("band", "hub"), ["band"], "id").select("hub", "id").distinct()
    reps = classes.select(F.col("rep").alias("id"), F.col("n_shingles").alias("size"), "signature")
    sizes = reps.groupBy("id").agg(F.sum("size").alias("size"))
    members = staged(members.join(sizes, "id"), "members")
    block = tiles_of(members, tile)

    whole = block.where("tiles = 1").select("hub", "id").join(reps.hint("merge"), "id")
    verified = whole.groupBy("hub").applyInArrow(_verified(least_agreement(percent)), "hub long, id long")
    pairs = verified.select("hub", F.lit(0).alias("tile"), F.lit(1).alias("tiles"), "id").distinct()
    block = staged(pairs.union(block.where("tiles > 1").select("hub", "tile", "tiles", "id")), "verified")

    # rows that repeat a key make one node of their classes
    in_set = F.struct(*_SET)
    several = with_words.groupBy("id").agg(F.min(in_set).alias("a"), F.max(in_set).alias("z")).where("a < z")
    by_set = classes.select(*_SET, "rep")
    in_class = with_words.select("id", *_SET).join(several.select("id"), "id", "left_semi").join(by_set, _SET)
    first = in_class.groupBy("id").agg(F.min("rep").alias("a"))
    same_key = in_class.join(first, "id").select("a", F.col("rep").alias("b")).where("a <> b")
    label = block_labels(block, source, components, n=n, percent=percent, tile=tile, more_links=same_key)

    labelled = by_set.join(label.toDF("rep", "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    of_class = salted_join(with_words.select("id", *_SET), labelled, _SET, "id").select(
        "id", "n_shingles", F.col("label").alias("component_id")
    )
    alone = described.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    found = of_class.union(alone).withColumnRenamed("id", key)
    return found.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
