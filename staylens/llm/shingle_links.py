"""Links between texts by their sets of word n-grams, within given blocks of candidates.

What a similarity join needs after it has found its candidates: :func:`shingles` (the set of a text),
:func:`linked` (exact pairs of some sets) and :func:`block_labels`, which takes rows (hub, id), the blocks in which
a link may lie, and returns the components of all links within them.

A text moves only when its id is in a block: candidates' ids are gathered in a Bloom filter of at most
``FILTER_BITS`` bits, which the scan of the texts consults before anything is shuffled. (More ids only let
more texts pass; the join that follows is exact.) A block is cut into tiles of about ``TILE`` documents, each
with the block's hub, and a tile's pairs are compared by blocked products of the incidence matrix. A block
whose tiles have all come into one component is done. In the others, documents outside the block's
largest component are compared with all its tiles; two documents of one component never are. So no link is lost, and
a group of copies costs about its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import bytes_words, runs_in_tasks, sorted_distinct, staged

runs_in_tasks(__name__)

TILE = 512
#: N-grams of a tile's documents, about; longer documents make smaller tiles.
TILE_NGRAMS = 4_000_000
#: Columns (n-grams) of an incidence block that are multiplied at a time.
COLUMN_BLOCK = 8192
#: Bits of the filter on candidate ids, at most.
FILTER_BITS = 1 << 26
#: Parts of a key whose rows may be many; the other side of the join is repeated as often.
SALTS = 16
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)


class Words(dict):
    """64-bit hash of a word, remembered for the words of a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def shingles(text: str | None, known: dict, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text (A-Z lower-cased); of the whole sequence
    if it has fewer than n words; none without words."""
    w = bytes_words(text)
    if not w:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(known.__getitem__, map(bytes.lower, w)), np.uint64, len(w))
    k = min(n, len(w))
    code = np.full(len(w) - k + 1, len(w) if len(w) < n else 0, np.uint64)
    for i in range(k):
        code = (code + h[i : len(w) - k + 1 + i]) * _MIX[i % 4]
        code ^= code >> np.uint64(29)
    code *= _MIX[1]
    code ^= code >> np.uint64(32)
    return sorted_distinct(code).view(np.int64)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Pairwise overlap counts: incidence times its transpose, accumulated over column blocks.
    N-grams of a single set add nothing and are left out."""
    m = len(sets)
    total = np.zeros((m, m), np.float32)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    shared = count[col] > 1
    rows, col = rows[shared], place[col[shared]]
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    for first in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMN_BLOCK):
        a, z = np.searchsorted(col, (first, first + COLUMN_BLOCK))
        block = np.zeros((m, int(col[z - 1]) - first + 1), np.float32)
        block[rows[a:z], col[a:z] - first] = 1
        total += block @ block.T
    return total.astype(np.int64)


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of the pairs at or above the threshold."""
    size = np.array([len(s) for s in sets], np.int64)
    least = np.minimum.outer(size, size)
    both = np.add.outer(size, size)
    possible = 100 * least >= percent * (both - least)
    np.fill_diagonal(possible, False)
    if not possible.any():
        return possible
    o = overlaps(sets)
    return possible & (100 * o >= percent * (both - o))


def _forest(ids: list[int], group: np.ndarray, link: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep the components of ``link``; documents of one ``group`` count as joined."""
    left = np.ones(len(ids), bool)
    found = []
    while left.any():
        start = int(np.flatnonzero(left)[0])
        left[start] = False
        reach = [start]
        while reach:
            u = reach.pop()
            for v in np.flatnonzero(left & link[u]):
                found.append((ids[u], ids[v]))
                left[v] = False
                reach.append(int(v))
            for v in np.flatnonzero(left & (group == group[u])):
                left[v] = False
                reach.append(int(v))
    return found


def _links(n: int, percent: int):
    """Spanning forest of the links between the texts of a tile. With a column ``label``, documents
    of one label count as joined."""

    def run(table: pa.Table) -> pa.Table:
        known = Words()
        ids = table.column("id").to_pylist()
        sets = [shingles(t, known, n) for t in table.column("text").to_pylist()]
        link = linked(sets, percent)
        group = np.arange(len(ids))
        if "label" in table.column_names:
            _, group = np.unique(np.array(table.column("label").to_pylist(), np.int64), return_inverse=True)
            link &= group[:, None] != group[None, :]
        found = _forest(ids, group, link)
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


# -- texts of candidates ----------------------------------------------------------------------------


def _slots(ids: np.ndarray, bits: int) -> np.ndarray:
    """Two bits of the filter for each id."""
    h = ids.astype(np.int64).view(np.uint64) * _MIX[0]
    h ^= h >> np.uint64(32)
    h *= _MIX[1]
    mask = np.uint64(bits - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) & mask])


def _filter_words(bits: int):
    """(word, mask) of the filter for a batch of ids."""

    def run(batches):
        for b in batches:
            slot = np.unique(_slots(b.column(0).to_numpy(), bits))
            mask = (np.uint64(1) << (slot & np.uint64(63))).view(np.int64)
            word = (slot >> np.uint64(6)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask)], names=["word", "mask"])

    return run


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of a column of ids, sized to their number and never above ``FILTER_BITS``; ids may repeat."""
    count = ids.count()
    bits = 1 << min(max(count * 16, 1 << 10).bit_length(), FILTER_BITS.bit_length() - 1)
    rows = ids.mapInArrow(_filter_words(bits), "word long, mask long")
    found = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return out


def texts_of(source: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (id, text) of ``source`` whose id may be among ``ids``: all that are, and a few more."""
    words = id_filter(ids)

    def run(batches):
        for b in batches:
            slot = _slots(b.column(0).to_numpy(zero_copy_only=False), len(words) << 6)
            bit = (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
            yield b.filter(pa.array(bit.all(axis=0)))

    return source.select("id", "text").where("id is not null").mapInArrow(run, "id long, text string")


# -- blocks -----------------------------------------------------------------------------------------


def salted_join(many: DataFrame, few: DataFrame, on: list[str], by: str) -> DataFrame:
    """``many`` joined with ``few`` (one row for each value of ``on``), where one key may have a large part of the
    rows: they are dealt by ``by`` over ``SALTS`` parts and the rows of ``few`` repeated."""
    salt = F.pmod(F.xxhash64(by), F.lit(SALTS)).alias("salt")
    copies = few.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return many.withColumn("salt", salt).join(copies.hint("merge"), [*on, "salt"]).drop("salt")


def tiles_of(members: DataFrame, tile: int) -> DataFrame:
    """(hub, tile, tiles, id) from (hub, id, size): each block dealt over tiles by id, with the hub in all."""
    by_count = F.ceil((F.count(F.lit(1)) - 1) / (tile - 1))
    by_size = F.ceil(F.sum("size") / TILE_NGRAMS)
    sizes = members.groupBy("hub").agg(
        F.count(F.lit(1)).alias("m"), F.greatest(by_count, by_size).cast("int").alias("tiles")
    )
    sizes = sizes.where("m > 1").select("hub", "tiles")
    spread = salted_join(members.where("id <> hub").select("hub", "id"), sizes, ["hub"], "id").select(
        "hub", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("tile"), "tiles", "id"
    )
    hub_rows = sizes.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), "tiles", F.col("hub").alias("id")
    )
    return staged(spread.union(hub_rows), "blocks")


def block_labels(
    block: DataFrame,
    source: DataFrame,
    components: Callable[[DataFrame], DataFrame],
    *,
    n: int,
    percent: int,
    tile: int,
    more_links: DataFrame,
) -> DataFrame:
    """(id, label) for the ids with links: components over the links within the blocks of
    :func:`tiles_of`, found on the texts of ``source`` (id, text), and over ``more_links`` (a, b)."""
    texts = texts_of(source, block.select("id"))
    tiles = block.select("hub", "tile", "id").join(texts.hint("merge"), "id")
    links = staged(tiles.groupBy("hub", "tile").applyInArrow(_links(n, percent), "a long, b long"), "links")
    links = links.union(more_links)
    label = components(links)

    # blocks of several tiles that are not in one component yet
    many = block.where("tiles > 1 and id <> hub").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    many = staged(many, "many")
    by_label = many.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("m"))
    largest = by_label.groupBy("hub").agg(
        F.max(F.struct(F.col("m"), F.col("label"))).alias("main"), F.sum("m").alias("all")
    )
    rest = largest.where("main.m < all").select(
        "hub",
        F.col("main.label").alias("main"),
        F.ceil((F.col("all") - F.col("main.m")) / tile).cast("int").alias("probes"),
    )
    rest = staged(rest, "open")
    if not rest.limit(1).count():
        return label
    opened = salted_join(many, rest, ["hub"], "id")
    every_probe = F.explode(F.sequence(F.lit(0), F.col("probes") - 1))
    every_tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    part = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.col("probes")).cast("int")
    members = opened.select("hub", "tile", every_probe.alias("probe"), "id", "label")
    outside = opened.where("label <> main").select("hub", every_tile.alias("tile"), part.alias("probe"), "id", "label")
    pairs = members.union(outside).distinct()
    texts = texts_of(source, opened.select("id"))
    found = pairs.join(texts.hint("merge"), "id").groupBy("hub", "tile", "probe")
    across = staged(found.applyInArrow(_links(n, percent), "a long, b long"), "across")
    return components(links.union(across))
