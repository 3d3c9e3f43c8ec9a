"""N-gram Jaccard join: a blocked sparse matrix product of the document by n-gram incidence matrix.

Two documents link when 100 * |A & B| >= percent * |A | B| for their sets of word n-grams. The
product is exact, but only blocks that can hold a link are multiplied:

1. Documents with equal n-gram sets form a class; one representative each goes on. A group of
   thousands of copies costs one row from here.
2. Size-derived bounds: a link needs an overlap of at least ceil(percent/100 * n) of a set of n, so
   two linked sets share one of the n - ceil(percent/100 * n) + 1 n-grams that come first in any
   common order; in the smaller of the two it is even among the first n - ceil(2 * percent / (100 + percent) * n) + 1
   (its place is then early). Rare n-grams come first (by a corpus-wide count sketch), so passages that many
   documents share hardly ever are among them.
3. Documents that share such an n-gram, in the order of their set sizes, are a block as long as no
   gap to the last early place exceeds the bound on linked sizes; a row without an early one before it is
   dropped. Up to here only (n-gram, size, id, early) rows are shuffled, no text. An n-gram that very many documents have
   (the sketch tells which may) isn't gathered in one task: its rows are blocked by ranges of set
   sizes, by aggregation and a salted join.
4. The blocks go to :func:`staylens.llm.shingle_links.block_labels`, which fetches the candidates' texts and
   multiplies tiles of about ``TILE`` documents over column blocks of n-grams.
5. Components by label propagation with pointer jumping.

The result is exact up to equal 64-bit hashes of different n-grams.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import runs_in_tasks, staged
from staylens.llm.shingle_links import TILE, Words, block_labels, linked, overlaps, salted_join, shingles, tiles_of

__all__ = ["jaccard_components", "keep_one_each", "linked", "overlaps"]

runs_in_tasks(__name__)

N = 4
PERCENT = 85
#: Counters of the sketch that orders n-grams by rarity: one for 8 bytes of text, within these powers of two. Any
#: number is exact; what is broadcast (2 bytes each) stays within the larger bound.
SKETCH_BITS = (16, 23)
#: Counters in a row of the sketch's table.
_CHUNK = 1 << 16
#: Rows from which on those of one n-gram are spread over tasks. A task's counters stop at 255; one that did counts as this.
HOT = 20_000


def _sketch_slot(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _describe(n: int, bits: int):
    """A row for each document: id, 128-bit hash of its set, set size; and rows with n_shingles -1
    for a task's part of the sketch: the number of a chunk of counters and the counters as bytes,
    which stop at 255."""

    def run(batches):
        known, sketch = Words(), np.zeros(1 << bits, np.int32)
        for b in batches:
            out, held = [], []
            for text in b.column(1).to_pylist():
                s = shingles(text, known, n)
                held.append(s)
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                hash_parts = (int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True))
                out.append((*hash_parts, len(s)))
            if held:
                slot, times = np.unique(_sketch_slot(np.concatenate(held), bits), return_counts=True)
                sketch[slot] += times.astype(np.int32)
            hi, lo, size = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(hi, pa.int64()),
                    pa.array(lo, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.nulls(len(out), pa.binary()),
                ],
                names=_SET_NAMES,
            )
        parts = np.minimum(sketch, 255).astype(np.uint8).reshape(-1, min(_CHUNK, 1 << bits))
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(used), pa.int64()),
                pa.array(used),
                pa.nulls(len(used), pa.int64()),
                pa.array(np.full(len(used), -1)),
                pa.array([parts[c].tobytes() for c in used], pa.binary()),
            ],
            names=_SET_NAMES,
        )

    return run


_SET = ["hi", "lo", "n_shingles"]
_SET_NAMES = ["id", "hi", "lo", "n_shingles", "counts"]
_SET_SCHEMA = "id long, hi long, lo long, n_shingles long, counts binary"


def _add_up(batches):
    """Sums of the chunks of a partition, up to 65,535."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            wide = np.frombuffer(counts, np.uint8).astype(np.int32)
            wide[wide == 255] = HOT
            total[chunk] = np.minimum(total[chunk] + wide, 65_535) if chunk in total else wide
    yield pa.RecordBatch.from_arrays(
        [pa.array(total, pa.int64()), pa.array([v.astype(np.uint16).tobytes() for v in total.values()], pa.binary())],
        names=["chunk", "counts"],
    )


def _sketch(parts: DataFrame, bits: int) -> np.ndarray:
    """The counters of all tasks. Each of a chunk's partitions is summed on its own as a stream."""
    summed = (
        parts.select(F.col("hi").alias("chunk"), "counts")
        .repartition("chunk")
        .mapInArrow(_add_up, "chunk long, counts binary")
        .toArrow()
    )
    out = np.zeros((max(1, (1 << bits) // _CHUNK), min(_CHUNK, 1 << bits)), np.uint16)
    for chunk, counts in zip(summed.column(0).to_pylist(), summed.column(1).to_pylist(), strict=True):
        out[chunk] = np.frombuffer(counts, np.uint16)
    return out.ravel()


def early_places(size: int, percent: int) -> int:
    """How many n-grams of a set may be the first that it shares with a linked set of its size or more."""
    return size - -(-2 * percent * size // (100 + percent)) + 1


def prefix(codes: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The n-grams of a set of which two linked sets must share one: the first in the common order
    (count in the sketch, hash)."""
    length = len(codes) - math.ceil(percent * len(codes) / 100) + 1
    order = np.lexsort((codes, counts[_sketch_slot(codes, int(len(counts)).bit_length() - 1)]))
    return codes[order[:length]]


def _prefixes(n: int, percent: int, counts: np.ndarray):
    """(token, size, id, early, hot): the prefix of each set, whether the token has an early place in it, and
    whether many documents may have the token."""
    bits = int(len(counts)).bit_length() - 1

    def run(batches):
        known = Words()
        for b in batches:
            sets = [shingles(t, known, n) for t in b.column(1).to_pylist()]
            found = [prefix(s, counts, percent) for s in sets]
            lengths = np.array([len(x) for x in found], np.int64)
            ids = np.repeat(b.column(0).to_numpy(zero_copy_only=False), lengths)
            sizes = np.repeat(np.array([len(x) for x in sets], np.int64), lengths)
            early = [np.arange(len(p)) < early_places(len(s), percent) for p, s in zip(found, sets, strict=True)]
            tokens = np.concatenate(found) if found else np.zeros(0, np.int64)
            early = np.concatenate(early) if early else np.zeros(0, bool)
            hot = counts[_sketch_slot(tokens, bits)] >= HOT
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(sizes.astype(np.int32)), pa.array(ids, pa.int64()), pa.array(early), pa.array(hot)],
                names=["token", "size", "id", "early", "hot"],
            )

    return run


def _blocks(percent: int):
    """(hub, id) from rows sorted by token, size and id, as a stream. A row with an early place begins a block if
    no such row of its token comes before it or the last one is too small for any link with it; its block's first row is
    the hub. Other rows belong to the block before them or to none. Hot rows pass as they are, with a NULL hub."""

    def run(batches):
        last = None  # token, size and hub of the last early row, and whether the hub has been told
        for b in batches:
            if not b.num_rows:
                continue
            hot = b.column(4).to_numpy(zero_copy_only=False) if b.num_columns > 4 else np.zeros(b.num_rows, bool)
            if hot.any():
                yield _candidates(None, *(b.filter(pa.array(hot)).column(i) for i in (2, 0, 1, 3)))
                b = b.filter(pa.array(~hot))
                if not b.num_rows:
                    continue
            token, size, ids = (b.column(i).to_numpy() for i in range(3))
            early = b.column(3).to_numpy(zero_copy_only=False) if b.num_columns > 3 else np.ones(len(ids), bool)
            at = np.arange(len(ids))
            before = np.concatenate([[-1], np.maximum.accumulate(np.where(early, at, -1))[:-1]])
            known = (before >= 0) | (last is not None)
            before_token = np.where(before >= 0, token[before], last[0] if last else 0)
            before_size = np.where(before >= 0, size[before], last[1] if last else 0).astype(np.int64)
            member = known & (before_token == token) & (100 * before_size >= percent * size.astype(np.int64))
            begins = early & ~member
            start = np.maximum.accumulate(np.where(begins, at, -1))
            hub = np.where(start >= 0, ids[start], last[2] if last else 0)
            # a hub is told with its first other member
            _, first = np.unique(start[member], return_index=True)
            first = np.flatnonzero(member)[first]
            if last and last[3]:
                first = first[start[first] >= 0]
            yield _candidates(
                pa.array(np.concatenate([hub[member], hub[first]])), pa.array(np.concatenate([ids[member], hub[first]]))
            )
            z = np.flatnonzero(early)
            if len(z):
                told = bool((member & (start == start[z[-1]])).any()) or bool(start[z[-1]] < 0 and last and last[3])
                last = (token[z[-1]], size[z[-1]], hub[z[-1]], told)
            elif last and member.any():
                last = (*last[:3], True)

    return run


_CANDIDATES = "hub long, id long, token long, size int, early boolean"


def _candidates(hub, ids, token=None, size=None, early=None) -> pa.RecordBatch:
    """Rows of ``_CANDIDATES``: members of blocks, or hot rows."""
    n = len(ids)
    columns = [hub, ids, token, size, early]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, t) if c is None else c for c, t in zip(columns, types, strict=True)],
        names=["hub", "id", "token", "size", "early"],
    )


def _hot_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """(hub, id) from hot rows: a block for each token and range of set sizes. Linked sets lie in one
    range or in neighbouring ones, so rows with an early place also join the next range."""
    step = math.log(100 / percent) * 1.001
    level = F.floor(F.ln(F.col("size").cast("double")) / step)
    both = F.when(F.col("early"), F.array(level, level + 1)).otherwise(F.array(level))
    ranged = rows.select("id", "token", F.explode(both).alias("level")).select("id", F.xxhash64("token", "level").alias("block"))
    hubs = ranged.groupBy("block").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
    hubs = hubs.where("hub < last").select("block", "hub")
    return salted_join(ranged, hubs, ["block"], "id").select("hub", "id")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every id in ``edges`` (a, b): the smallest id that it reaches. Each round
    takes the smallest label of the neighbours, then the label of that label."""
    pairs = edges.where("a <> b").select("a", "b").distinct()
    both = staged(pairs.union(pairs.select("b", "a")).toDF("id", "other"), "edges")
    labels = staged(both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.toDF("other", "seen"), "other").groupBy("id").agg(F.min("seen").alias("seen"))
        )
        nearer = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "seen").alias("to"))
        jumped = nearer.join(labels.toDF("to", "next"), "to", "left").select(
            "id", "old", F.least("to", F.coalesce("next", "to")).alias("label")
        )
        after = staged(jumped, "labels")
        changed = after.where("old <> label").limit(1).count()
        labels = after.select("id", "label")
        if not changed:
            return labels


def jaccard_components(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    n: int = N,
    percent: int = PERCENT,
    sketch_bits: int | None = None,
    tile: int = TILE,
) -> DataFrame:
    """(key, n_shingles, component_id) for each row of ``docs``.

    ``component_id`` is the smallest key reachable by links, the row's own included. A row without
    words (NULL, empty or blank text) has no n-grams and is linked with nothing. Rows that repeat a
    key are one node and share a component. A row with a NULL key is linked with nothing and has a
    NULL component."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    if sketch_bits is None:
        size = source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 1
        sketch_bits = min(max((size // 8).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    all_rows = staged(source.mapInArrow(_describe(n, sketch_bits), _SET_SCHEMA), "sets")
    described = all_rows.where("n_shingles >= 0").drop("counts")
    counts = _sketch(all_rows.where("n_shingles < 0"), sketch_bits)

    with_words = described.where("n_shingles > 0 and id is not null")
    classes = staged(with_words.groupBy(*_SET).agg(F.min("id").alias("rep")), "classes")

    # candidate blocks: hub and members. A token's rows are 20 bytes each and pass as a stream
    tokens = source.where("id is not null").mapInArrow(
        _prefixes(n, percent, counts), "token long, size int, id long, early boolean, hot boolean"
    )
    part = F.when(F.col("hot"), F.xxhash64("token", "id")).otherwise(F.col("token"))
    in_order = tokens.repartition(part).sortWithinPartitions("token", "size", "id")
    found = staged(in_order.mapInArrow(_blocks(percent), _CANDIDATES), "candidates")
    cold = found.where("hub is not null").select("hub", "id")
    hot = _hot_blocks(found.where("hub is null"), percent)
    members = cold.union(hot).distinct()
    reps = classes.groupBy(F.col("rep").alias("id")).agg(F.sum("n_shingles").alias("size"))
    members = staged(members.join(reps, "id"), "members")
    block = tiles_of(members, tile)

    # rows that repeat a key make one node of their classes
    in_set = F.struct("hi", "lo", "n_shingles")
    several = with_words.groupBy("id").agg(F.min(in_set).alias("a"), F.max(in_set).alias("z")).where("a < z")
    in_class = with_words.join(several.select("id"), "id", "left_semi").join(classes, _SET)
    first = in_class.groupBy("id").agg(F.min("rep").alias("a"))
    same_key = in_class.join(first, "id").select("a", F.col("rep").alias("b")).where("a <> b")
    label = block_labels(block, source, components, n=n, percent=percent, tile=tile, more_links=same_key)

    labelled = classes.join(label.toDF("rep", "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    of_class = salted_join(with_words, labelled, _SET, "id").select("id", "n_shingles", F.col("label").alias("component_id"))
    alone = described.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return of_class.union(alone).withColumnRenamed("id", key)


def keep_one_each(docs: DataFrame, *, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that stay when each group of linked documents keeps the one with the
    smallest key. Rows that repeat a key keep one (the smallest text); rows with a NULL key stay."""
    found = jaccard_components(docs, text=text, key=key, **settings)
    stay = found.where(F.col(key) == F.col("component_id")).select(key).distinct()
    without_key = docs.where(F.col(key).isNull())
    once = docs.join(stay.hint("merge"), key, "left_semi").select(*docs.columns)
    repeated = docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = staged(repeated.where("n > 1").select(key), "repeated")
    if not repeated.limit(1).count():
        return once.union(without_key)
    row = F.struct(F.coalesce(F.col(text), F.lit("")).alias("first"), F.struct(*docs.columns).alias("row"))
    several = once.join(repeated, key, "left_semi")
    several = several.groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("r")).select("r.row.*")
    return once.join(repeated, key, "left_anti").select(*docs.columns).union(several).union(without_key)
