"""Ranked lexical search: accumulator-limited term-at-a-time evaluation with exact integer scores.

A document's score for an item sums ``w * ((1e9 * tf) div (1000 * tf + 8 * m))`` over the item's terms,
repeats included; ``w`` grows with a term's rarity, ``m`` with the document's length.

1. Items are taken in blocks of at most ``BLOCK_TERMS`` distinct terms. A block goes to all tasks, so that what
   is sent has a bound; a larger item set takes more passes.
2. One pass over the documents keeps, for each, its length and its counts of the block's terms (a forward
   index, written to the shared folder), and sums documents, lengths and document frequencies.
3. Each task inverts ``DOC_BLOCK`` documents at a time and evaluates the items over that block, term at a
   time, rarest first. A document gets an accumulator with its first term; as soon as the bounds of the
   terms that are left (the largest contribution of each in the block) sum to less than the kth partial
   score, no more accumulators are made and the terms that are left only update those that exist. The kth
   score of the blocks before counts too, so later blocks stop sooner.
4. The k best of the tasks are ranked. A document outside its own task's k best can't be among them.

Only the k best rows of each task and the counts are shuffled; texts never are. The result is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import runs_in_tasks, staged

runs_in_tasks(__name__)

K = 10
#: Distinct terms of the items that are evaluated together.
BLOCK_TERMS = 1 << 16
#: Documents, and term counts, of a block that a task inverts at a time.
DOC_BLOCK = 1 << 15
DOC_BLOCK_COUNTS = 1 << 23

#: Separators become spaces and A-Z become a-z; letters, digits and all bytes from 0x80 on stay.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []


def _counts(vocabulary: dict[bytes, int]):
    """A row for each document: key, length, and its counts of the vocabulary's terms (by ascending number).
    And one row for a task, with length -1: document frequencies, then documents and summed lengths."""
    size = len(vocabulary)

    def run(batches):
        df, n_docs, all_terms = np.zeros(size, np.int64), 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            found, lengths = [], np.zeros(b.num_rows, np.int64)
            for i, text in enumerate(b.column(1).to_pylist()):
                words = terms(text)
                lengths[i] = len(words)
                found.append(np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words)))
            n_docs += int((lengths > 0).sum())
            all_terms += int(lengths.sum())
            doc = np.repeat(np.arange(b.num_rows), [len(x) for x in found])
            term = np.concatenate(found)
            known = term >= 0
            pair, tf = np.unique(doc[known] * size + term[known], return_counts=True)
            doc, term = pair // max(size, 1), pair % max(size, 1)
            df += np.bincount(term, minlength=size)
            ends = pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64))),
                ],
                names=["key", "n", "terms", "counts"],
            )
        seen = np.flatnonzero(df)
        numbers = np.concatenate([seen, [size, size + 1]]).astype(np.int32)
        values = np.concatenate([df[seen], [n_docs, all_terms]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(1, pa.int64()),
                pa.array([-1], pa.int64()),
                pa.array([numbers], pa.list_(pa.int32())),
                pa.array([values], pa.list_(pa.int64())),
            ],
            names=["key", "n", "terms", "counts"],
        )

    return run


_COUNTS = "key long, n long, terms array<int>, counts array<long>"


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """Inverted lists of a block of documents: for each term the documents and their contributions."""

    def __init__(self, lengths, doc, term, tf, weights, n_docs: int, all_terms: int):
        m = 100 - 75 + (75 * lengths * n_docs) // max(all_terms, 1)
        value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        order = np.argsort(term, kind="stable")
        self.size = len(lengths)
        self.term, self.doc, self.value = term[order], doc[order], value[order]
        names, first = np.unique(self.term, return_index=True)
        self.start = dict(zip(names.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True), strict=True))
        self.best = dict(zip(names.tolist(), np.maximum.reduceat(self.value, first).tolist() if len(first) else [], strict=True))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, z = self.start[term]
        return self.doc[a:z], self.value[a:z]


def evaluate(item: list[tuple[int, int]], postings: Postings, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents that may be among the k best of the block, with their exact scores, and how many terms made
    accumulators. ``item``: (term, repeats), rarest first. ``least``: a score that k documents outside the
    block reach, or 0."""
    here = [(t, q) for t, q in item if t in postings.start]
    left = np.cumsum([0] + [q * postings.best[t] for t, q in reversed(here)])[::-1].tolist()
    score = np.zeros(postings.size, np.int64)
    has = np.zeros(postings.size, bool)
    open_terms = 0
    for i, (t, q) in enumerate(here):
        # ties are decided by the key, so a document that can still equal the kth score counts
        if left[i] < least:
            break
        doc, value = postings.of(t)
        score[doc] += q * value
        has[doc] = True
        open_terms += 1
        made = score[has] if left[i + 1] <= score.max() else ()
        if len(made) >= k:
            least = max(least, int(np.partition(made, len(made) - k)[len(made) - k]))
    for t, q in here[open_terms:]:
        doc, value = postings.of(t)
        mine = has[doc]
        score[doc[mine]] += q * value[mine]
    docs = np.flatnonzero(has)
    docs = docs[(score[docs] > 0) & (score[docs] >= least)]
    return docs, score[docs], open_terms


def _doc_blocks(batches) -> Iterator[tuple]:
    """Documents with any of the terms, in blocks: keys, lengths, and (document, term, count) columns."""
    held, docs, counts = [], 0, 0
    for b in batches:
        b = b.filter(pa.compute.greater(pa.compute.list_value_length(b.column("terms")), 0))
        held.append(b)
        docs, counts = docs + b.num_rows, counts + len(b.column("terms").flatten())
        if docs >= DOC_BLOCK or counts >= DOC_BLOCK_COUNTS:
            yield _columns(held)
            held, docs, counts = [], 0, 0
    if docs:
        yield _columns(held)


def _columns(batches: list) -> tuple:
    t = pa.Table.from_batches(batches).combine_chunks()
    found = t.column("terms").combine_chunks()
    doc = np.repeat(np.arange(t.num_rows), pa.compute.list_value_length(found).to_numpy(zero_copy_only=False))
    term = found.flatten().to_numpy().astype(np.int64)
    tf = t.column("counts").combine_chunks().flatten().to_numpy()
    return t.column("key").to_pylist(), t.column("n").to_numpy(), doc, term, tf


def _search(items: list[list[tuple[int, int]]], weights: np.ndarray, n_docs: int, all_terms: int, k: int):
    """(item, key, score): the k best of a task's documents for each item (by its place in the block)."""

    def run(batches):
        # heaps with the worst of the k best first; a smaller key is better and NULL is worst
        best: list[list] = [[] for _ in items]
        for keys, lengths, doc, term, tf in _doc_blocks(batches):
            postings = Postings(lengths, doc, term, tf, weights, n_docs, all_terms)
            for item, heap in zip(items, best, strict=True):
                docs, score, _ = evaluate(item, postings, k, heap[0][0] if len(heap) == k else 0)
                for d, s in zip(docs.tolist(), score.tolist(), strict=True):
                    key = keys[d]
                    row = (s, key is not None, -(key or 0))
                    if len(heap) < k:
                        heapq.heappush(heap, row)
                    elif row > heap[0]:
                        heapq.heapreplace(heap, row)
        out = [(i, -key if known else None, s) for i, heap in enumerate(best) for s, known, key in heap]
        item, key, score = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(key, pa.int64()), pa.array(score, pa.int64())],
            names=["item", "key", "score"],
        )

    return run


def _item_blocks(items: DataFrame, block_terms: int) -> Iterator[tuple[list, list, dict]]:
    """Ids and terms of the items in blocks of at most ``block_terms`` distinct terms (or one item), with
    the numbers of the terms. The items pass as a stream; one block is held at a time."""
    ids, texts, vocabulary = [], [], {}
    for item, text in items.toLocalIterator():
        words = terms(text)
        if ids and len(vocabulary.keys() | set(words)) > block_terms:
            yield ids, texts, vocabulary
            ids, texts, vocabulary = [], [], {}
        for w in words:
            vocabulary.setdefault(w, len(vocabulary))
        ids.append(item)
        texts.append(words)
    if ids:
        yield ids, texts, vocabulary


def _block_results(source: DataFrame, ids: list, texts: list, vocabulary: dict, k: int) -> DataFrame:
    spark = source.sparkSession
    rows = staged(source.mapInArrow(_counts(vocabulary), _COUNTS), "counts")
    stats = rows.where("n < 0").select(F.arrays_zip("terms", "counts").alias("z")).select(F.inline("z"))
    total = dict(stats.groupBy("terms").agg(F.sum("counts").alias("counts")).toArrow().to_pandas().itertuples(index=False))
    size = len(vocabulary)
    n_docs, all_terms = int(total.get(size, 0)), int(total.get(size + 1, 0))
    df = [int(total.get(t, 0)) for t in range(size)]
    weights = np.array([weight(n_docs, f) if f else 0 for f in df], np.int64)
    items = []
    for words in texts:
        repeats: dict[int, int] = {}
        for w in words:
            repeats[vocabulary[w]] = repeats.get(vocabulary[w], 0) + 1
        items.append(sorted(((t, q) for t, q in repeats.items() if df[t]), key=lambda x: (df[x[0]], x[0])))
    found = rows.where("n >= 0").mapInArrow(
        _search(items, weights, n_docs, all_terms, k), "item int, key long, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    return best.join(names, "item").select("item_id", "rank", "key", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = K,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item, rank, key, score): the ``k`` documents with the highest scores above 0 for each row of ``items``.

    Equal scores go by ascending key, a NULL key last. Texts without terms (NULL, empty or only
    separators) match nothing and count neither as documents nor in lengths. Each row of either table stands for itself:
    rows that repeat a key are documents of their own, rows that repeat an item id are ranked each on their own.
    Further columns aren't read. No items, or no documents, give no rows."""
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    asked = items.select(F.col(item).cast("long"), F.col(item_text))
    out = None
    for block in _item_blocks(asked, block_terms):
        found = _block_results(source, *block, k)
        out = found if out is None else out.union(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "item_id long, rank int, key long, score long")
    return out.select(F.col("item_id").alias(item), "rank", F.col("key").alias(key), "score")
