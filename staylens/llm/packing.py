"""Packing token sequences shortest-pack-first over the length histogram.

Texts are tokenized and cut into pieces of at most ``size`` ids. The histogram of piece lengths
(at most ``size`` rows) goes to the driver, where lengths are placed longest first, each into the
shortest pack that it fits: whole groups of equal packs at a time, so the work depends on ``size``
and not on the number of documents. The result is a short list of packing patterns with counts.
Pieces are joined back by rank: the i-th piece of a length takes the i-th place that the patterns
hold for it. Ranks come from counts by (length, bucket) and row numbers within, so a length that
many documents share is numbered in many tasks.
"""

from __future__ import annotations

import heapq
import json
import sys
import types
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import bytes_words, runs_in_tasks, staged

runs_in_tasks(__name__)

SIZE = 2048
END_ID = 1
RANK_BUCKETS = 256
#: Words, and parts of words, whose ids a Python worker remembers.
KNOWN_WORDS = 1_000_000


@dataclass(frozen=True)
class Places:
    """``count * copies`` places for pieces of ``length``: of ``count`` equal packs from number
    ``first`` on, each has ``copies`` side by side from ``offset``. ``rank`` is the first place's."""

    length: int
    rank: int
    first: int
    count: int
    copies: int
    offset: int


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[Places]:
    """Patterns for a histogram of lengths (1 to ``size``), as places by length and rank."""
    packs: list[tuple[int, int, int, tuple]] = []  # used, tie, packs, runs of (length, copies)
    tie = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and packs and packs[0][0] + length <= size:
            used, _, count, runs = heapq.heappop(packs)
            taken = min(left, count)
            if runs and runs[-1][0] == length:
                longer = (*runs[:-1], (length, runs[-1][1] + 1))
            else:
                longer = (*runs, (length, 1))
            heapq.heappush(packs, (used + length, tie := tie + 1, taken, longer))
            if taken < count:
                heapq.heappush(packs, (used, tie := tie + 1, count - taken, runs))
            left -= taken
        if left:
            each = size // length
            if left // each:
                heapq.heappush(packs, (each * length, tie := tie + 1, left // each, ((length, each),)))
            if left % each:
                heapq.heappush(packs, (left % each * length, tie := tie + 1, 1, ((length, left % each),)))
    ranks: dict[int, int] = {}
    first, out = 0, []
    for _, _, count, runs in sorted(packs):
        offset = 0
        for length, copies in runs:
            rank = ranks.get(length, 0)
            out.append(Places(length, rank, first, count, copies, offset))
            ranks[length] = rank + count * copies
            offset += length * copies
        first += count
    return out


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 characters
    for themselves, the other bytes in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in plain)}


class WordIds:
    """Ids of a text by the ids of its words.

    For tokenizers of the kind "BPE with word ends": normalised by NFC and lower case, split by a
    pattern that drops white space, byte-level letters. Nothing joins over white space, so a text's
    ids are its words' ids in order. Each new word is split by the tokenizer's own pattern, and each
    new part goes to its model once. Words with a special token go to the whole tokenizer."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        steps = described["pre_tokenizer"]["pretokenizers"]
        if steps[0]["type"] != "Split" or steps[1]["type"] != "ByteLevel":
            raise ValueError(f"{path}: not a word tokenizer with byte-level parts")
        self.parts = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.special = [t["content"] for t in described["added_tokens"]]
        self.letters = byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            letters = part.encode().decode("latin-1").translate(self.letters)
            found = array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
            self.known[part] = found
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if any(s in text for s in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        # str.lower() is the normalizer's result for ASCII
        text = text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
        return b"".join(map(self._part, self.parts(text)))

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Unsigned 32-bit ids."""
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        for word in set(words).difference(self.words):
            self.words[word] = self._word(word)
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.uint32)


def encoder(path: str) -> WordIds:
    """One for each Python worker, which runs many tasks."""
    held = sys.modules.setdefault("_staylens_word_ids", types.ModuleType("_staylens_word_ids"))
    if path not in held.__dict__:
        setattr(held, path, WordIds(path))
    return held.__dict__[path]


def _pieces(path: str, size: int, end_id: int, keep_ids: bool):
    def run(batches):
        words = encoder(path)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                rows = []
                for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    ids = np.append(words.ids(bytes_words(text)), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        row = (key, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                        rows.append((*row, piece.astype(np.int64).tolist()) if keep_ids else row)
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + keep_ids]
                kinds = [*[pa.int64()] * 5, pa.list_(pa.int64())]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names
                )

    return run


def pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    size: int = SIZE,
    end_id: int = END_ID,
    text: str = "text",
    key: str = "doc_id",
    keep_ids: bool = False,
) -> DataFrame:
    """A row for each piece of each row of ``docs``: doc_id, start, length, ids_crc32 (of the ids as
    little-endian 32-bit integers), doc_tokens; with ``keep_ids`` also ids. Every text ends with
    ``end_id``, so an empty or NULL text is one piece of one id. ``tokenizer`` is the path of a file
    for ``tokenizers`` that drops white space; the same on every executor."""
    sent = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return sent.mapInArrow(
        _pieces(tokenizer, size, end_id, keep_ids), schema + (", ids array<long>" if keep_ids else "")
    )


def _place(places: list[Places]):
    by_length: dict[int, np.ndarray] = {}
    for p in sorted(places, key=lambda p: (p.length, p.rank)):
        by_length.setdefault(p.length, []).append((p.rank, p.first, p.copies, p.offset))
    by_length = {k: np.array(v, np.int64) for k, v in by_length.items()}

    def run(batches):
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("_rank")).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                here = np.flatnonzero(length == n)
                table = by_length[int(n)]
                at = table[np.searchsorted(table[:, 0], rank[here], "right") - 1]
                t = rank[here] - at[:, 0]
                sequence[here] = at[:, 1] + t // at[:, 2]
                offset[here] = at[:, 3] + t % at[:, 2] * n
            kept = [i for i, name in enumerate(b.schema.names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in kept], pa.array(sequence), pa.array(offset)],
                names=[*[b.schema.names[i] for i in kept], "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, *, size: int = SIZE, buckets: int = RANK_BUCKETS) -> DataFrame:
    """``pieces`` (of lengths 1 to ``size``) with sequence_id and offset. Sequence ids are gapless
    from 0; in a sequence, pieces lie side by side from offset 0."""
    by_bucket = Window.partitionBy("length", "_bucket")
    numbered = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    counts = staged(numbered.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(by_bucket.orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = (
        numbered.withColumn("_in", rank)
        .join(firsts, ["length", "_bucket"])
        .select(*pieces.columns, (F.col("_before") + F.col("_in")).alias("_rank"))
    )
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schema = pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return ranked.mapInArrow(_place(shortest_pack_first(histogram, size)), schema)


def pack_documents(docs: DataFrame, tokenizer: str, *, size: int = SIZE, **settings) -> DataFrame:
    """``pack(pieces(docs))``; the pieces are written once to the shared folder in between."""
    return pack(staged(pieces(docs, tokenizer, size=size, **settings), "pieces"), size=size)
