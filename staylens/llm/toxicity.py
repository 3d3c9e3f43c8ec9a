"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Training: hashed n-grams (4 to 6 UTF-8 bytes of the lower-cased text, present or absent) are counted
by class over a bounded sample of labelled rows. Every bucket's scale is its naive Bayes log-count
ratio, moved towards 0 by ``CONFIDENCE`` standard errors, so a bucket seen in a few texts by chance
has no or little scale; no number of features is fixed. A logistic regression with an L2 penalty is
fitted on the scaled features by L-BFGS: tasks sum loss and slope over their rows, the driver steps.
The penalty is the largest of ``PENALTIES`` whose log loss on a held-back fifth of the training rows
(ratios of the other rows) is within a standard error of the least; the final fit takes all rows.
Scoring needs one array of weights and no shuffle; it reads whole texts.

Bounds, all parameters: ``max_train_rows`` labelled rows (those with the smallest xxhash64 of their
id) and ``1 << HASH_BITS`` buckets. The driver holds counts and weights by bucket, never a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import runs_in_tasks, sorted_distinct, staged, unique_name

runs_in_tasks(__name__)

HASH_BITS = 18
NGRAMS = (4, 5, 6)
MAX_TRAIN_ROWS = 20_000
#: Occurrences, in proportion to the classes, that every bucket has beside the counted ones.
PRIOR = 32.0
#: Standard errors by which a log-count ratio is moved towards 0.
CONFIDENCE = 2.0
#: L2 penalties to choose from, the middle one where a part of the rows lacks a class.
PENALTIES = (1.0, 0.1, 0.01)
#: One row in so many is held back to choose the penalty.
HELD_BACK = 5
#: Tasks of a step of the fit over the bounded sample; the driver sums their slopes.
FIT_TASKS = 8
MAX_STEPS = 100
THRESHOLD = 0.7
#: Bytes of text that a task hashes at a time.
CHUNK_BYTES = 1 << 18
#: Hits that a task weighs at a time in a step of the fit.
CHUNK_HITS = 1 << 18


@dataclass(frozen=True)
class Model:
    """``weights`` by bucket (0 for most) and the intercept."""

    weights: np.ndarray
    bias: float


def hashed_ngrams(texts: list[str | None]):
    """Yields (row, bucket) arrays for n-grams of ``texts``, in slices of about CHUNK_BYTES. An
    n-gram may occur more than once. Texts are lower-cased and set between blanks."""
    gap = b"\0" * (max(NGRAMS) - 1)
    start, size, parts = 0, 0, []
    for i, text in enumerate(texts):
        part = b" " + (text or "").lower().encode("utf-8", "surrogatepass") + b" " + gap
        parts.append(part)
        size += len(part)
        if size >= CHUNK_BYTES or i == len(texts) - 1:
            data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
            rows = np.repeat(np.arange(start, i + 1), [len(p) for p in parts])
            code = np.zeros(len(data), np.uint32)
            for n in range(1, max(NGRAMS) + 1):
                code = code[: len(data) - n + 1] * np.uint32(0x01000193) + data[n - 1 :]
                if n in NGRAMS:
                    mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                    inside = data[n - 1 :] != 0
                    inside &= data[: len(data) - n + 1] != 0
                    yield rows[: len(code)][inside], (mixed >> np.uint32(32 - HASH_BITS))[inside].astype(np.int32)
            start, size, parts = i + 1, 0, []


def _present(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct buckets of each text, those of the mask ``wanted`` only."""
    keys = []
    for rows, buckets in hashed_ngrams(texts):
        if wanted is not None:
            hit = wanted[buckets]
            rows, buckets = rows[hit], buckets[hit]
        keys.append(sorted_distinct((rows.astype(np.int64) << HASH_BITS) | buckets))
    key = sorted_distinct(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)


def _cut(batch, sizes: np.ndarray, most: int):
    """The batch in slices of at most ``most`` in the sum of the rows' ``sizes``, or of one row."""
    ends, first = np.cumsum(sizes), 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _slices(batches, texts: int):
    """The batches in slices of at most about CHUNK_BYTES of the column ``texts``, or one row, so that the n-grams
    held at a time don't grow with the length of the texts."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(texts)), 0)
        yield from _cut(b, sizes.to_numpy().astype(np.int64), CHUNK_BYTES)


def _count_batches(batches):
    """Texts with a bucket by class, of the rows to fit on (n0, n1) and of those held back (h0, h1)."""
    counts = np.zeros((4, 1 << HASH_BITS), np.int64)
    for b in _slices(batches, 0):
        kind = b.column(1).to_numpy(zero_copy_only=False) + 2 * b.column(2).to_numpy(zero_copy_only=False)
        rows, buckets = _present(b.column(0).to_pylist())
        for k in range(4):
            counts[k] += np.bincount(buckets[kind[rows] == k], minlength=1 << HASH_BITS)
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), *[pa.array(c[seen]) for c in counts]], names=["bucket", *_COUNTS]
    )


_COUNTS = ["n0", "n1", "h0", "h1"]


def ratios(c0: np.ndarray, c1: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """Log-count ratio of each bucket, ``c0`` of ``n0`` and ``c1`` of ``n1`` texts having it: the bound
    nearest to 0 of the interval of ``CONFIDENCE`` standard errors, 0 where that holds 0."""
    prior0, prior1 = PRIOR * n0 / (n0 + n1), PRIOR * n1 / (n0 + n1)
    ratio = np.log((c1 + prior1) / (n1 + prior1)) - np.log((c0 + prior0) / (n0 + prior0))
    error = np.sqrt(1 / (c1 + prior1) + 1 / (c0 + prior0))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - CONFIDENCE * error, 0)


def _hits(wanted: np.ndarray):
    """Row by row the buckets of the mask ``wanted`` that a text has."""

    def run(batches):
        for b in _slices(batches, 0):
            rows, buckets = _present(b.column(0).to_pylist(), wanted)
            at = np.searchsorted(rows, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(1), b.column(2), pa.ListArray.from_arrays(at, pa.array(buckets.astype(np.int32)))],
                names=["y", "back", "hits"],
            )

    return run


def _loss_and_slope(features: np.ndarray, values: np.ndarray, points: list[np.ndarray]):
    """For each of ``points`` (weights of the scaled features, then the intercept) the log loss over the
    rows of a task, its slope and the squares of the rows' losses, one after the other in one binary."""

    def run(batches):
        total = np.zeros((len(points), len(features) + 3))
        place = np.full(1 << HASH_BITS, -1, np.int32)
        place[features] = np.arange(len(features))
        for b in (part for b in batches for part in _cut(b, np.diff(b.column(1).offsets.to_numpy()), CHUNK_HITS)):
            found = b.column(1)
            at = place[found.flatten().to_numpy()]
            row = np.repeat(np.arange(b.num_rows), np.diff(found.offsets.to_numpy()))[at >= 0]
            at = at[at >= 0]
            y = b.column(0).to_numpy()
            for out, w in zip(total, points, strict=True):
                margin = w[-1] + np.bincount(row, (w[:-1] * values)[at], minlength=b.num_rows)
                loss = np.logaddexp(0, margin) - margin * y
                out[0] += loss.sum()
                out[-1] += (loss**2).sum()
                miss = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y
                out[1:-2] += np.bincount(at, miss[row], minlength=len(features)) * values
                out[-2] += miss.sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def _evaluate(hits: DataFrame, scale: np.ndarray, points: list[np.ndarray]) -> np.ndarray:
    """Loss, slope and squares over all rows (y, hits), a row for each of ``points``."""
    features = np.flatnonzero(scale)
    run = _loss_and_slope(features, scale[features], points)
    parts = hits.select("y", "hits").coalesce(FIT_TASKS).mapInArrow(run, "sums binary").toArrow()
    shape = (len(points), len(features) + 3)
    return sum((np.frombuffer(x.as_py()).reshape(shape) for x in parts.column(0)), np.zeros(shape))


def minimise(w: np.ndarray, steps: int = MAX_STEPS, memory: int = 10, enough: float = 1e-4):
    """L-BFGS with halved steps. Yields points, is sent (value, slope) there and returns the best one."""
    value, slope = yield w
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, shares = -slope, []
        for s, d in reversed(moves):
            shares.append((s @ way) / (s @ d))
            way = way - shares[-1] * d
        if moves:
            s, d = moves[-1]
            way = way * ((s @ d) / (d @ d))
        else:
            way = way / max(1.0, np.linalg.norm(slope))
        for (s, d), share in zip(moves, reversed(shares), strict=True):
            way = way + s * (share - (d @ way) / (s @ d))
        length, down = 1.0, slope @ way
        while True:
            new, new_slope = yield w + length * way
            if new <= value + 1e-4 * length * down:
                break
            length /= 2
            if length < 1e-6:
                return w
        s, d = length * way, new_slope - slope
        if s @ d > 1e-12:
            moves = [*moves, (s, d)][-memory:]
        gained, w, value, slope = value - new, w + s, new, new_slope
        if gained <= enough * abs(value):
            break
    return w


def fit_logistic(hits: DataFrame, scale: np.ndarray, penalties: list[float], bias: float) -> list[np.ndarray]:
    """Weights and intercept of the logistic regression for each of ``penalties`` on all but the intercept.
    All fits are stepped together, so that one pass over the rows serves them all."""
    start = np.append(np.zeros(np.count_nonzero(scale)), bias)
    running = {i: minimise(start) for i in range(len(penalties))}
    at = {i: next(run) for i, run in running.items()}
    done: dict[int, np.ndarray] = {}
    while at:
        found = _evaluate(hits, scale, list(at.values()))
        for (i, w), sums in zip(list(at.items()), found, strict=True):
            l2 = np.append(np.full(len(w) - 1, penalties[i]), 0.0)
            try:
                at[i] = running[i].send((sums[0] + (l2 * w) @ w / 2, sums[1:-1] + l2 * w))
            except StopIteration as end:
                done[i] = end.value
                del at[i]
    return [done[i] for i in range(len(penalties))]


def best_fit(losses: np.ndarray, squares: np.ndarray, n: int) -> int:
    """The first fit whose loss over ``n`` rows is at most a standard error above the least."""
    least = int(np.argmin(losses))
    error = np.sqrt(max(0.0, squares[least] - losses[least] ** 2 / n))
    return int(np.flatnonzero(losses <= losses[least] + error)[0])


def train(
    docs: DataFrame,
    labelled: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    max_train_rows: int = MAX_TRAIN_ROWS,
) -> Model:
    """Fits on the rows of ``docs`` whose key has a label in ``labelled``. NULL labels and keys are
    left out, a key with several labels counts as toxic if one of them is. Without rows of both
    classes the model gives every text the share of toxic rows (0 without any row)."""
    chosen = (
        labelled.select(F.col(key).alias("_k"), F.col(label).cast("int").alias("_y"))
        .where("_k is not null and _y is not null")
        .groupBy("_k")
        .agg(F.max("_y").alias("_y"))
        .orderBy(F.xxhash64("_k"), "_k")
        .limit(max_train_rows)
    )
    # at most max_train_rows small rows, so the texts need no shuffle
    back = (F.pmod(F.xxhash64("_k", F.lit(1)), F.lit(HELD_BACK)) == 0).cast("int")
    rows = staged(
        docs.select(F.col(key).alias("_k"), F.col(text).alias("_x"))
        .join(F.broadcast(chosen), "_k")
        .select("_x", (F.col("_y") > 0).cast("int").alias("y"), back.alias("back")),
        "training",
    )
    n = np.zeros((2, 2), np.int64)
    for r in rows.groupBy("back", "y").count().collect():
        n[r["back"], r["y"]] = r["count"]
    n0, n1 = (int(x) for x in n.sum(axis=0))
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.0
        return Model(np.zeros(1 << HASH_BITS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    counted = (
        rows.mapInArrow(_count_batches, "bucket int, n0 long, n1 long, h0 long, h1 long")
        .groupBy("bucket")
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
        .toArrow()
    )
    c = np.zeros((4, 1 << HASH_BITS))
    for k, name in enumerate(_COUNTS):
        c[k, counted.column("bucket").to_numpy()] = counted.column(name).to_numpy()
    scale = ratios(c[0] + c[2], c[1] + c[3], n0, n1)
    choose = n.all()
    first = ratios(c[0], c[1], *n[0]) if choose else np.zeros_like(scale)
    hits = staged(rows.mapInArrow(_hits((scale != 0) | (first != 0)), "y int, back int, hits array<int>"), "hits")
    l2 = PENALTIES[len(PENALTIES) // 2]
    if choose:
        tried = fit_logistic(hits.where("back = 0"), first, list(PENALTIES), float(np.log(n[0, 1] / n[0, 0])))
        held = _evaluate(hits.where("back = 1"), first, tried)
        l2 = PENALTIES[best_fit(held[:, 0], held[:, -1], int(n[1].sum()))]
    (best,) = fit_logistic(hits, scale, [l2], float(np.log(n1 / n0)))
    weights = np.zeros(1 << HASH_BITS, np.float32)
    weights[scale != 0] = best[:-1] * scale[scale != 0]
    return Model(weights, float(best[-1]))


def _score_batches(model: Model, name: str):
    wanted = model.weights != 0

    def run(batches):
        for b in _slices(batches, -1):
            rows, buckets = _present(b.column(b.num_columns - 1).to_pylist(), wanted)
            total = model.bias + np.bincount(rows, model.weights[buckets], minlength=b.num_rows)
            score = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(score)], names=[*b.schema.names[:-1], name]
            )

    return run


def with_score(
    docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, score: str = "toxicity"
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) and the double ``score``. NULL and empty
    texts get the score of a text without any feature. A column of the name ``score`` is replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != score.lower()]
    sent = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(unique_name(keep, "_text")))
    out = sent.drop(sent.columns[-1]).withColumn(score, F.lit(0.0)).schema
    return sent.mapInArrow(_score_batches(model, score), out)
