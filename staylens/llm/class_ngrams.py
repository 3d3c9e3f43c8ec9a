"""Scoring texts by a Brown class-based bigram model.

A word's class is found by exchange clustering; a text's probability is the product of class
transitions and of words given their class:  P(w_i | w_(i-1)) = P(c_i | c_(i-1)) P(w_i | c_i).

* Counting: every word of every training text (one shuffle of the vocabulary).
* Units: the ``OWN_UNITS`` most frequent words are clustered one by one, all others by their last
  three bytes (``ENDING_UNITS`` hashed groups), so that clustering needs a table of at most
  units x units whatever the size of the vocabulary. Each word keeps its own count and emission.
* Exchange: in each sweep, tasks sum the units' neighbours by class from the bigram table; the
  driver (units x classes numbers) moves each unit to the class that raises the likelihood of the
  training text most. The sweep with the best likelihood is taken.
* Smoothing: transitions are interpolated with class frequencies, emissions discounted absolutely;
  the discount is the probability of an unknown word in the class. Probabilities sum to 1.
* Scoring: words among the ``HOT_WORDS`` most frequent are scored where the text is read; the others
  are joined with the vocabulary by word, so no frequent word is a hot key of that join.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import runs_in_tasks, staged

runs_in_tasks(__name__)

CLASSES = 64
OWN_UNITS = 3072
ENDING_UNITS = 1023
HOT_WORDS = 200_000
SWEEPS = 8
#: Pseudo-count of the class frequencies in a transition row.
TRANSITION_PRIOR = 5.0
_FLUSH = 400_000


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _count_words(batches):
    """(word, n); the end of a text counts as the word NULL."""
    counts: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )
        counts.clear()
        return out

    for b in batches:
        for text in b.column(0).to_pylist():
            counts.update(_words(text))
            if len(counts) > _FLUSH:
                yield flush()
        counts[None] += b.num_rows
    yield flush()


@dataclass(frozen=True)
class Units:
    """Unit of each word: its rank among the frequent words, or the group of its ending."""

    rank: dict[bytes, int]
    own: int
    endings: int

    @property
    def size(self) -> int:
        return self.own + self.endings + 1

    @property
    def end(self) -> int:
        return self.own + self.endings

    def ending(self, word: bytes) -> int:
        return self.own + zlib.crc32(word[-3:]) % self.endings

    def of_ranks(self) -> np.ndarray:
        """Unit by rank of the frequent words."""
        return np.array([i if i < self.own else self.ending(w) for i, w in enumerate(self.rank)], np.int64)


def _count_pairs(units: Units):
    by_rank = units.of_ranks()

    def run(batches):
        held, total = [], 0

        def flush():
            every = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            code, n = every[first], np.diff(np.append(first, len(every)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), pa.array(n)], names=["code", "n"])

        for b in batches:
            for text in b.column(0).to_pylist():
                w = _words(text)
                u = np.full(len(w) + 2, units.end, np.int64)
                rank = np.array([units.rank.get(x, -1) for x in w], np.int64)
                u[1:-1] = by_rank[rank] if len(by_rank) else 0
                for i in np.flatnonzero(rank < 0):
                    u[i + 1] = units.ending(w[i])
                held.append(u[:-1] * units.size + u[1:])
                total += len(u)
                if total > 4_000_000:
                    total = 0
                    yield flush()
        if held:
            yield flush()

    return run


def _neighbour_sums(classes: np.ndarray, n_classes: int):
    def run(batches):
        for b in batches:
            near = b.column(2)
            row = np.repeat(np.arange(b.num_rows), np.diff(near.offsets.to_numpy()))
            v, n = (near.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(2))
            sums = np.bincount(row * n_classes + classes[v], n, minlength=b.num_rows * n_classes)
            out = [r.tobytes() for r in sums.astype(np.float64).reshape(-1, n_classes)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.binary())], names=["u", "after", "by_class"]
            )

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(n: np.ndarray) -> float:
    """Log-likelihood of the class sequence and words, up to a constant of the corpus."""
    total = n.sum(axis=1)
    return float(_xlogx(n).sum() - 2 * _xlogx(total).sum())


def exchange_sweep(
    classes: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray, fixed: int
) -> np.ndarray:
    """Moves each unit, frequent ones first, to its best class. ``after`` and ``before`` hold a
    unit's bigram counts by the neighbour's class, ``itself`` those with itself; all as of the start
    of the sweep. The last class belongs to the unit ``fixed``."""
    classes = classes.copy()
    k = after.shape[1]
    n = np.zeros((k, k))
    np.add.at(n, classes, after)
    total = n.sum(axis=1)
    count = after.sum(axis=1)
    for u in np.argsort(-count, kind="stable"):
        if u == fixed or not count[u]:
            continue
        a = classes[u]
        s, p, own = after[u].copy(), before[u].copy(), itself[u]
        s[a] -= own
        p[a] -= own
        n[a] -= s
        n[:, a] -= p
        n[a, a] -= own
        total[a] -= count[u]
        np.maximum(n, 0, out=n)
        f = _xlogx(n)
        rows = _xlogx(n + s[None, :]) - f
        columns = _xlogx(n + p[:, None]) - f
        d = np.diag(n)
        gain = rows.sum(axis=1) - np.diag(rows) + columns.sum(axis=0) - np.diag(columns)
        gain += _xlogx(d + s + p + own) - _xlogx(d) - 2 * (_xlogx(total + count[u]) - _xlogx(total))
        b = int(np.argmax(gain[:-1]))
        if gain[b] <= gain[a] + 1e-9:
            b = a
        classes[u] = b
        n[b] += s
        n[:, b] += p
        n[b, b] += own
        total[b] += count[u]
    return classes


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs besides the vocabulary table; bounded by HOT_WORDS, units and
    classes. Logarithms are to base 10."""

    units: Units
    classes: np.ndarray
    hot_counts: np.ndarray
    transitions: np.ndarray
    class_tokens: np.ndarray
    class_types: np.ndarray
    discount: float
    tokens: int
    types: int
    ends: int


def _class_totals(units: Units, classes: np.ndarray):
    by_rank = classes[units.of_ranks()] if units.rank else np.zeros(0, np.int64)
    k = int(classes.max()) + 1

    def run(batches):
        tokens, types = np.zeros(k, np.int64), np.zeros(k, np.int64)
        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            c = np.array([by_rank[r] if (r := units.rank.get(w, -1)) >= 0 else classes[units.ending(w)] for w in words], np.int64)
            tokens += np.bincount(c, n, minlength=k).astype(np.int64)
            types += np.bincount(c, minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k)), pa.array(tokens), pa.array(types)], names=["c", "tokens", "types"]
        )

    return run


def cluster(pairs: DataFrame, units: Units, n_classes: int = CLASSES, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class bigram counts) by exchange. ``pairs`` has (code, n) for unit
    bigrams. The end of a text has the last class, of its own."""
    size, k = units.size, n_classes + 1
    first, second = F.floor(F.col("code") / size).cast("int"), F.pmod("code", F.lit(size)).cast("int")
    sides = pairs.select(first.alias("u"), second.alias("v"), "n", F.lit(True).alias("after")).union(
        pairs.select(second, first, "n", F.lit(False))
    )
    # at most ``size`` neighbours in a row, whatever the corpus
    near = staged(sides.groupBy("u", "after").agg(F.collect_list(F.struct("v", "n")).alias("pairs")), "neighbours")
    itself = np.zeros(size)
    for r in pairs.where(first == second).select(first.alias("u"), "n").collect():
        itself[r["u"]] = r["n"]
    classes = np.arange(size) % n_classes
    classes[units.end] = n_classes
    best = None
    for sweep in range(sweeps + 1):
        after, before = np.zeros((size, k)), np.zeros((size, k))
        rows = near.mapInArrow(_neighbour_sums(classes, k), "u int, after boolean, by_class binary").toArrow()
        for u, is_after, sums in zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True):
            (after if is_after else before)[u] = np.frombuffer(sums)
        n = np.zeros((k, k))
        np.add.at(n, classes, after)
        value = likelihood(n)
        if best is None or value > best[0]:
            best = (value, classes, n)
        if sweep < sweeps:
            moved = exchange_sweep(classes, after, before, itself, units.end)
            if (moved == classes).all():
                break
            classes = moved
    return best[1], best[2]


def train(
    docs: DataFrame,
    *,
    text: str = "text",
    n_classes: int = CLASSES,
    own_units: int = OWN_UNITS,
    ending_units: int = ENDING_UNITS,
    hot_words: int = HOT_WORDS,
    sweeps: int = SWEEPS,
) -> tuple[Model, DataFrame]:
    """The model and its vocabulary (word, n) for the texts of ``docs``. NULL texts count as empty."""
    texts = docs.select(F.col(text).alias("text"))
    counted = staged(
        texts.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "vocabulary"
    )
    ends = counted.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    vocabulary = counted.where("word is not null")
    t = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("types"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
    ).first()
    hot = vocabulary.orderBy(F.desc("n"), "word").limit(hot_words).toArrow()
    rank = {w: i for i, w in enumerate(hot.column("word").to_pylist())}
    units = Units(rank, own_units, ending_units)
    pairs = staged(
        texts.mapInArrow(_count_pairs(units), "code int, n long").groupBy("code").agg(F.sum("n").alias("n")), "pairs"
    )
    classes, n = cluster(pairs, units, n_classes, sweeps)
    k = n_classes + 1
    tokens, types = np.zeros(k), np.zeros(k)
    totals = vocabulary.mapInArrow(_class_totals(units, classes), "c long, tokens long, types long")
    for r in totals.groupBy("c").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect():
        tokens[r["c"]], types[r["c"]] = r["tokens"], r["types"]
    tokens[n_classes], types[n_classes] = ends, ends > 0
    frequency = (tokens + 1) / (tokens.sum() + k)
    transitions = (n + TRANSITION_PRIOR * frequency) / (n.sum(axis=1, keepdims=True) + TRANSITION_PRIOR)
    discount = t["once"] / (t["once"] + 2 * t["twice"]) if t["twice"] else 0.75
    model = Model(
        units,
        classes,
        hot.column("n").to_numpy(),
        np.log10(transitions),
        tokens,
        types,
        discount,
        int(t["tokens"] + ends),
        int(t["types"] + (ends > 0)),
        int(ends),
    )
    return model, vocabulary


def _unknown(model: Model) -> np.ndarray:
    """log10 of the probability of an unknown word by class."""
    with np.errstate(divide="ignore", invalid="ignore"):
        share = model.discount * model.class_types / model.class_tokens
    return np.log10(np.where(model.class_tokens > 0, share, 1.0))


def _score_parts(model: Model):
    units = model.units
    by_rank = model.classes[units.of_ranks()] if units.rank else np.zeros(0, np.int64)
    base_total = np.log10(model.tokens + model.types + 1)
    with np.errstate(divide="ignore"):
        emission = np.log10(model.hot_counts - model.discount) - np.log10(model.class_tokens[by_rank])
        base = np.log10(model.hot_counts + 1.0) - base_total
    end_class = len(model.class_tokens) - 1
    end_base = np.log10(model.ends + 1.0) - base_total
    # the end is the only word of its class; unseen in training, it is an unknown word there

    def run(batches):
        for b in batches:
            out, rare = [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = _words(text)
                text_key = int.from_bytes(hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
                rank = np.array([units.rank.get(x, -1) for x in w], np.int64)
                c = np.full(len(w) + 2, end_class, np.int64)
                c[1:-1] = by_rank[rank] if len(by_rank) else 0
                others: Counter = Counter()
                for i in np.flatnonzero(rank < 0):
                    c[i + 1] = model.classes[units.ending(w[i])]
                    others[w[i], int(c[i + 1])] += 1
                known = rank[rank >= 0]
                out.append(
                    (
                        key,
                        text_key,
                        len(w) + 1,
                        len(known) + (model.ends > 0),
                        float(base[known].sum() + end_base),
                        float(model.transitions[c[:-1], c[1:]].sum() + emission[known].sum()),
                    )
                )
                rare += [(key, text_key, *x, n) for x, n in others.items()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            more = list(zip(*rare, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    pa.nulls(len(out), pa.binary()),
                    pa.nulls(len(out), pa.int32()),
                ],
                names=_PART_NAMES,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(more[0], pa.int64()),
                    pa.array(more[1], pa.int64()),
                    pa.array(more[4], pa.int64()),
                    pa.nulls(len(rare), pa.int64()),
                    pa.nulls(len(rare), pa.float64()),
                    pa.nulls(len(rare), pa.float64()),
                    pa.array(more[2], pa.binary()),
                    pa.array(more[3], pa.int32()),
                ],
                names=_PART_NAMES,
            )

    return run


_PART_NAMES = ["id", "text_key", "n", "known", "base", "score", "word", "class"]
_PART_SCHEMA = "id long, text_key long, n long, known long, base double, score double, word binary, class int"


def score(docs: DataFrame, model: Model, vocabulary: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``. A NULL
    text counts as empty: one token, the end. Equal rows get equal results."""
    sent = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    parts = staged(sent.mapInArrow(_score_parts(model), _PART_SCHEMA), "parts")
    whole = parts.where("word is null").select(
        "id", "text_key", F.lit(1).cast("long").alias("rows"), F.col("n").alias("n_tokens"), "known", "base", "score"
    )

    def by_class(values: np.ndarray) -> Column:
        return F.get(F.array(*[F.lit(float(x)) for x in values]), F.col("class"))

    with np.errstate(divide="ignore"):
        log_tokens = np.where(model.class_tokens > 0, np.log10(model.class_tokens), 0.0)
    base_total = float(np.log10(model.tokens + model.types + 1))
    seen = F.coalesce(F.col("seen"), F.lit(0))
    emission = F.when(seen > 0, F.log10(seen - F.lit(model.discount)) - by_class(log_tokens)).otherwise(
        by_class(_unknown(model))
    )
    rare = (
        parts.where("word is not null")
        .select("id", "text_key", "n", "word", "class")
        .join(vocabulary.select("word", F.col("n").alias("seen")), "word", "left")
        .select(
            "id",
            "text_key",
            F.lit(0).cast("long").alias("rows"),
            F.lit(0).cast("long").alias("n_tokens"),
            F.when(seen > 0, F.col("n")).otherwise(F.lit(0)).alias("known"),
            (F.col("n") * (F.log10(seen + 1.0) - base_total)).alias("base"),
            (F.col("n") * emission).alias("score"),
        )
    )
    sums = ["rows", "n_tokens", "known", "base", "score"]
    total = whole.union(rare).groupBy("id", "text_key").agg(*[F.sum(c).alias(c) for c in sums])
    # equal rows were summed; each gets its share
    return total.select(
        F.col("id").alias(key),
        F.expr("n_tokens div rows").alias("n_tokens"),
        F.expr("known div rows").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("rows")).alias("base_score"),
        (F.col("score") / F.col("rows")).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_copy"),
    ).drop("_copy")
