import math
import zlib
from unittest import mock

import numpy as np
from llm_rows import no_docs, odd_docs

from staylens.llm import queries as Q
from staylens.llm import toxicity as T

DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    rows = Q.op8_toxicity(spark, DIR).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [(toxic[r["doc_id"]], r["predicted"], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    yes = [p for t, p, _ in held if t]
    no = [p for t, p, _ in held if not t]
    # a few hundred toxic rows to learn from; with thousands it finds 98 of 100 (README)
    assert sum(yes) >= 0.8 * len(yes) and sum(no) <= 0.01 * len(no)
    # ranking
    pos, neg = [s for t, _, s in held if t], [s for t, _, s in held if not t]
    assert np.mean([np.mean(np.array(neg) < s) for s in pos]) > 0.975


def test_ngrams_are_those_of_the_text():
    texts = ["Abc defg", None, "", "x", "abc defg"]
    rows, buckets = T._present(texts)
    sets = [set(buckets[rows == i]) for i in range(len(texts))]
    assert sets[0] == sets[4] and len(sets[0]) == (7 + 6 + 5)  # " abc defg " has 10 bytes
    assert not sets[1] and not sets[2]
    alone = T._present(["abc defg"])[1]
    assert set(alone) == sets[0]
    many = ["abc defg" * 40_000, "abc defg"]
    rows, buckets = T._present(many)
    assert set(buckets[rows == 1]) == sets[0]


def _grams(text):
    data = b" " + (text or "").lower().encode() + b" "
    return {data[i : i + n] for n in T.NGRAMS for i in range(len(data) - n + 1)}


def test_ratios_are_the_bounds_of_log_count_ratios():
    c0, c1 = np.array([0, 0, 0, 40, 100, 3.0]), np.array([1, 30, 100, 0, 100, 0.0])
    found = T.ratios(c0, c1, 300, 100)
    for f, a, b in zip(found, c0, c1, strict=True):
        a, b = a + T.PRIOR * 0.75, b + T.PRIOR * 0.25
        ratio = math.log(b / (100 + T.PRIOR * 0.25)) - math.log(a / (300 + T.PRIOR * 0.75))
        error = math.sqrt(1 / a + 1 / b)
        low, high = ratio - T.CONFIDENCE * error, ratio + T.CONFIDENCE * error
        assert math.isclose(f, max(low, 0) + min(high, 0), abs_tol=1e-12)
    assert found[0] == found[5] == 0 and found[2] > found[1] > 0 > found[3]


def test_training_and_scores_by_brute_force(spark):
    """The model against one fitted here: n-grams cut one by one, plain gradient steps until the slope vanishes."""
    rng = np.random.default_rng(5)
    plain, rude = ["tree", "house", "river", "stone", "cloud", "field"], ["idiot", "scum"]
    texts = []
    for i in range(120):
        words = [str(w) for w in rng.choice(plain, 6)] + ([str(rng.choice(rude))] if i % 3 == 0 else [])
        texts.append((i, " ".join(rng.permutation(words)), int(i % 3 == 0)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in texts], "doc_id long, toxic int")
    with mock.patch.object(T, "PENALTIES", (0.5,)):
        model = T.train(docs, labels)
        every = sorted(set().union(*[_grams(t) for _, t, _ in texts]))
        y = np.array([y for *_, y in texts], float)
        has = np.array([[g in grams for g in every] for grams in (_grams(t) for _, t, _ in texts)], float)
        scale = T.ratios(has[y == 0].sum(axis=0), has[y == 1].sum(axis=0), int((y == 0).sum()), int(y.sum()))
    x = np.hstack([has * scale, np.ones((len(y), 1))])
    l2 = np.append(np.full(len(every), 0.5), 0.0)
    w = np.zeros(len(l2))
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(l2 + 1e-9), x.T @ (p - y) + l2 * w)
    expected = 1 / (1 + np.exp(-x @ w))
    scores = {r["doc_id"]: r["toxicity"] for r in T.with_score(docs, model).collect()}
    assert max(abs(scores[i] - expected[i]) for i in range(len(y))) < 0.01
    assert all((scores[i] > 0.7) == (t == 1) for i, _, t in texts)


def test_every_ngram_that_tells_the_classes_apart_has_a_weight(spark):
    """More marks than any fixed number of features: each toxic text has a few of 600 rude words."""
    rows = [(i, " ".join(f"bad{(i * 7 + k) % 600:03d}x" if i % 2 else f"good{(i * 7 + k) % 600:03d}y" for k in range(40)), i % 2) for i in range(1200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = T.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert np.count_nonzero(model.weights) > 1500
    one = spark.createDataFrame([(k, f"bad{k:03d}x") for k in range(600)], "doc_id long, text string")
    assert T.with_score(one, model).where("toxicity > 0.5").count() == 600


def test_the_largest_penalty_within_a_standard_error():
    # ten of 100 rows lose 1.1, the others 0.1: a sum of 20, squares of 13, a standard error of 3
    assert T.best_fit(np.array([23.0, 20.0, 21.0]), np.array([0, 13.0, 0]), 100) == 0
    assert T.best_fit(np.array([23.1, 20.0, 21.0]), np.array([0, 13.0, 0]), 100) == 1


def test_logistic_regression_finds_the_optimum(spark):
    rng = np.random.default_rng(1)
    found = [sorted(rng.choice(5, rng.integers(0, 5), replace=False).tolist()) for _ in range(400)]
    x = np.array([[float(k in f) for k in range(5)] for f in found])
    y = (2 * x[:, 0] - 2 * x[:, 1] + rng.normal(size=400) > 0).astype(int)
    scale = np.zeros(1 << T.HASH_BITS)
    scale[:5] = [1.0, 2.0, 0.5, 1.0, -1.0]
    rows = spark.createDataFrame([(int(a), b) for a, b in zip(y, found, strict=True)], "y int, hits array<int>")
    x = x * scale[:5]
    for l2, w in zip((2.0, 0.1), T.fit_logistic(rows, scale, [2.0, 0.1], 0.0), strict=True):
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        assert np.abs(x.T @ (p - y) + l2 * w[:-1]).max() < 1 and abs((p - y).sum()) < 1
        assert w[0] > 0.5 and w[1] < -0.25


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 0), (5, 0), (None, 1), (8, None), (99, 1)], "doc_id long, toxic int")
    model = T.train(docs, labels)
    out = T.with_score(docs, model, score="score")
    assert out.count() == docs.count() and out.columns.count("score") == 1
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    empty = {r["score"] for r in out.collect() if not (r["text"] or "").strip()}
    assert len(empty) == 1
    for few in (labels.where("toxic = 1"), labels.limit(0)):
        flat = T.with_score(docs, T.train(docs, few), score="s").select("s").distinct().collect()
        assert len(flat) == 1
    assert T.with_score(no_docs(spark), model).count() == 0
    assert T.with_score(docs, T.train(no_docs(spark), labels)).count() == docs.count()
