import random

import numpy as np
import pytest
from llm_rows import ODD_TEXTS, WORD, no_docs, odd_docs

from staylens.llm import minhash_dedup as M
from staylens.llm import star_components


def sets_of(docs, n=M.N):
    out = {}
    for i, t in docs:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        out.setdefault(i, []).append(grams)
    return out


def reach(nodes, links):
    up = {i: i for i in nodes}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for a, b in links:
        lo, hi = sorted((top(a), top(b)))
        up[hi] = lo
    return {i: top(i) for i in up}


def brute(docs, percent=M.PERCENT):
    sets = [(i, s) for i, many in sets_of(docs).items() if i is not None for s in many]
    links = [
        (i, j)
        for x, (i, a) in enumerate(sets)
        for j, b in sets[:x]
        if a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    return reach({i for i, _ in sets}, links)


def near_copies(seed, groups=12):
    rng = random.Random(seed)

    def words(n):
        return [f"v{rng.randrange(5000)}" for _ in range(n)]

    line, passage, docs = words(8), words(60), []
    for _ in range(groups):
        base = words(rng.choice([5, 30, 120, 300]))
        for _ in range(rng.choice([1, 2, 6, 20])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            w = line + w if rng.random() < 0.3 else w
            docs.append(w + passage if rng.random() < 0.2 else w)
    docs += [passage + words(4) for _ in range(10)]
    docs += [["tiny"], ["tiny"], ["tiny", "text"], ["Tiny", "TEXT"]]
    rng.shuffle(docs)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(docs)]


@pytest.mark.parametrize(("seed", "tile"), [(4, 512), (5, 3)])
def test_components_against_all_pairs(spark, seed, tile):
    docs = near_copies(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = M.minhash_components(df, tile=tile).collect()
    want, sets = brute(docs), sets_of(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert r["component_id"] == want[r["doc_id"]]
        assert r["n_shingles"] == len(sets[r["doc_id"]][0])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_odd_rows_and_no_rows(spark):
    rows = M.minhash_components(odd_docs(spark)).collect()
    assert len(rows) == len(ODD_TEXTS)
    want = brute(ODD_TEXTS)
    for r in rows:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == want.get(r["doc_id"]))
    assert M.minhash_components(no_docs(spark)).count() == 0
    # one key with two texts is one node
    docs = [(5, "a b c d e f g"), (5, "p q r s t u v"), (6, "p q r s t u v"), (4, "a b c d e f g"), (9, "z z z z")]
    found = M.minhash_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(5, 4), (6, 4), (4, 4), (9, 9)}


def test_signatures_estimate_the_likeness():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.8):
        both = rng.integers(-(2**62), 2**62, 2000)
        cut = int(2000 * (1 - share) / 2)
        a, b = np.unique(both[: 2000 - cut]), np.unique(both[cut:])
        same = (M.signature(a) == M.signature(b)).mean()
        assert abs(same - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.14
    # minima by the definition
    codes = np.unique(rng.integers(-(2**62), 2**62, 700))
    for i in (0, 50, 127):
        assert M.signature(codes)[i] == min((int(M._A[i]) * (int(x) % 2**64) + int(M._B[i])) % 2**64 >> 32 for x in codes)


def test_agreement_bound():
    assert M.least_agreement(80) == 75
    rng = np.random.default_rng(2)
    sig = rng.integers(0, 2**32, (20, M.HASHES)).astype(np.uint32)
    sig[7, :80] = sig[3, :80]
    assert np.flatnonzero(M.agreeing(sig, 75)).tolist() == [3, 7]
    assert not M.agreeing(sig, 81).any()


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_star_components(spark, shape):
    rng = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in rng.sample(range(120), 120)],
        "star": [(1000 - i, 5) for i in range(300)] + [(5, 5)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(130)],
        "none": [],
    }[shape]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["id"]: r["label"] for r in star_components.components(df).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == reach({x for link in real for x in link}, real)
