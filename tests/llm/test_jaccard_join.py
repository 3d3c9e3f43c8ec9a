import random

import numpy as np
from llm_rows import ODD_TEXTS, WORD, no_docs, odd_docs

from staylens.llm import jaccard_join as J


def sets_of(docs, n=J.N):
    out = {}
    for i, t in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = WORD.findall(lower)
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        out.setdefault(i, []).append(grams)
    return out


def brute(docs, percent=J.PERCENT):
    """Component of each id, over all pairs."""
    sets = [(i, s) for i, many in sets_of(docs).items() if i is not None for s in many]
    up = {i: i for i, _ in sets}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((top(i), top(j)))
                up[hi] = lo
    return {i: top(i) for i in up}


def copies(seed=4):
    """Texts with copies of several strengths, a line and a passage that many share."""
    rng = random.Random(seed)

    def text(n):
        return [f"v{rng.randrange(5000)}" for _ in range(n)]

    line, passage = text(8), text(60)
    docs = []
    for _ in range(12):
        base = text(rng.choice([5, 30, 120, 300]))
        for _ in range(rng.choice([1, 2, 6, 15])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w = line + w
            if rng.random() < 0.2:
                w = w + passage
            docs.append(w)
    docs += [passage + text(4) for _ in range(10)]
    docs += [["tiny"], ["tiny"], ["tiny", "text"], ["Tiny", "TEXT"]]
    rng.shuffle(docs)
    return [(i * 3 + 1, " ".join(w)) for i, w in enumerate(docs)]


def test_components_against_all_pairs(spark):
    for seed, tile in ((4, 512), (5, 3), (6, 2)):
        docs = copies(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
        rows = J.jaccard_components(df, tile=tile, sketch_bits=6).collect()
        want, sets = brute(docs), sets_of(docs)
        assert len(rows) == len(docs)
        for r in rows:
            assert r["component_id"] == want[r["doc_id"]]
            assert r["n_shingles"] == len(sets[r["doc_id"]][0])


def test_a_chain_of_links_over_many_tiles(spark):
    """Each text links with the next two only, and all share the rarest n-grams' hub."""
    words = [f"c{i}" for i in range(400)]
    docs = [(i, " ".join(words[2 * i : 2 * i + 60])) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for tile in (2, 5):
        got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(df, tile=tile).collect()}
        assert got == brute(docs)


def test_block_product_and_bounds():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(40)] + [np.zeros(0, np.int64)]
    o = J.overlaps(sets)
    for a in range(len(sets)):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            assert o[a, b] == n
            both = len(sets[a]) + len(sets[b]) - n
            if len(sets[a]) and len(sets[b]):
                assert J.linked(sets, 30)[a, b] == (100 * n >= 30 * both)
    counts = rng.integers(0, 5, 1 << 6)
    for s in sets[:20]:
        wide = (s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        assert len(J.prefix(np.unique(wide), counts, 85)) == len(s) - -(-85 * len(s) // 100) + 1


def test_blocks_of_a_stream():
    import pyarrow as pa

    rng = random.Random(9)
    rows = sorted((rng.randrange(12), rng.choice([10, 11, 13, 20, 21, 40]), i) for i in range(80))
    want = set()
    block = []
    for k, (t, n, i) in enumerate(rows):
        if block and (t != rows[k - 1][0] or 100 * rows[k - 1][1] < 85 * n):
            block = []
        block.append(i)
        if len(block) > 1:
            want |= {(block[0], block[0]), (block[0], i)}
    for size in (1, 3, 80):
        parts = [rows[k : k + size] for k in range(0, len(rows), size)]
        names = ["token", "size", "id"]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*p)], names=names) for p in parts]
        got = [x for b in J._blocks(85)(batches) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        assert set(got) == want


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    rows = J.jaccard_components(docs).collect()
    assert len(rows) == docs.count()
    want = brute(ODD_TEXTS)
    for r in rows:
        assert r["component_id"] == want.get(r["doc_id"])
    assert J.jaccard_components(no_docs(spark)).count() == 0
    # one key with two texts is one node
    docs = [(5, "a b c d e f g"), (5, "p q r s t u v"), (6, "p q r s t u v"), (4, "a b c d e f g"), (9, "z z z z")]
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {(5, 4), (6, 4), (4, 4), (9, 9)}


def test_keep_one_each(spark):
    docs = odd_docs(spark)
    kept = J.keep_one_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r["doc_id"] for r in rows if r["doc_id"] is not None)) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13]
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert J.keep_one_each(no_docs(spark)).count() == 0


def test_ngrams_that_very_many_documents_have(spark, monkeypatch):
    """All n-grams that two documents have count as hot and are blocked by ranges of sizes."""
    monkeypatch.setattr(J, "HOT", 2)
    docs = copies(7)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(df, tile=4).collect()}
    assert got == brute(docs)


def test_early_places_find_every_linked_pair():
    """Linked sets share an n-gram that is early in the smaller one, so a stream of blocks holds every link."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    counts = rng.integers(0, 9, 1 << 8)
    sets, rows = [], []
    for _ in range(60):
        base = rng.integers(-(2**62), 2**62, int(rng.integers(3, 90)))
        for _ in range(6):
            s = np.concatenate([base[rng.random(len(base)) < 0.95], rng.integers(-(2**62), 2**62, int(rng.integers(0, 4)))])
            if len(s):
                sets.append(np.unique(s))
    for i, s in enumerate(sets):
        p = J.prefix(s, counts, 85)
        rows += [(int(t), len(s), i, k < J.early_places(len(s), 85)) for k, t in enumerate(p)]
    rows.sort()
    names = ["token", "size", "id", "early"]
    for step in (1, 50, len(rows)):
        parts = [rows[k : k + step] for k in range(0, len(rows), step)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*p)], names=names) for p in parts]
        blocks = {}
        for b in J._blocks(85)(batches):
            for hub, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                blocks.setdefault(hub, set()).add(i)
        assert all(hub in block for hub, block in blocks.items())
        link = J.linked(sets, 85)
        assert link.any()
        for a, z in zip(*np.nonzero(link)):
            assert any(a in block and z in block for block in blocks.values())


def test_one_passage_in_thousands_of_texts(spark):
    """Texts that share most of their n-grams without a link don't pass as copies, and copies among them do."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for i in range(2400):
        own = [f"o{rng.randrange(10**6)}" for _ in range(30)] if i % 100 else docs[-1][1].split()[60:] if docs else ["o"]
        docs.append((i, " ".join(passage + own)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(df).collect()}
    assert {i for i, c in got.items() if c != i} == {i for i in range(100, 2400, 100)}
    assert all(got[i] == i - 1 for i in range(100, 2400, 100))
