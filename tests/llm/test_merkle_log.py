import hashlib
import zlib

import pytest

from staylens.llm import merkle_log
from llm_rows import ODD_TEXTS, no_docs, odd_docs


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)])
    return levels


def path(levels, x):
    out = []
    for nodes in levels[:-1]:
        run = nodes[x - x % 8 : x - x % 8 + 8]
        out.append(("".join(run[: x % 8]), "".join(run[x % 8 + 1 :])))
        x //= 8
    return out


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append((r, leaf(r, r["text"])))
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        trees[lang] = tree_levels([x[1] for x in langs[lang]])
    top = tree_levels([trees[lang][-1][0] for lang in order])
    root = top[-1][0]
    out = []
    for at, lang in enumerate(order):
        for x, (r, whole) in enumerate(langs[lang]):
            p = path(trees[lang], x) + path(top, at)
            i = r["doc_id"]
            node = leaf(r, lower(r["text"])) if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else whole
            for left, right in p:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in p))
            out.append((i, whole, trees[lang][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = merkle_log.proofs(merkle_log.build(df)).select(*names).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = found(docs)
    assert len(got) == len(ODD_TEXTS)
    assert got == brute(docs.collect())


def test_empty_table(spark):
    assert found(no_docs(spark)) == []
    assert merkle_log.build(no_docs(spark)).root().collect() == []


@pytest.mark.parametrize("n", [1, 8, 9])
def test_small_trees(spark, n):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(docs) == brute(docs.collect())


def test_several_tiers_and_many_languages(spark):
    # a third in one language and many languages of a few rows; the log of "en" has two tiers
    rows = [(i, "s", "en" if i % 3 else f"l{i % 40}", i % 7, f"Text {i % 50}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = found(docs.repartition(5))
    assert got == brute(docs.collect())
    changed = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 0}
    assert {r[0] for r in got if not r[-1]} == changed


def test_proof_fails_for_any_other_text(spark):
    rows = [(i, "s", "en", 1, f"text {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert all(r[-1] for r in found(docs))  # lower-casing changes none of these texts


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512])
def test_closed_form_positions(n):
    levels = merkle_log.height(n)
    log = merkle_log.append_log([sha(str(i)) for i in range(n)], levels)
    want = tree_levels([sha(str(i)) for i in range(n)])
    assert len(log) == sum(map(len, want))
    for level, nodes in enumerate(want):
        for i, node in enumerate(nodes):
            assert log[merkle_log.position(level, i, n)] == node
    for x in range(n):
        assert merkle_log.siblings(log, n, x, levels) == path(want, x)
        assert merkle_log.fold(log[merkle_log.position(0, x, n)], path(want, x)) == want[-1][0]
