import hashlib

import xxhash
from llm_rows import ODD_TEXTS, WORD, no_docs, odd_docs
from pyspark.sql import functions as F

from staylens.llm import order_minhash as O

MASK = (1 << 64) - 1


def long_bytes(x):
    return (x & MASK).to_bytes(8, "little")


def brute(text, k=O.K, size=O.TUPLE, bits=O.BIN_BITS):
    """The fingerprint, straight from the definition."""
    w = [x.encode() for x in WORD.findall(text or "")]

    def chain(parts):
        h = 42
        for p in parts:
            h = xxhash.xxh64_intdigest(p, h)
        return h

    runs = [w[i : i + k] for i in range(len(w))]
    seen, numbered = {}, []
    for i, r in enumerate(runs):
        h = chain(r)
        o = seen[h] = seen.get(h, -1) + 1
        numbered.append((h if o == 0 else chain([long_bytes(h), o.to_bytes(4, "little")]), i))
    bins = {}
    for h, i in numbered:
        bins.setdefault(h >> (64 - bits), []).append((h - (1 << 64) if h >> 63 else h, i))
    out = {}
    for b, entries in bins.items():
        chosen = sorted(sorted(entries)[:size], key=lambda e: e[1])
        out[b] = chain([long_bytes(h) for h, _ in chosen]) >> 32
    return out


def near(a, b):
    either = set(a) | set(b)
    return sum(a.get(x) == b.get(x) for x in either) / len(either) if either else 1.0


def test_fingerprints_against_brute_force(spark):
    texts = [t for _, t in ODD_TEXTS] + ["a b a b a b a b c", "x x x x x x", " ".join(f"t{i % 50} u{i % 7}" for i in range(900))]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    fp = O.fingerprint(F.coalesce("text", F.lit("")))
    for r in docs.select("i", fp.alias("fp"), O.as_text(fp).alias("s")).collect():
        want = brute(texts[r["i"]])
        assert {x >> 32: x & 0xFFFFFFFF for x in r["fp"]} == want
        assert {int(r["s"][j : j + 2], 16): int(r["s"][j + 2 : j + 10], 16) for j in range(0, len(r["s"]), 10)} == want


def test_edit_check_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    # ids far apart, negative and in several blocks
    docs = [(i * 977 - 50_000 if i % 2 else i * (1 << 33), t) for i, t in docs[:60]] + [(77, None), (78, "")]
    docs.sort()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = {r["doc_id"]: r for r in O.edit_check(df).collect()}
    assert len(rows) == len(docs)
    for n, (i, t) in enumerate(docs):
        t, after = t or "", docs[(n + 1) % len(docs)][1] or ""
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert abs(r["near_edited"] - near(brute(t), brute(changed))) < 1e-12
        assert abs(r["near_next"] - near(brute(t), brute(after))) < 1e-12


def test_order_matters():
    a = " ".join(f"w{i}" for i in range(2000))
    halves = a.split()
    moved = " ".join(halves[1000:] + halves[:1000])
    cut = " ".join(halves[:1900])
    assert near(brute(a), brute(moved)) < near(brute(a), brute(cut))


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    rows = O.edit_check(docs).collect()
    assert len(rows) == docs.count()
    by_text = {}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    for r in rows:
        by_text.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert O.edit_check(no_docs(spark)).count() == 0
    assert O.edit_check(docs.where("doc_id = 7")).first()["near_next"] == 1.0
