from pyspark.sql import functions as F

import re
from collections import Counter

from listing_rows import rows
from staylens.operators import terms

DOCS = [
    (1, "Sunny loft, sunny view! It's R&B night.", "n1"),
    (2, "Quiet loft near the park", "n1"),
    (3, "Park view; wi-fi & parking", "n2"),
    (4, "€€€", "n3"),  # no token characters
    (5, None, "n2"),  # dropped from the corpus
    (1, "extra text for a repeated id", "n1"),
]


def py_tokens(text):
    t = re.sub("[^0-9a-z'\\-&]", " ", text.replace("\u0130", "i").lower())
    return re.sub(" +", " ", t).strip().split(" ")


def brute_listing():
    docs = [(i, d) for i, d, _ in DOCS if d is not None]
    n = float(len(docs))  # D14: N = rows in listing mode
    df = Counter()
    for term in {(i, t) for i, d in docs for t in py_tokens(d)}:
        df[term[1]] += 1
    return n, df, docs


def corpus(spark):
    return spark.createDataFrame(DOCS, "id long, description string, neighbourhood string")


def test_term_counts_and_idf(spark):
    c = corpus(spark)
    counts = {(r["id"], r["term"]): r["n"] for r in terms.term_counts(c).collect()}
    assert counts[(1, "sunny")] == 2 and counts[(4, "")] == 1  # D13: blank text -> one '' term
    n, df, _ = brute_listing()
    idf = dict(rows(terms.idf_by_listing(c)))
    assert set(idf) == set(df)
    for t, v in idf.items():
        assert abs(v - n / df[t]) < 1e-12


def test_top_terms_listing_matches_brute_force(spark):
    c = corpus(spark)
    n, df, docs = brute_listing()
    toks = [t for i, d in docs if i == 1 for t in py_tokens(d)]
    cnt = Counter(toks)
    want = sorted(((t, (k / len(toks)) * (n / df[t])) for t, k in cnt.items()), key=lambda x: (-x[1], x[0]))[:5]
    got = [(r["term"], r["weight"]) for r in terms.tfidf_top_terms(c, 1, "listing", 5).collect()]
    assert [t for t, _ in got] == [t for t, _ in want]
    for (_, a), (_, b) in zip(got, want):
        assert abs(a - b) < 1e-12
    assert terms.tfidf_top_terms(c, 999, "listing", 5).count() == 0  # D20: unknown id -> empty


def test_neighbourhood_mode(spark):
    c = corpus(spark)
    counts = {(r["neighbourhood"], r["term"]): r["n"] for r in terms.term_counts(c, "neighbourhood").collect()}
    assert ("n3", "") in counts  # a neighbourhood with no words keeps one empty token
    assert all(t != "" for (nb, t) in counts if nb != "n3")
    idf = dict(rows(terms.document_frequency(c, "neighbourhood").select("term", "idf")))
    assert idf["loft"] == 3.0 / 1  # N = 3 distinct neighbourhoods (D14)
    top_all = rows(terms.tfidf_top_terms_all(c, "neighbourhood", 2), "neighbourhood", "rank")
    assert top_all == [("n1", 1), ("n1", 2), ("n2", 1), ("n2", 2), ("n3", 1)]
    one = rows(terms.tfidf_top_terms(c, "n2", "neighbourhood", 100), "term")
    assert ("wi-fi",) in one and ("park",) in one


def test_corpus_join(spark):
    lst = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, description string")
    nb = spark.createDataFrame([(1, "n1"), (3, "n3"), (4, "n4")], "id long, neighbourhood string")
    assert rows(terms.listing_corpus(lst, nb)) == [(1, "a", "n1"), (3, "c", "n3")]


def test_single_document_paths_agree(spark):
    c = corpus(spark)
    for mode, value in (("listing", 1), ("listing", 3), ("neighbourhood", "n1"), ("neighbourhood", "n3")):
        key = {"listing": "id"}.get(mode, mode)
        one = rows(terms.tfidf_top_terms(c, value, mode, 50))
        every = rows(terms.tfidf_top_terms_all(c, mode, 50).where(F.col(key) == value), "term", "weight")
        assert one == every, (mode, value)
    # a wordless neighbourhood keeps its single empty token (falls back to the full table)
    assert rows(terms.tfidf_top_terms(c, "n3", "neighbourhood", 5), "term") == [("",)]


def test_a_blank_listing_and_odd_ids(spark):
    import pytest

    c = spark.createDataFrame(
        [(1, " !? ", "n1"), (2, "", "n1"), (3, "loft", "n1"), (4, None, "n1")],
        "id long, description string, neighbourhood string",
    )
    # N = 3 described listings, two of them blank
    assert rows(terms.tfidf_top_terms(c, 1)) == [("", 1.5)]
    for bad in ("\u00b2", "-1", "x"):
        with pytest.raises(ValueError):
            terms.tf_one(c, bad)
