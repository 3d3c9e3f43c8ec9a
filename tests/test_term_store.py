"""Stored document frequencies against a recount of the whole corpus."""

import random

import pytest

from listing_rows import rows
from staylens.operators import term_store, terms

SCHEMA = "id long, description string, neighbourhood string"


def _corpus(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _random_listings(seed, n):
    r = random.Random(seed)
    words = ["sunny", "loft", "near", "the", "park", "Ünder", "a-b", "don't", "R&B"] + [f"w{i}" for i in range(30)]
    out = []
    for i in range(n):
        text = " ".join(r.choice(words) for _ in range(r.randint(0, 12))) or r.choice([None, "", " ", "!!"])
        out.append((i, text, r.choice(["x", "y", "z", None])))
    return out


@pytest.mark.parametrize("mode", ["listing", "neighbourhood"])
def test_two_updates_equal_a_recount(spark, tmp_path, mode):
    data = _random_listings(5, 120)
    if mode == "neighbourhood":  # whole neighbourhoods come and go
        data = [(i, t, f"n{i % 9}" if i % 9 else None) for i, t, _ in data]
        parts = [[d for d in data if d[0] % 9 in kept] for kept in ((0, 1, 2, 3, 4), (5, 6), (7, 8))]
    else:
        parts = [data[:70], data[70:100], data[100:]]
    first, second, third = parts
    gone = [d for d in first if d[0] % 9 in (0, 2)]
    path = str(tmp_path / "df")
    term_store.document_frequencies(_corpus(spark, first), mode).write.parquet(path + "0")
    stored = spark.read.parquet(path + "0")
    term_store.updated(stored, added=_corpus(spark, second), mode=mode).write.parquet(path + "1")
    stored = spark.read.parquet(path + "1")
    term_store.updated(stored, _corpus(spark, third), _corpus(spark, gone), mode).write.parquet(path + "2")
    stored = term_store.checked(spark.read.parquet(path + "2"))
    now = _corpus(spark, [d for d in data if d not in gone])
    assert rows(stored) == rows(term_store.document_frequencies(now, mode))
    whole = terms.document_frequency(now, mode).select("term", "idf")
    assert rows(term_store.stored_idf(stored)) == rows(whole)
    assert rows(term_store.top_terms_by_stored(now, stored, mode, 3)) == rows(terms.tfidf_top_terms_all(now, mode, 3))


def test_all_documents_gone_and_empty_tables(spark):
    corpus = _corpus(spark, _random_listings(6, 20))
    empty = _corpus(spark, [])
    none = term_store.document_frequencies(empty)
    assert rows(none) == [(None, 0)]
    stored = term_store.document_frequencies(corpus)
    assert rows(term_store.updated(stored, removed=corpus)) == [(None, 0)]
    assert rows(term_store.updated(none, added=corpus)) == rows(stored)
    assert rows(term_store.updated(stored, empty, empty)) == rows(stored)
    assert term_store.stored_idf(none).collect() == []
    assert term_store.top_terms_by_stored(empty, stored).collect() == []


def test_removing_what_was_never_added_is_told(spark):
    stored = term_store.document_frequencies(_corpus(spark, [(1, "a b", "x"), (2, "b", "x")]))
    wrong = term_store.updated(stored, removed=_corpus(spark, [(3, "c", "x")]))
    with pytest.raises(Exception, match="no state of a corpus"):
        term_store.checked(wrong).collect()
    assert rows(term_store.checked(stored)) == rows(stored)


def test_an_update_reads_the_change_only(spark, tmp_path):
    path = str(tmp_path / "df")
    term_store.document_frequencies(_corpus(spark, _random_listings(7, 50))).write.parquet(path)
    plan = term_store.updated(spark.read.parquet(path), _corpus(spark, [(99, "new words", "x")]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1
