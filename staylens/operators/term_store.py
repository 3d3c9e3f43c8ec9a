"""Document frequencies kept as a table and updated by the documents that come and go.

The table has a row ``(term, df)`` for each term that a document holds, and one with a NULL term
whose ``df`` is the number of documents; terms are never NULL, so one table, and one write, holds a
consistent state. An update counts only the documents it is given: the stored rows and the signed
counts of the documents added and removed are summed by term, so its cost is the vocabulary and the
change, not the corpus.

Documents are those of :mod:`staylens.operators.terms` and are given whole: all rows of a listing
id, or all listings of a neighbourhood. A document that changes is removed in its old form and added
in its new one. A document without text is none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators import terms
from staylens.plans.scalars import scalar
from staylens.plans.topk import top_k_per_group


def document_frequencies(corpus: DataFrame, mode: str = "listing") -> DataFrame:
    """``(term, df)`` of a corpus, with the number of its documents in the row of the NULL term
    (0 for an empty corpus)."""
    counts = terms.term_counts(corpus, mode)
    df = counts.groupBy("term").agg(F.count(F.lit(1)).cast("bigint").alias("df"))
    n = terms.n_documents(corpus, mode).select(
        F.lit(None).cast("string").alias("term"), F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("df")
    )
    return df.unionByName(n)


def updated(
    stored: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None, mode: str = "listing"
) -> DataFrame:
    """The stored frequencies after documents were added and removed. Terms that no document holds
    any more go. Write the result to a new place: Spark can't overwrite a table that it reads."""
    changes = [stored.select("term", "df")]
    for corpus, sign in ((added, 1), (removed, -1)):
        if corpus is not None:
            changes.append(
                document_frequencies(corpus, mode).select("term", (F.col("df") * sign).alias("df"))
            )
    total = reduce(DataFrame.unionByName, changes).groupBy("term").agg(F.sum("df").cast("bigint").alias("df"))
    return total.where(F.col("term").isNull() | (F.col("df") != 0))


def checked(stored: DataFrame) -> DataFrame:
    """``stored``; reading it fails where a frequency is below 0 or above the number of documents,
    which shows that documents were removed that had never been added."""
    n = _n_documents(stored)
    wrong = (F.col("df") < 0) | (F.col("term").isNotNull() & (F.col("df") > n))
    told = F.concat(F.lit("no state of a corpus: document frequency "), F.col("df").cast("string"))
    return stored.select("term", F.when(wrong, F.raise_error(told).cast("bigint")).otherwise(F.col("df")).alias("df"))


def _n_documents(stored: DataFrame):
    return scalar(stored.where(F.col("term").isNull()).agg(F.max("df").alias("n")))


def stored_idf(stored: DataFrame) -> DataFrame:
    """``(term, idf)`` with ``idf = N / df``, as :func:`staylens.operators.terms.document_frequency`
    gives it for the whole corpus."""
    n = _n_documents(stored).cast("double")
    return stored.where(F.col("term").isNotNull()).select("term", (n / F.col("df").cast("double")).alias("idf"))


def top_terms_by_stored(documents: DataFrame, stored: DataFrame, mode: str = "listing", k: int = 100) -> DataFrame:
    """``(key, rank, term, weight)``: the top ``k`` terms of each of ``documents`` by the stored
    frequencies. Only ``documents`` are tokenised, which may be a few new ones of a large corpus.
    A term that the table doesn't hold has no weight and no row."""
    key = terms.KEYS[mode]
    tf = terms.term_frequency(terms.term_counts(documents, mode), key)
    w = terms.join_salted(tf, stored_idf(stored), "term", key).select(
        key, "term", (F.col("tf") * F.col("idf")).alias("weight")
    )
    ranked = top_k_per_group(w, [key], [F.desc("weight"), F.asc("term")], k)
    return ranked.select(key, "rank", "term", "weight")
