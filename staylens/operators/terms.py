"""Description terms: tokenising, document frequency, TF, TF-IDF top terms.

A "document" is a listing (``mode='listing'``, key ``id``) or all listings of
a neighbourhood (``mode='neighbourhood'``). The weight of a term in a document
is ``tf * idf`` with ``tf = count / tokens in the document`` and
``idf = N / df`` (no logarithm), ``df`` = documents containing the term.
``N`` is the number of corpus rows in listing mode and the number of distinct
neighbourhoods in neighbourhood mode.

Neighbourhood documents are the multiset union of their listings' tokens (the
surveyed code concatenated descriptions in arbitrary order, which fused the
words at the seams; the union is the order-free equivalent). Empty tokens
from blank descriptions vanish in that union, except that a neighbourhood
with no token at all keeps one empty token, as the concatenation would.

Scale: token rows are reduced to (document, term, count) by a partial +
final aggregation before any join; document totals and term frequencies are
aggregates joined back on their key (no window over a whole document, no
global sort); corpus-wide scalars are scalar subqueries over one-row
aggregates; top-k uses ``row_number() <= k`` (``WindowGroupLimit``) or
``TakeOrderedAndProject``. Joins whose key can be hot (a term that is in every
document, a neighbourhood with a third of the listings) are salted, always:
AQE does not split a join with an aggregate right under it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import text_tokens
from staylens.plans.scalars import scalar
from staylens.plans.topk import top_k, top_k_per_group

KEYS = {"listing": "id", "neighbourhood": "neighbourhood"}
# Salts of a join whose key can be hot: the large side's rows of a key go to so
# many partitions, the small side has each row so many times
SALTS = 8
# Terms whose document frequency every task is given: the most frequent ones
COMMON_TERMS = 65536
# Salts of the join of all other terms; none of those is hot
RARE_SALTS = 2
# A text has a word if it has a token character (see functions.columns)
_HAS_WORD = r"(?i)[0-9a-z'\-&\u0130\u212a]"


def listing_corpus(listings: DataFrame, neighbourhood_map: DataFrame) -> DataFrame:
    """Listings with a description, joined to their neighbourhood on ``id``."""
    return listings.dropna(subset=["description"]).join(neighbourhood_map, "id", "inner")


def _raw_counts(corpus: DataFrame, key: str, only_terms: DataFrame | None = None) -> DataFrame:
    toks = corpus.where(F.col("description").isNotNull()).select(
        key, F.explode(text_tokens("description")).alias("term")
    )
    # tokens are never NULL; stating it keeps every reference to these counts
    # identical after filter inference, so Spark computes them once and
    # reuses the exchange
    toks = toks.where(F.col("term").isNotNull())
    if only_terms is not None:
        toks = toks.join(only_terms, "term", "left_semi")
    return toks.groupBy(key, "term").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def join_salted(left: DataFrame, right: DataFrame, key: str, spread_by: str, n_salts: int = SALTS) -> DataFrame:
    """Inner join of a large side with one row per key, NULL keys matching each
    other. A key's rows of the large side are dealt to ``n_salts`` partitions by
    ``spread_by``; the small side is repeated for each."""
    l = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(n_salts)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1)))
    r = right.withColumnRenamed(key, "_k").withColumn("_s", salts)
    on = l[key].eqNullSafe(r["_k"]) & (l["_salt"] == r["_s"])
    return l.join(r, on, "inner").drop("_k", "_s", "_salt")


def term_counts(corpus: DataFrame, mode: str = "listing", only_terms: DataFrame | None = None) -> DataFrame:
    """``(key, term, n)``: occurrences of each term per document.

    ``only_terms`` (distinct terms) restricts the result to those; tokens are
    filtered before they are counted."""
    key = KEYS[mode]
    if mode == "listing":
        return _raw_counts(corpus, key, only_terms)
    # neighbourhood documents have no empty token unless the document has no word
    words = _raw_counts(corpus, key, only_terms).where(F.col("term") != "")
    has_word = F.rlike("description", F.lit(_HAS_WORD))
    wordless = (
        corpus.where(F.col("description").isNotNull())
        .groupBy(key)
        .agg(F.bool_or(has_word).alias("_any"))
        .where(~F.col("_any"))
        .select(key, F.lit("").alias("term"), F.lit(1).cast("bigint").alias("n"))
    )
    return words.unionByName(wordless)


def n_documents(corpus: DataFrame, mode: str) -> DataFrame:
    key = KEYS[mode]
    if mode == "listing":
        n = F.count(F.lit(1))
    else:  # distinct neighbourhoods, NULL counted as one
        n = F.count_distinct(F.col(key)) + F.max(F.when(F.col(key).isNull(), 1).otherwise(0))
    return corpus.where(F.col("description").isNotNull()).agg(n.cast("double").alias("n_docs"))


def document_frequency(corpus: DataFrame, mode: str = "listing", counts: DataFrame | None = None) -> DataFrame:
    """``(term, df, idf)`` with ``idf = N / df``.

    ``df`` is a count of (document, term) pairs, which ``term_counts`` already
    made distinct; the count per term is partially aggregated map-side, so a
    term occurring everywhere is never gathered whole."""
    counts = counts if counts is not None else term_counts(corpus, mode)
    # n >= 1 on every row, so this counts rows; referencing n keeps the counts
    # subtree identical to the tf side's (a plain count would let the optimizer
    # prune n), so the tokenising stage runs once and its exchange is reused
    df = counts.groupBy("term").agg(F.count_if(F.col("n") > 0).cast("bigint").alias("df"))
    n_docs = scalar(n_documents(corpus, mode))
    return df.select("term", "df", (n_docs / F.col("df").cast("double")).alias("idf"))


def idf_by_neighbourhood(corpus: DataFrame) -> DataFrame:
    """``(term, idf)`` over neighbourhood documents."""
    return document_frequency(corpus, "neighbourhood").select("term", "idf")


def idf_by_listing(corpus: DataFrame) -> DataFrame:
    """``(term, idf)`` over listing documents."""
    return document_frequency(corpus, "listing").select("term", "idf")


def term_frequency(counts: DataFrame, key: str) -> DataFrame:
    """``(key, term, n, total, tf)`` from term counts: document totals are an
    aggregate joined back on the key."""
    totals = counts.groupBy(key).agg(F.sum("n").alias("total"))
    return join_salted(counts, totals, key, "term").withColumn(
        "tf", F.col("n").cast("double") / F.col("total").cast("double")
    )


def tf_one(corpus: DataFrame, value, mode: str = "listing") -> DataFrame:
    """``(term, tf)`` of one document (a listing id or a neighbourhood)."""
    key = KEYS[mode]
    if mode == "listing" and not (str(value).isascii() and str(value).isdigit()):
        raise ValueError(f"listing id must be a non-negative integer, got {value!r}")
    one = corpus.where(F.col(key) == F.lit(value))
    counts = term_counts(one, mode)
    total = scalar(counts.agg(F.sum("n").cast("double").alias("total")))
    return counts.select("term", (F.col("n").cast("double") / total).alias("tf"))


def tfidf_top_terms(corpus: DataFrame, value, mode: str = "listing", k: int = 100) -> DataFrame:
    """``(term, weight)``: the ``k`` highest-weighted terms of one document
    (weight desc, term asc). An unknown document gives an empty result.

    Listing mode: only the listing's own terms need a document frequency, so
    the corpus tokens are semi-joined with them before they are counted. Which
    side Spark broadcasts, if any, is its own decision from measured sizes.

    Neighbourhood mode: a neighbourhood's vocabulary is a large share of the
    corpus vocabulary and the (neighbourhood, term) table is already compact,
    so tf and df both read one (neighbourhood, term, count) table."""
    if mode == "listing":
        tf = tf_one(corpus, value, mode)
        idf = document_frequency(corpus, mode, term_counts(corpus, mode, only_terms=tf.select("term")))
    else:
        counts = term_counts(corpus, mode)
        one = counts.where(F.col(KEYS[mode]) == F.lit(value))
        total = scalar(one.agg(F.sum("n").cast("double").alias("total")))
        tf = one.select("term", (F.col("n").cast("double") / total).alias("tf"))
        idf = document_frequency(corpus, mode, counts)
    w = tf.join(idf, "term", "inner").select("term", (F.col("tf") * F.col("idf")).alias("weight"))
    return top_k(w, [F.desc("weight"), F.asc("term")], k)


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """``(key, total, term, n)`` from rows ``(key, _t)`` with sorted tokens, each row for itself: the runs of its tokens.
    A column for each step, as an expression inside a function would be computed for each element; there is a token in each
    row, and without the outer form Spark infers a filter that brings the steps together again."""
    place = F.sequence(F.lit(0), F.size("_t") - 1)
    last = F.filter(place, lambda i: F.get("_t", i).eqNullSafe(F.get("_t", i + 1)) == F.lit(False))
    rows = rows.select(key, "_t", last.alias("_ends"))
    runs = F.transform(
        "_ends",
        lambda e, j: F.struct(
            F.get("_t", e).alias("term"),
            (e - F.when(j == 0, -1).otherwise(F.get("_ends", j - 1))).cast("bigint").alias("n"),
        ),
    )
    return rows.select(key, F.size("_t").alias("total"), runs.alias("_runs")).select(key, "total", F.inline_outer("_runs"))


def _top_terms_of_listings(corpus: DataFrame, k: int) -> DataFrame:
    """``tfidf_top_terms_all`` for listings. A text that is the only one of its id is counted within its row, so the
    texts and not their terms are shuffled by id. The frequencies of the ``COMMON_TERMS`` most frequent terms are
    known in each task, where only a listing's best ``k`` of them stay; those and its rarer terms are joined with
    their frequencies. Ids of several texts are counted by ``term_counts``."""
    key = KEYS["listing"]
    rows = corpus.where(F.col("description").isNotNull()).select(key, "description")
    rows = rows.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(key)))
    tokens = rows.where("_rows = 1").select(key, F.sort_array(text_tokens("description")).alias("_t"))
    counted = _counted(tokens, key)
    alone = counted.select(key, "term", (F.col("n").cast("double") / F.col("total").cast("double")).alias("tf"))
    several = term_frequency(term_counts(rows.where("_rows > 1")), key).select(key, "term", "tf")
    df = alone.select("term").unionAll(several.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_docs = scalar(n_documents(corpus, "listing"))
    idf = df.select("term", (n_docs / F.col("df").cast("double")).alias("idf"))
    common = top_k(idf, [F.asc("idf"), F.asc("term")], COMMON_TERMS).withColumnsRenamed({"term": "_term", "idf": "_idf"})
    known = alone.join(F.broadcast(common), F.col("term") == F.col("_term"), "left").select(
        key, "term", "tf", (F.col("tf") * F.col("_idf")).alias("_w")
    )
    best = Window.partitionBy(key, F.col("_w").isNull()).orderBy(F.desc("_w"), F.asc("term"))
    known = known.withColumn("_r", F.row_number().over(best)).where(F.col("_w").isNull() | (F.col("_r") <= k))
    w = join_salted(known.select(key, "term", "tf").unionAll(several), idf, "term", key, RARE_SALTS).select(
        key, "term", (F.col("tf") * F.col("idf")).alias("weight")
    )
    ranked = top_k_per_group(w, [key], [F.desc("weight"), F.asc("term")], k)
    return ranked.select(key, "rank", "term", "weight")


def tfidf_top_terms_all(corpus: DataFrame, mode: str = "listing", k: int = 100) -> DataFrame:
    """``(key, rank, term, weight)``: the top ``k`` terms of every document at
    once (the same weights as ``tfidf_top_terms``, one pass for all keys). Up to
    k = 1000 (Spark's windowGroupLimitThreshold) at most k rows a document leave
    a task; beyond it a document's terms are ranked after one shuffle."""
    if mode == "listing":
        return _top_terms_of_listings(corpus, k)
    key = KEYS[mode]
    counts = term_counts(corpus, mode)
    tf = term_frequency(counts, key)
    idf = document_frequency(corpus, mode, counts)
    w = join_salted(tf, idf.select("term", "idf"), "term", key).select(
        key, "term", (F.col("tf") * F.col("idf")).alias("weight")
    )
    ranked = top_k_per_group(w, [key], [F.desc("weight"), F.asc("term")], k)
    return ranked.select(key, "rank", "term", "weight")
