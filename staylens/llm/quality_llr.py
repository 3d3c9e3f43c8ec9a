"""Quality rules: word statistics of a document, and the log-likelihood ratio of its hashed n-grams.

The ratio compares two multinomials over ``1 << BUCKET_BITS`` hashed word 1- and 2-grams: one counted on a
trusted target (documents that somebody marked as good), one on the whole raw corpus. A document's
score is the sum of ``ln p_target(bucket) - ln p_raw(bucket)`` over its n-grams divided by their
number; every document is held against the same threshold, so the verdict is deterministic.

Only DataFrame expressions are used. The statistics and the score are computed where the text is
read. One shuffle moves the texts: the join that tells which of them are trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import WORD, cut_at_spaces, let, staged, text_or_empty, unique_name, words

BUCKET_BITS = 16
#: Raw occurrences that each bucket gets as a prior, and the target their due share of them, so that
#: a bucket seen a few times says little.
PRIOR = 8.0
#: Mean nats per n-gram below the raw corpus at which a text no longer resembles the target.
MIN_LLR = -0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
#: Columns that ``with_verdict`` adds.
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]


def _windows(h: Column, size: int) -> Column:
    """For each word a hash of the run of ``size`` words from there on, from the hashes ``h`` of the
    words. The last ``size`` - 1 are shorter runs, each of a length of its own, so they equal no other."""
    return F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)]))


def _repeated_cover(windows: Column, size: int) -> Column:
    """How many positions lie in a window of ``size`` that occurs twice or more. Windows are sorted
    as longs: the hash's upper bits, then the position in the bits that the text's length takes;
    equal windows become neighbours."""

    def covered(w: Column, bits: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def by_mask(m: Column) -> Column:
            packed = F.transform(w, lambda h, i: h.bitwiseAND(-1 - m).bitwiseOR(i.cast("long")))

            def positions(s: Column) -> Column:
                def same_as_next(x: Column, j: Column) -> Column:
                    return F.call_function("shiftright", x.bitwiseXOR(F.get(s, j + 1)), bits) == 0

                pairs = F.filter(F.transform(s, lambda x, j: F.when(same_as_next(x, j), j)), lambda j: j.isNotNull())
                places = F.transform(
                    pairs,
                    lambda j: F.struct(
                        F.get(s, j).bitwiseAND(m).cast("int").alias("a"),
                        F.get(s, j + 1).bitwiseAND(m).cast("int").alias("b"),
                    ),
                )
                equal = F.filter(places, lambda p: F.get(w, p["a"]) == F.get(w, p["b"]))
                return F.sort_array(
                    F.array_union(F.transform(equal, lambda p: p["a"]), F.transform(equal, lambda p: p["b"]))
                )

            return let(F.sort_array(packed), positions)

        def length(p: Column) -> Column:
            steps = F.transform(p, lambda x, j: F.least(F.lit(size), x - F.coalesce(F.get(p, j - 1), x - size)))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(mask, by_mask), length)

    bits = F.length(F.bin(F.size(windows).cast("long")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
        let(bits, lambda b: covered(windows, b))
    )


def with_word_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars (code points in words), n_symbols (characters
    of ``SYMBOLS``), n_dup_lines (lines with a word that equal an earlier line), n_repeat_words (words
    in 3-word windows found twice or more) and base_failed. A NULL text counts as empty: all
    counts 0, base_failed true. Windows are compared by their 64-bit hash. Columns of these names
    in ``docs`` are replaced."""
    hashes = unique_name(docs.columns, "_hashes")
    return _counted(docs, text, hashes).drop(hashes)


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _counted(docs: DataFrame, text: str, hashes: str) -> DataFrame:
    """``with_word_stats`` and the column ``hashes`` with the hashes of the words."""
    cut = unique_name([*docs.columns, hashes], "_cut")
    t = text_or_empty(text)
    plain = t
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    return (
        docs.withColumn(cut, cut_at_spaces(t))
        .withColumns(
            {
                hashes: F.transform(F.array_remove(cut, ""), lambda x: F.xxhash64(x)),
                # one piece more than there are spaces
                "word_chars": (F.char_length(t) - F.size(cut) + 1).cast("long"),
                "n_symbols": (F.octet_length(t) - F.octet_length(plain)).cast("long"),
                "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            }
        )
        .withColumn("n_words", F.size(hashes).cast("long"))
        .withColumn("n_repeat_words", let(_windows(F.col(hashes), 3), lambda h: _repeated_cover(h, 3)).cast("long"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .drop(cut)
    )


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int")


def bucket_weights(
    docs: DataFrame, trusted: DataFrame, *, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(bucket, weight): ``ln p_target - ln p_raw`` for each of the ``1 << BUCKET_BITS`` buckets, where
    p_raw is (raw + PRIOR) / (R + PRIOR * buckets) and p_target the same with the target's count
    and its share T / R of the prior. ``trusted`` has the keys of the target's documents; repeated
    and NULL keys in it are ignored. Of an empty corpus all weights are 0."""
    ids = trusted.select(F.col(key).alias("_k")).where("_k is not null").distinct().withColumn("_t", F.lit(1))
    both = docs.select(F.col(key).alias("_k"), text_or_empty(text).alias("_x"))
    # a merge join at every size: labels grow with the documents
    both = both.join(ids.hint("merge"), "_k", "left")
    # pairs by zipping the words with themselves, one on; the last word has no pair
    listed = both.select(words(F.col("_x")).alias("w"), F.coalesce("_t", F.lit(0)).alias("_t"))
    pairs = F.explode(F.arrays_zip(F.col("w"), F.slice("w", F.lit(2), F.size("w")).alias("next")))
    at = listed.select(pairs.alias("p"), "_t").select(
        F.xxhash64("p.w").alias("one"), F.when(F.col("p.next").isNotNull(), F.xxhash64("p.next")).alias("next"), "_t"
    )
    two = F.when(F.col("next").isNotNull(), _bucket(F.xxhash64("one", "next")))
    counted = (
        at.select(F.explode(F.array(_bucket(F.col("one")), two)).alias("bucket"), "_t")
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("_t").alias("target"))
    )
    spark = docs.sparkSession
    every = spark.range(1 << BUCKET_BITS).select(F.col("id").cast("int").alias("bucket"))
    n = staged(every.join(counted, "bucket", "left").fillna(0, ["raw", "target"]), "buckets")

    share = n.agg(F.sum("target") / F.sum("raw")).scalar()
    expected = F.greatest(share, F.lit(1e-9))
    ratio = (F.col("target") + PRIOR * expected) / (expected * (F.col("raw") + PRIOR))
    return n.select("bucket", F.coalesce(F.log(ratio), F.lit(0.0)).alias("weight"))


def with_verdict(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    min_llr: float = MIN_LLR,
) -> DataFrame:
    """``with_word_stats(docs)`` and ``llr``, the length-normalised log-likelihood ratio (NULL for a
    text without words), and ``kept``: the rules hold and ``llr >= min_llr``.

    The weights reach the tasks as one array of ``1 << BUCKET_BITS`` doubles (a scalar subquery)."""
    weights = bucket_weights(docs, trusted, text=text, key=key)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("bucket", "weight"))), lambda x: x["weight"])
    hashes = unique_name(docs.columns, "_hashes")
    stats = _counted(docs, text, hashes)
    table = unique_name(stats.columns, "_weights")

    def mean_weight(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.when(i + 1 < F.size(h), _bucket(F.xxhash64(x, F.get(h, i + 1)))))
        buckets = F.concat(F.transform(h, _bucket), pairs)
        # the only mention of the table, else it would become a column of every row
        total = F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.coalesce(F.get(table, b), F.lit(0.0)))
        return F.when(F.size(h) > 0, total / (2 * F.size(h) - 1))

    # A subquery may not stand in a lambda, but the optimizer moves the column there. The row id (always
    # >= 0) keeps filters on llr or kept above this step; pushed below it, they would copy the array.
    here = F.monotonically_increasing_id() >= 0
    scored = (
        stats.withColumn(table, weights.agg(in_order.alias("w")).scalar())
        .withColumn("llr", F.when(here, mean_weight(F.col(hashes))))
        .drop(table, hashes)
    )
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= min_llr, F.lit(False)))
