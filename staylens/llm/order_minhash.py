"""Document fingerprints by order MinHash.

The k-mers of a text (runs of ``K`` words, shorter at its end) are numbered by occurrence and hashed. The hash's first
bits deal them to ``BINS`` bins; in each bin the ``TUPLE`` smallest are kept, put back into the order
in which they stand in the text, and hashed as a tuple. Two fingerprints agree in a bin only if the
same k-mers are smallest there and stand in the same order, so their likeness follows the edit
distance rather than the shared vocabulary.

Only DataFrame expressions are used; a fingerprint is computed where the text is, in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import let, text_or_empty, words

K = 2
TUPLE = 2
BIN_BITS = 6
#: Documents whose ids share all but so many low bits are neighbours in one task.
BLOCK_BITS = 10


def _kmers(w: Column, k: int) -> Column:
    """For each word a hash of the run of k words from there on; the last k - 1 runs are shorter."""
    return F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)]))


def _places(flags: Column) -> Column:
    return F.filter(flags, lambda j: j.isNotNull())


def _repeats(h: Column) -> Column:
    """(h, i) for each k-mer that stood in the text before: a hash of the k-mer and its occurrence, and
    its place. K-mers are sorted as longs, the upper bits of the hash before the place, so that the
    occurrences of one become neighbours in the order of the text."""

    def numbered(bits: Column) -> Column:
        def by_mask(m: Column) -> Column:
            packed = F.transform(h, lambda x, i: x.bitwiseAND(-1 - m).bitwiseOR(i.cast("long")))

            def occurrences(s: Column) -> Column:
                def again(x: Column, j: Column) -> Column:
                    return F.call_function("shiftright", x.bitwiseXOR(F.get(s, j - 1)), bits) == 0

                def place(j: Column) -> Column:
                    return F.get(s, j).bitwiseAND(m).cast("int")

                def runs(d: Column) -> Column:
                    """``d``: where in ``s`` a k-mer equals the one before; neighbours are a run."""
                    first = _places(
                        F.transform(d, lambda j, t: F.when(F.coalesce(F.get(d, t - 1) != j - 1, F.lit(True)), t))
                    )

                    def run(begin: Column, end: Column) -> Column:
                        return F.transform(
                            F.slice(d, begin + 1, end - begin),
                            lambda j, o: F.struct(
                                F.xxhash64(F.get(h, place(j)), o + 1).alias("h"), place(j).alias("i")
                            ),
                        )

                    return let(
                        first,
                        lambda b: F.flatten(F.transform(b, lambda at, r: run(at, F.coalesce(F.get(b, r + 1), F.size(d))))),
                    )

                return let(_places(F.transform(s, lambda x, j: F.when(again(x, j), j))), runs)

            return let(F.sort_array(packed), occurrences)

        return let(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, by_mask)

    none = F.array().cast("array<struct<h:bigint,i:int>>")
    some = let(F.length(F.bin(F.size(h).cast("long"))), numbered)
    return F.when(F.size(F.array_distinct(h)) < F.size(h), some).otherwise(none)


def fingerprint(text: Column, *, k: int = K, size: int = TUPLE, bin_bits: int = BIN_BITS) -> Column:
    """Array of longs, one for each bin with a k-mer: the bin times 2**32, plus 32 bits of the hash
    of its tuple. Empty without words."""

    def bin_of(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - bin_bits)

    def other_bin(x: Column, y: Column) -> Column:
        """Whether two hashes lie in different bins; a NULL lies in none."""
        return bin_of(x.bitwiseXOR(F.coalesce(y, F.bitwise_not(x)))) != 0

    def smallest(h: Column) -> Column:
        """(h, i) of the smallest first occurrences of each bin, with their place."""
        chosen = let(
            F.sort_array(F.array_distinct(h)),
            lambda s: F.filter(s, lambda x, j: other_bin(x, F.get(s, j - size))),
        )
        return F.transform(
            chosen, lambda x: F.struct(x.alias("h"), (F.array_position(h, x) - 1).cast("int").alias("i"))
        )

    def of_each_bin(s: Column) -> Column:
        return F.filter(s, lambda e, j: other_bin(e["h"], F.get(s, j - size)["h"]))

    def tuples(chosen: Column) -> Column:
        first = _places(
            F.transform(chosen, lambda e, j: F.when(other_bin(e["h"], F.get(chosen, j - 1)["h"]), j))
        )

        def token(j: Column) -> Column:
            own = bin_of(F.get(chosen, j)["h"])
            members = F.filter(F.slice(chosen, j + 1, size), lambda e: bin_of(e["h"]) == own)
            in_order = F.sort_array(F.transform(members, lambda e: F.struct(e["i"].alias("i"), e["h"].alias("h"))))
            tuple_hash = F.xxhash64(F.transform(in_order, lambda e: e["h"]))
            return own * F.lit(1 << 32) + F.shiftrightunsigned(tuple_hash, 32)

        return F.transform(first, token)

    def sketch(h: Column) -> Column:
        return let(let(F.sort_array(F.concat(smallest(h), _repeats(h))), of_each_bin), tuples)

    return let(let(words(text), lambda w: _kmers(w, k)), sketch)


def as_text(fp: Column) -> Column:
    """Ten hex digits for each bin with a k-mer: the bin in two, its tuple in eight."""
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among the bins that either fingerprint has; 1 for two empty ones."""

    def bins(fp: Column) -> Column:
        return F.transform(fp, lambda x: F.shiftright(x, 32))

    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either > 0, F.size(F.array_intersect(a, b)) / either).otherwise(1.0)


def _following_block(blocks: DataFrame) -> DataFrame:
    """(block, following): the next larger block, the smallest for the largest. Two levels, so that
    no window holds all blocks."""
    upper = blocks.withColumn("upper", F.shiftright("block", 20))
    tops = upper.groupBy("upper").agg(F.min("block").alias("first"))
    every = Window.partitionBy(F.lit(0))
    tops = tops.select(
        "upper", F.coalesce(F.lead("first").over(every.orderBy("upper")), F.min("first").over(every)).alias("next_first")
    )
    within = F.lead("block").over(Window.partitionBy("upper").orderBy("block"))
    return (
        upper.withColumn("within", within)
        .join(tops, "upper")
        .select("block", F.coalesce("within", "next_first").alias("following"))
    )


def with_next(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, text, fp, next_text, next_fp): each document with its fingerprint, and text and
    fingerprint of the next by ascending id (after the last: the first; a NULL id comes first, rows
    that repeat an id in the order of their texts). The text moves in one shuffle, by blocks of ids;
    the last of a block finds the next block's first by a join of one row for each block."""
    t = text_or_empty(text)
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("place"),
        t.alias("text"),
    ).withColumn("block", F.shiftright("place", BLOCK_BITS))
    heads = rows.groupBy("block").agg(F.min(F.struct("place", "text")).alias("head"))
    nexts = (
        _following_block(rows.select("block").distinct())
        .join(heads.select(F.col("block").alias("following"), F.col("head.text").alias("head")), "following")
        .select("block", "head", fingerprint(F.col("head")).alias("head_fp"))
    )
    in_block = Window.partitionBy("block").orderBy("place", "text")
    led = rows.withColumn("fp", fingerprint(F.col("text"))).select(
        "id",
        "text",
        "fp",
        "block",
        F.lead("text").over(in_block).alias("lead_text"),
        F.lead("fp").over(in_block).alias("lead_fp"),
    )
    return led.join(nexts, "block").select(
        "id",
        "text",
        "fp",
        F.coalesce("lead_text", "head").alias("next_text"),
        F.coalesce("lead_fp", "head_fp").alias("next_fp"),
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text whose last floor(n/2) code points are replaced by the first as many of the next."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def edit_check(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of all texts and their edited forms: (key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next). A NULL text counts as empty."""
    both = with_next(docs, text=text, key=key).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    both = both.withColumn("edited_fp", fingerprint(F.col("edited")))
    return both.select(
        F.col("id").alias(key),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
