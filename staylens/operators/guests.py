"""Guest (reviewer) statistics: reviews per city, top guests, spend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import money_a
from staylens.plans.topk import top_k, top_k_per_group

# Fixed value: each review stands for a stay of this many nights
NIGHTS_PER_REVIEW = 3.0
# Tasks of a sum by (reviewer, listing) for each shuffle partition of the session
TASKS_PER_PARTITION = 4


def _reviews_with_listing(reviews: DataFrame, listings: DataFrame, cols: list[str]) -> DataFrame:
    lst = listings.select("id", *cols)
    return reviews.join(lst, reviews.listing_id == lst.id, "inner")


def reviews_by_city_guest(reviews: DataFrame, listings: DataFrame) -> DataFrame:
    """``(city, reviewer_id, n_reviews)``: reviews joined to their listing's city."""
    j = _reviews_with_listing(reviews, listings, ["city"])
    return j.groupBy("city", "reviewer_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_reviews"))


def top_guests_by_city(reviews: DataFrame, listings: DataFrame, k: int = 3) -> DataFrame:
    """``(city, guest_1 .. guest_k)``: the k most frequent reviewers per city
    (count desc, reviewer_id asc); a city with fewer than k guests gets NULLs."""
    counts = reviews_by_city_guest(reviews, listings)
    ranked = top_k_per_group(counts, ["city"], [F.desc("n_reviews"), F.asc("reviewer_id")], k)
    return ranked.groupBy("city").agg(
        *[F.max(F.when(F.col("rank") == i, F.col("reviewer_id"))).alias(f"guest_{i}") for i in range(1, k + 1)]
    )


def spend_by_guest_listing(reviews: DataFrame, listings: DataFrame) -> DataFrame:
    """``(reviewer_id, listing_id, spend)``: each review = price x 3 nights.

    Nearly every review is a group of its own, and join and sum share a task. AQE merges partitions by their compressed
    bytes (ten a review) while a task holds thirty times as much, so the number of partitions is stated."""
    tasks = TASKS_PER_PARTITION * int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reviews = reviews.repartition(tasks, "listing_id")
    j = _reviews_with_listing(reviews, listings, ["price"])
    return j.groupBy("reviewer_id", "listing_id").agg(
        F.sum(money_a("price") * F.lit(NIGHTS_PER_REVIEW)).alias("spend")
    )


def spend_by_guest(reviews: DataFrame, listings: DataFrame) -> DataFrame:
    """``(reviewer_id, spend)``: the two-level sum collapsed into one ``groupBy``."""
    j = _reviews_with_listing(reviews, listings, ["price"])
    return j.groupBy("reviewer_id").agg(F.sum(money_a("price") * F.lit(NIGHTS_PER_REVIEW)).alias("spend"))


def biggest_spender(reviews: DataFrame, listings: DataFrame) -> DataFrame:
    """The top spender ``(reviewer_id, spend)`` (ties: smallest reviewer_id)."""
    return top_k(spend_by_guest(reviews, listings), [F.desc("spend"), F.asc("reviewer_id")], 1)
