"""Price, review-rate, occupancy and spend statistics by city / room type.

Each is one ``groupBy().agg()``: partial aggregation map-side, one shuffle of
at most (tasks x groups) partial rows. Prices use money form A.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import money_a, nights_per_year


def avg_price_by(listings: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """``(*keys, avg_price)``; unparsable prices are ignored."""
    return listings.groupBy(*keys).agg(F.avg(money_a("price")).alias("avg_price"))


def avg_price_one_city(listings: DataFrame, city: str) -> DataFrame:
    """One row ``(city, avg_price, n_listings)`` for a single city (the filter
    reaches the scan)."""
    return (
        listings.where(F.col("city") == city)
        .agg(F.avg(money_a("price")).alias("avg_price"), F.count(F.lit(1)).alias("n_listings"))
        .select(F.lit(city).alias("city"), "avg_price", "n_listings")
    )


def avg_reviews_by_city(listings: DataFrame) -> DataFrame:
    """Mean monthly reviews per city; a NULL rate counts as 0 (it stays in the
    denominator, unlike a plain ``avg``)."""
    rpm = F.coalesce(F.col("reviews_per_month").cast("double"), F.lit(0.0))
    return listings.groupBy("city").agg(F.avg(rpm).alias("avg_reviews_per_month"))


def avg_nights_per_year_by_city(listings: DataFrame) -> DataFrame:
    """Mean estimated booked nights per year per city."""
    return listings.groupBy("city").agg(F.avg(nights_per_year("reviews_per_month")).alias("avg_nights_per_year"))


def yearly_spend_by_city(listings: DataFrame) -> DataFrame:
    """Total (not mean) estimated yearly guest spend per city: nights x price."""
    spend = nights_per_year("reviews_per_month") * money_a("price")
    return listings.groupBy("city").agg(F.sum(spend).alias("yearly_spend"))


def listing_price_points(listings: DataFrame) -> DataFrame:
    """``(lat, lon, price, name)``: the projection a price map is drawn from
    (write it with ``sources.sinks``; the price stays as text)."""
    return listings.select(
        F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "price", "name"
    )
