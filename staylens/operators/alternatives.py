"""Alternative listings: same room type, cheaper than a cap, available on a
date, within a radius, ranked by amenities shared with a chosen listing.

The chosen listing is a one-row lookup (``limit(1)`` after an id filter)
evaluated once as a scalar subquery; its fields are plain values in the
candidate filters, so no join is needed to compare against it.
Availability is a left-semi join with the calendar rows of that date (the
date filter reaches the scan; the semi join de-duplicates repeated calendar
rows). Distance and shared amenities are native expressions; the final top-n
is a ``TakeOrderedAndProject``. No row leaves the executors before the result.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.columns import EARTH_RADIUS_KM
from staylens.functions import amenity_list, count_found_in, haversine_km, money_b
from staylens.plans.scalars import scalar_row
from staylens.plans.topk import top_k
from staylens.sources.stored import near


def _as_date(date):
    return dt.date.fromisoformat(date) if isinstance(date, str) else date


def listing_profile(listings: DataFrame, listing_id: int) -> DataFrame:
    """At most one row ``(id, latitude, longitude, price, room_type, amenities)``
    for the chosen listing: price in money form B, amenities cleaned into a
    list. Listings without amenities are skipped; an unknown id gives no row."""
    chosen = listings.where((F.col("id") == F.lit(listing_id)) & F.col("amenities").isNotNull())
    prof = chosen.select(
        "id",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        money_b("price").alias("price"),
        "room_type",
        amenity_list("amenities").alias("amenities"),
    )
    # a total order, so a re-executed task picks the same row among duplicates
    return prof.orderBy("latitude", "longitude", "price", "room_type", "amenities").limit(1)


def _chosen(listings: DataFrame, listing_id: int):
    """The chosen listing's profile as a struct column (a scalar subquery)."""
    return scalar_row(listing_profile(listings, listing_id))


def available_on_date(calendar: DataFrame, date) -> DataFrame:
    """``(listing_id)`` of calendar rows marked available (``'t'``) on ``date``;
    repeated calendar rows are kept."""
    return calendar.where((F.col("available") == "t") & (F.col("date") == F.lit(_as_date(date)))).select(
        "listing_id"
    )


def distance_from_listing(listings: DataFrame, listing_id: int) -> DataFrame:
    """``(id, distance_km)`` from the chosen listing to every listing."""
    lst = listings.select("id", F.col("latitude").cast("double"), F.col("longitude").cast("double"))
    lst = lst.withColumn("_c", _chosen(listings, listing_id))
    return lst.select("id", haversine_km("_c.latitude", "_c.longitude", "latitude", "longitude").alias("distance_km"))


def common_amenities_with(listings: DataFrame, listing_id: int) -> DataFrame:
    """``(id, common_amenities)`` for every listing with amenities: how many of
    its (cleaned) amenity tokens occur in the chosen listing's list; repeated
    tokens each count."""
    lst = listings.where(F.col("amenities").isNotNull()).select("id", amenity_list("amenities").alias("amen"))
    # bind the subquery to a column once (it may not appear inside a lambda)
    lst = lst.withColumn("_c", _chosen(listings, listing_id))
    return lst.select("id", count_found_in("amen", "_c.amenities").alias("common_amenities"))


def alternative_listings(
    listings: DataFrame,
    calendar: DataFrame,
    listing_id: int,
    date,
    max_price_increase_pct: float,
    max_km: float,
    n: int,
    include_self: bool = False,
    wide: bool = False,
) -> DataFrame:
    """Top ``n`` alternatives to ``listing_id`` on ``date``.

    Candidates have the chosen room type, price <= chosen price x (1 + pct/100)
    (inclusive), a calendar row available on the date and distance < ``max_km``
    (strict). Ranked by common amenities desc, then distance, then id.
    The chosen listing itself is excluded unless ``include_self`` (the surveyed
    script kept it and returned n + 1 rows).

    Output ``(listing_id, name, common_amenities, distance, price)``; ``wide``
    adds ``latitude, longitude, host_name, review_scores_rating`` (map export).
    """
    extra = ["host_name", "review_scores_rating"] if wide else []
    cand = listings.where(F.col("amenities").isNotNull()).select(
        F.col("id").alias("listing_id"),
        "name",
        "room_type",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        money_b("price").alias("price"),
        amenity_list("amenities").alias("amen"),
        *extra,
    )
    if not include_self:
        cand = cand.where(F.col("listing_id") != F.lit(listing_id))
    avail = available_on_date(calendar, date)
    cand = cand.join(avail, cand.listing_id == avail.listing_id, "left_semi")
    # the chosen row is bound to one column (a single subquery reference; it
    # may not appear inside the amenity lambda either)
    j = cand.withColumn("_c", _chosen(listings, listing_id))
    cap = F.col("_c.price") * (F.lit(1.0) + F.lit(float(max_price_increase_pct)) / F.lit(100.0))
    j = j.where((F.col("room_type") == F.col("_c.room_type")) & (F.col("price") <= cap))
    # a degree of latitude is the same length everywhere; half a per cent of slack for rounding
    degrees = float(max_km) / (math.radians(1.0) * EARTH_RADIUS_KM) * 1.005
    j = j.where(F.abs(F.col("latitude") - F.col("_c.latitude")) <= F.lit(degrees))
    j = j.withColumn("distance", haversine_km("_c.latitude", "_c.longitude", "latitude", "longitude"))
    j = j.where(F.col("distance") < F.lit(float(max_km)))
    j = j.withColumn("common_amenities", count_found_in("amen", "_c.amenities"))
    cols = ["listing_id", "name", "common_amenities", "distance", "price"]
    if wide:
        cols += ["latitude", "longitude", "host_name", "review_scores_rating"]
    return top_k(j, [F.desc("common_amenities"), F.asc("distance"), F.asc("listing_id")], n + int(include_self)).select(
        *cols
    )


def alternative_listings_near(
    stored: DataFrame,
    calendar: DataFrame,
    listing_id: int,
    date,
    max_price_increase_pct: float,
    max_km: float,
    n: int,
    **options,
) -> DataFrame:
    """:func:`alternative_listings` over listings stored with cells (``staylens.sources.stored``): the same rows,
    from the files and row groups around the chosen listing.

    Its place has to be a literal for the scan to prune by it, so this operator looks up that one row (at most one is
    fetched) while the query is built. An unknown listing, or one without a place, gives no row."""
    place = listing_profile(stored, listing_id).select("latitude", "longitude").collect()
    known = place and None not in tuple(place[0])
    around = near(stored, place[0]["latitude"], place[0]["longitude"], float(max_km)) if known else stored.where(F.lit(False))
    return alternative_listings(around, calendar, listing_id, date, max_price_increase_pct, max_km, n, **options)
