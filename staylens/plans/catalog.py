"""Runnable queries over the driver's test tables: key -> f(spark, sf_dir) -> DataFrame.

Each entry wires the test-table adapters (``staylens.sources.testdata``) into
one operator. Every query reads whole tables; parameters such as the chosen
listing or date are the query's own arguments, not row caps. Floating-point
results are rounded here (and identically in ``staylens.plans.oracle``) so the
cross-engine comparison is insensitive to summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.operators import alternatives, alternatives_all, guests, hosts, pricing, profile, spatial, term_store, terms
from staylens.sources.readers import features_from_text
from staylens.sources.stored import with_cell
from staylens.sources.testdata import TestTables

# ---------------------------------------------------------------------------
# Fixed parameters of the registered queries
# ---------------------------------------------------------------------------
ONE_CITY = "1-URGENT"
CHOSEN_LISTING = 1
AVAILABLE_DATE = "1995-08-09"
MAX_PRICE_INCREASE_PCT = 30.0
MAX_KM = 20.0
N_ALTERNATIVES = 10
TFIDF_LISTING = 42
TFIDF_NEIGHBOURHOOD = "src3"
TOP_TERMS = 100
TOP_TERMS_ALL = 20
# rounding of reported doubles: averages / distances / weights, money sums
FINE, MONEY = 6, 2
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, digits: int) -> DataFrame:
    """Round every double column of ``df`` to ``digits`` decimals."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


ALL_LISTING_EXTRAS = ("host_listings_count", "reviews_per_month", "amenities")


def _assigned(t: TestTables, first_ring_only: bool = False) -> DataFrame:
    edges = spatial.polygon_edges(t.features(), first_ring_only=first_ring_only)
    return spatial.assign_neighbourhood(t.listing_points(), edges, keep=("city",))


def _with_amenities(t: TestTables) -> DataFrame:
    edges = spatial.polygon_edges(t.features())
    return spatial.assign_neighbourhood(t.listing_points(amenities=True), edges, keep=("city", "amenities"))


def _listed(df: DataFrame, column: str) -> DataFrame:
    """An array of numbers as comma-separated text."""
    return df.withColumn(column, F.array_join(F.transform(column, lambda x: x.cast("string")), ","))


_OVER_TABLES: dict[str, Callable[[TestTables], DataFrame]] = {
    # -- profile ----------------------------------------------------------
    "profile_distinct_ci": lambda t: profile.profile_distinct_ci(t.listings(ALL_LISTING_EXTRAS)),
    # the sketch, held against the exact counts
    "profile_distinct_approx": lambda t: profile.profile_distinct_approx_check(t.listings(ALL_LISTING_EXTRAS)),
    # the estimates alone, from sketches of the listings of each city
    "profile_distinct_merged": lambda t: profile.merged_profile(
        profile.profile_sketches(t.listings(ALL_LISTING_EXTRAS), ["city"])
    ),
    "distinct_cities": lambda t: profile.distinct_values(t.listings(), "city"),
    "distinct_states_normalised": lambda t: profile.distinct_normalised(t.listings(), "city"),
    # -- pricing ----------------------------------------------------------
    "avg_price_by_city": lambda t: _round(pricing.avg_price_by(t.listings(), ["city"]), FINE),
    "avg_price_one_city": lambda t: _round(pricing.avg_price_one_city(t.listings(), ONE_CITY), FINE),
    "avg_price_by_city_room": lambda t: _round(
        pricing.avg_price_by(t.listings(), ["city", "room_type"]), FINE
    ),
    "avg_reviews_by_city": lambda t: _round(
        pricing.avg_reviews_by_city(t.listings(("reviews_per_month",))), FINE
    ),
    "avg_nights_per_year_by_city": lambda t: _round(
        pricing.avg_nights_per_year_by_city(t.listings(("reviews_per_month",))), FINE
    ),
    "yearly_spend_by_city": lambda t: _round(
        pricing.yearly_spend_by_city(t.listings(("reviews_per_month",))), MONEY
    ),
    # -- hosts ------------------------------------------------------------
    "listings_per_host": lambda t: _round(hosts.listings_per_host(t.listings()), FINE),
    "multi_listing_ratio_rows": lambda t: _round(
        hosts.multi_listing_ratio_rows(t.listings(("host_listings_count",))), FINE
    ),
    "multi_listing_host_share": lambda t: _round(
        hosts.multi_listing_host_share(t.listings(("host_listings_count",))), FINE
    ),
    "booked_nights_by_listing": lambda t: hosts.booked_nights_by_listing(t.listings(), t.calendar()),
    "host_income_by_city": lambda t: _round(
        hosts.host_income_by_city(t.listings(), t.calendar()), MONEY
    ),
    "top_hosts_by_city": lambda t: _round(
        hosts.top_hosts_by_city(t.listings(), t.calendar(), k=3), MONEY
    ),
    "top_hosts_by_city_lists": lambda t: _listed(
        hosts.top_hosts_by_city(t.listings(), t.calendar(), k=3, as_lists=True), "top_hosts"
    ),
    # -- guests -----------------------------------------------------------
    "reviews_by_city_guest": lambda t: guests.reviews_by_city_guest(t.reviews(), t.listings()),
    "top_guests_by_city": lambda t: guests.top_guests_by_city(t.reviews(), t.listings(), k=3),
    "spend_by_guest_listing": lambda t: _round(
        guests.spend_by_guest_listing(t.reviews(), t.listings()), MONEY
    ),
    "spend_by_guest": lambda t: _round(guests.spend_by_guest(t.reviews(), t.listings()), MONEY),
    "biggest_spender": lambda t: _round(guests.biggest_spender(t.reviews(), t.listings()), MONEY),
    # -- spatial ----------------------------------------------------------
    "polygon_edges": lambda t: spatial.polygon_edges(t.features()),
    "polygon_bbox": lambda t: spatial.polygon_bbox(spatial.polygon_edges(t.features())),
    "assign_neighbourhood": lambda t: _assigned(t),
    # parity mode: only the first part's exterior ring, as the surveyed code did
    "assign_neighbourhood_first_ring": lambda t: _assigned(t, first_ring_only=True),
    "neighbourhood_disagreements": lambda t: spatial.neighbourhood_disagreements(
        _assigned(t), t.neighbourhood_test()
    ),
    "neighbourhood_agreement_pct": lambda t: _round(
        spatial.neighbourhood_agreement(_assigned(t), t.neighbourhood_test()), FINE
    ),
    "amenities_by_neighbourhood": lambda t: spatial.amenities_by_neighbourhood(_with_amenities(t)),
    "amenities_one_city": lambda t: spatial.amenities_by_neighbourhood(_with_amenities(t), city=ONE_CITY),
    "polygon_edges_geojson": lambda t: spatial.polygon_edges(features_from_text(t.features_text())),
    "listing_price_points": lambda t: pricing.listing_price_points(t.listings()),
    # -- terms ------------------------------------------------------------
    "term_counts": lambda t: terms.term_counts(t.descriptions()),
    "idf_by_listing": lambda t: _round(terms.idf_by_listing(t.descriptions()), FINE),
    "idf_by_neighbourhood": lambda t: _round(terms.idf_by_neighbourhood(t.descriptions()), FINE),
    "tf_one_listing": lambda t: _round(terms.tf_one(t.descriptions(), TFIDF_LISTING), FINE),
    "tfidf_top_terms_listing": lambda t: _round(
        terms.tfidf_top_terms(t.descriptions(), TFIDF_LISTING, "listing", TOP_TERMS), FINE
    ),
    "tfidf_top_terms_neighbourhood": lambda t: _round(
        terms.tfidf_top_terms(t.descriptions(), TFIDF_NEIGHBOURHOOD, "neighbourhood", TOP_TERMS), FINE
    ),
    "tfidf_top_terms_all": lambda t: _round(
        terms.tfidf_top_terms_all(t.descriptions(), "listing", TOP_TERMS_ALL), FINE
    ),
    "tfidf_top_terms_all_neighbourhoods": lambda t: _round(
        terms.tfidf_top_terms_all(t.descriptions(), "neighbourhood", TOP_TERMS_ALL), FINE
    ),
    # the stored frequencies of all neighbourhoods after one of them has gone
    "idf_without_neighbourhood": lambda t: _round(
        term_store.stored_idf(
            term_store.updated(
                term_store.document_frequencies(t.descriptions(), "neighbourhood"),
                removed=t.descriptions().where(F.col("neighbourhood") == TFIDF_NEIGHBOURHOOD),
                mode="neighbourhood",
            )
        ),
        FINE,
    ),
    "listing_corpus": lambda t: terms.listing_corpus(t.description_listings(), t.neighbourhood_map()),
    # -- alternatives -----------------------------------------------------
    "listing_profile": lambda t: _round(
        alternatives.listing_profile(t.listings(("amenities",)), CHOSEN_LISTING).withColumn(
            "amenities", F.array_join("amenities", "|")
        ),
        FINE,
    ),
    "available_on_date": lambda t: alternatives.available_on_date(t.calendar(), AVAILABLE_DATE),
    "haversine_distance": lambda t: _round(
        alternatives.distance_from_listing(t.listings(("amenities",)), CHOSEN_LISTING), FINE
    ),
    "common_amenities": lambda t: alternatives.common_amenities_with(
        t.listings(("amenities",)), CHOSEN_LISTING
    ),
    "alternative_listings": lambda t: _round(
        alternatives.alternative_listings(
            t.listings(("amenities",)),
            t.calendar(),
            CHOSEN_LISTING,
            AVAILABLE_DATE,
            MAX_PRICE_INCREASE_PCT,
            MAX_KM,
            N_ALTERNATIVES,
        ),
        FINE,
    ),
    "alternative_listings_map": lambda t: _round(
        alternatives.alternative_listings(
            t.listings(("amenities",)),
            t.calendar(),
            CHOSEN_LISTING,
            AVAILABLE_DATE,
            MAX_PRICE_INCREASE_PCT,
            MAX_KM,
            N_ALTERNATIVES,
            wide=True,
        ),
        FINE,
    ),
    "alternative_listings_with_self": lambda t: _round(
        alternatives.alternative_listings(
            t.listings(("amenities",)),
            t.calendar(),
            CHOSEN_LISTING,
            AVAILABLE_DATE,
            MAX_PRICE_INCREASE_PCT,
            MAX_KM,
            N_ALTERNATIVES,
            include_self=True,
        ),
        FINE,
    ),
    # candidates by ranges of cells
    "alternative_listings_near": lambda t: _round(
        alternatives.alternative_listings_near(
            with_cell(t.listings(("amenities",))),
            t.calendar(),
            CHOSEN_LISTING,
            AVAILABLE_DATE,
            MAX_PRICE_INCREASE_PCT,
            MAX_KM,
            N_ALTERNATIVES,
        ),
        FINE,
    ),
    "alternatives_all_pairs": lambda t: _round(
        alternatives_all.alternatives_all_pairs(
            t.listings(("amenities",)), t.calendar(), AVAILABLE_DATE, MAX_PRICE_INCREASE_PCT, MAX_KM, N_ALTERNATIVES
        ),
        FINE,
    ),
}


def _query(over: Callable[[TestTables], DataFrame]) -> Query:
    """Each call reads the tables anew, each table once."""
    return lambda spark, sf_dir: over(TestTables(spark, sf_dir))


QUERIES: dict[str, Query] = {key: _query(over) for key, over in _OVER_TABLES.items()}
