import datetime as dt

from pyspark.sql import functions as F

from listing_rows import rows
from staylens.operators import alternatives

D = dt.date(2020, 5, 1)
L_SCHEMA = (
    "id long, name string, room_type string, price string, latitude double, longitude double, "
    "amenities string, host_name string, review_scores_rating string"
)
LISTINGS = [
    (1, "chosen", "R", "$100.00", 47.60, -122.30, '{TV,Wifi,"Air conditioning",Kitchen}', "h1", "90"),
    (2, "cheap near", "R", "$80.00", 47.61, -122.31, "{TV,Wifi,Kitchen}", "h2", "91"),
    (3, "at cap", "R", "$130.00", 47.62, -122.30, "{TV,TV,Wifi}", "h3", "92"),
    (4, "over cap", "R", "$130.01", 47.60, -122.29, "{TV,Wifi,Kitchen}", "h4", "93"),
    (5, "other room", "S", "$50.00", 47.60, -122.30, "{TV,Wifi,Kitchen}", "h5", "94"),
    (6, "far", "R", "$90.00", 48.60, -122.30, "{TV,Wifi,Kitchen}", "h6", "95"),
    (7, "not available", "R", "$90.00", 47.60, -122.31, "{TV,Wifi,Kitchen}", "h7", "96"),
    (8, "no amenities", "R", "$90.00", 47.60, -122.31, None, "h8", "97"),
    (9, "two calendar rows", "R", "$99.00", 47.605, -122.305, "{Pool}", "h9", "98"),
]
CAL = [(1, D, "t"), (2, D, "t"), (3, D, "t"), (4, D, "t"), (5, D, "t"), (6, D, "t"), (7, D, "f"), (8, D, "t"),
       (9, D, "t"), (9, D, "t"), (2, dt.date(2020, 5, 2), "f")]


def data(spark):
    return (
        spark.createDataFrame(LISTINGS, L_SCHEMA),
        spark.createDataFrame(CAL, "listing_id long, date date, available string"),
    )


def test_profile_and_unknown_id(spark):
    lst, _ = data(spark)
    p = alternatives.listing_profile(lst, 1).collect()
    assert len(p) == 1 and p[0]["price"] == 100.0
    assert p[0]["amenities"] == ["tv", "wifi", "air conditioning", "kitchen"]
    assert alternatives.listing_profile(lst, 8).count() == 0  # null amenities dropped first
    assert alternatives.listing_profile(lst, 404).count() == 0  # D20: unknown id -> empty


def test_available_on_date_keeps_duplicates(spark):
    _, cal = data(spark)
    got = [r["listing_id"] for r in alternatives.available_on_date(cal, "2020-05-01").collect()]
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 8, 9, 9]


def test_alternatives_filters_and_order(spark):
    lst, cal = data(spark)
    got = alternatives.alternative_listings(lst, cal, 1, "2020-05-01", 30, 50, 10)
    ids = [r["listing_id"] for r in got.collect()]
    # 3 at the cap is kept (inclusive), 4 over it is not; 5 other room, 6 too far,
    # 7 unavailable, 8 no amenities; 9 listed once despite two calendar rows
    assert ids == [2, 3, 9]
    r3 = [r for r in got.collect() if r["listing_id"] == 3][0]
    assert r3["common_amenities"] == 3  # TV twice + Wifi (candidate-side duplicates count)
    with_self = [r["listing_id"] for r in alternatives.alternative_listings(lst, cal, 1, "2020-05-01", 30, 50, 10, include_self=True).collect()]
    assert with_self[0] == 1 and set(with_self) == {1, 2, 3, 9}  # D16
    top1 = [r["listing_id"] for r in alternatives.alternative_listings(lst, cal, 1, "2020-05-01", 30, 50, 1).collect()]
    assert top1 == [2]
    wide = alternatives.alternative_listings(lst, cal, 1, "2020-05-01", 30, 50, 10, wide=True)
    assert wide.columns == ["listing_id", "name", "common_amenities", "distance", "price", "latitude", "longitude",
                            "host_name", "review_scores_rating"]
    assert alternatives.alternative_listings(lst, cal, 404, "2020-05-01", 30, 50, 10).count() == 0


def test_distance_limit_is_strict(spark):
    lst, cal = data(spark)
    dist = {r["id"]: r["distance_km"] for r in alternatives.distance_from_listing(lst, 1).collect()}
    assert dist[1] == 0.0
    limit = dist[3]  # exactly the distance of listing 3
    ids = [r["listing_id"] for r in alternatives.alternative_listings(lst, cal, 1, D, 30, limit, 10).collect()]
    assert 3 not in ids and 2 in ids
    common = dict(rows(alternatives.common_amenities_with(lst, 1)))
    assert common[2] == 3 and common[9] == 0 and 8 not in common
