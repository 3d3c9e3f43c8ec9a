import datetime as dt

from listing_rows import rows
from staylens.operators import guests, hosts

L_SCHEMA = "id long, host_id long, city string, price string, host_listings_count double"


def test_listings_per_host_counts_null_as_value(spark):
    # D4: distinct().count() counts a NULL as one value
    df = spark.createDataFrame(
        [(1, 10, "A", "$1", 2.0), (2, 10, "A", "$1", 2.0), (None, None, "A", "$1", None)], L_SCHEMA
    )
    r = hosts.listings_per_host(df).collect()[0]
    assert (r["n_listings"], r["n_hosts"]) == (3, 2)
    assert r["listings_per_host"] == 1.5


def test_multi_listing_ratio_as_coded_and_intended(spark):
    # D5: numerator counts rows, denominator distinct (host, count) pairs
    df = spark.createDataFrame(
        [
            (1, 10, "A", "$1", 2.0),
            (2, 10, "A", "$1", 2.0),
            (3, 10, "A", "$1", 3.0),  # same host, different count -> another pair
            (4, 11, "A", "$1", None),  # NULL count -> 0
            (5, None, "A", "$1", None),
        ],
        L_SCHEMA,
    )
    r = hosts.multi_listing_ratio_rows(df).collect()[0]
    assert r["multi_listing_rows"] == 3
    assert r["host_pairs"] == 4  # (10,2) (10,3) (11,NULL) (NULL,NULL)
    assert r["ratio"] == 0.75
    s = hosts.multi_listing_host_share(df).collect()[0]
    assert (s["n_hosts"], s["multi_listing_hosts"]) == (3, 1)


def test_booked_nights_income_and_top_hosts(spark):
    lst = spark.createDataFrame(
        [
            (1, 10, "A", "$100.00", 1.0),
            (2, 10, "A", "$50.00", 1.0),
            (3, 11, "A", "$150.00", 1.0),
            (4, 12, "A", "$75.00", 1.0),
            (5, 13, "A", "$10.00", 1.0),
            (6, 14, "B", "$10.00", 1.0),
            (7, 15, "B", "$10.00", 1.0),  # no calendar rows -> drops out
        ],
        L_SCHEMA,
    )
    d = dt.date(2020, 1, 1)
    cal = spark.createDataFrame(
        [
            (1, d, "f"),
            (1, d, "f"),  # a repeated calendar row counts twice
            (1, d, "t"),
            (2, d, "f"),
            (3, d, "f"),
            (4, d, "f"),
            (4, d, "f"),
            (5, d, None),  # NULL availability -> not booked
            (6, d, "t"),
        ],
        "listing_id long, date date, available string",
    )
    nights = {r["id"]: r["booked_nights"] for r in hosts.booked_nights_by_listing(lst, cal).collect()}
    assert nights == {1: 2, 2: 1, 3: 1, 4: 2, 5: 0, 6: 0}
    income = {(r["city"], r["host_id"]): r["income"] for r in hosts.host_income_by_city(lst, cal).collect()}
    assert income == {("A", 10): 250.0, ("A", 11): 150.0, ("A", 12): 150.0, ("A", 13): 0.0, ("B", 14): 0.0}
    top = rows(hosts.top_hosts_by_city(lst, cal, k=3), "city", "rank", "host_id")
    # D6: tie (11 vs 12 at 150) broken by host id
    assert top == [("A", 1, 10), ("A", 2, 11), ("A", 3, 12), ("B", 1, 14)]
    lists = dict(rows(hosts.top_hosts_by_city(lst, cal, k=3, as_lists=True)))
    assert lists == {"A": [10, 11, 12], "B": [14]}


def test_guests(spark):
    lst = spark.createDataFrame(
        [(1, 10, "A", "$100.00", 1.0), (2, 10, "B", "$10.00", 1.0)], L_SCHEMA
    )
    rev = spark.createDataFrame(
        [(1, 7), (1, 7), (1, 8), (1, 9), (1, 6), (1, 6), (2, 5), (3, 4)], "listing_id long, reviewer_id long"
    )
    counts = rows(guests.reviews_by_city_guest(rev, lst))
    assert counts == [("A", 6, 2), ("A", 7, 2), ("A", 8, 1), ("A", 9, 1), ("B", 5, 1)]
    top = {r["city"]: (r["guest_1"], r["guest_2"], r["guest_3"]) for r in guests.top_guests_by_city(rev, lst).collect()}
    # ties broken by reviewer id; a city with fewer than 3 guests gets NULLs (D7)
    assert top == {"A": (6, 7, 8), "B": (5, None, None)}
    pair = {(r["reviewer_id"], r["listing_id"]): r["spend"] for r in guests.spend_by_guest_listing(rev, lst).collect()}
    assert pair[(7, 1)] == 600.0 and pair[(5, 2)] == 30.0
    best = guests.biggest_spender(rev, lst).collect()
    assert [(r["reviewer_id"], r["spend"]) for r in best] == [(6, 600.0)]  # tie 6/7 -> smaller id
