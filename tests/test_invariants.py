"""Invariants that the surveyed project's recorded outputs satisfy, checked on
the registered queries over the driver's tables."""

from collections import defaultdict

import pytest

from listing_rows import SF_CHECK


@pytest.fixture(scope="module")
def q(spark):
    import __spark_entry__ as E

    qs = E.queries()
    return lambda key: qs[key](spark, SF_CHECK).collect()


def test_price_by_city_room_grid_and_bounds(q):
    by_room = q("avg_price_by_city_room")
    cities = {r["city"] for r in by_room}
    rooms = {r["room_type"] for r in by_room}
    assert len(by_room) == len(cities) * len(rooms)  # every (city, room type) pair present
    lo, hi = defaultdict(lambda: float("inf")), defaultdict(lambda: float("-inf"))
    for r in by_room:
        lo[r["city"]] = min(lo[r["city"]], r["avg_price"])
        hi[r["city"]] = max(hi[r["city"]], r["avg_price"])
    for r in q("avg_price_by_city"):  # a city's mean lies between its room-type means
        assert lo[r["city"]] <= r["avg_price"] <= hi[r["city"]]


def test_nights_are_reviews_over_rate(q):
    reviews = {r["city"]: r["avg_reviews_per_month"] for r in q("avg_reviews_by_city")}
    for r in q("avg_nights_per_year_by_city"):
        assert abs(r["avg_nights_per_year"] - reviews[r["city"]] / 0.7 * 36) < 1e-4


def test_top_guests_distinct(q):
    for r in q("top_guests_by_city"):
        guests = [r["guest_1"], r["guest_2"], r["guest_3"]]
        assert len(set(guests)) == 3


def test_listings_per_host_ratio(q):
    r = q("listings_per_host")[0]
    assert abs(r["listings_per_host"] - r["n_listings"] / r["n_hosts"]) < 1e-6


def test_top_hosts_are_the_highest_incomes(q):
    income = defaultdict(list)
    for r in q("host_income_by_city"):  # a host without any readable price has NULL income and ranks last
        income[r["city"]].append((r["income"] is None, -(r["income"] or 0.0), r["host_id"]))
    assert any(unknown for hosts in income.values() for unknown, _, _ in hosts)
    for r in q("top_hosts_by_city"):
        assert sorted(income[r["city"]])[r["rank"] - 1][2] == r["host_id"]
