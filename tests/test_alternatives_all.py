"""Alternatives of every listing: against brute force, across the date line and the poles, and in a dense cell."""

import datetime as dt
import math
import random

import pytest

from staylens.operators import alternatives, alternatives_all

D = dt.date(2020, 5, 1)
SCHEMA = (
    "id long, name string, room_type string, price string, latitude double, longitude double, "
    "amenities string, host_name string, review_scores_rating string"
)
TOKENS = [f"t{i}" for i in range(40)]


def km(a, b):
    p1, l1, p2, l2 = (math.radians(x) for x in (a[0], a[1], b[0], b[1]))
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * math.asin(math.sqrt(h)) * 6371.0


def brute(listings, free, pct, radius, n):
    def rows():
        return [(r, float(r[3][1:]), r[6][1:-1].split(",")) for r in listings if r[3] and r[6] and r[4] is not None]

    out = {}
    for c, price, mine in rows():
        found = []
        for a, other, amen in rows():
            if a[0] != c[0] and a[0] in free and a[2] == c[2] and other <= price * (1 + pct / 100):
                d = km(c[4:6], a[4:6])
                if d < radius:
                    found.append((-sum(x in mine for x in amen), round(d, 6), a[0]))
        for rank, (common, d, i) in enumerate(sorted(found)[:n], 1):
            out[c[0], rank] = (i, -common, d)
    return out


def data(spark, listings, free):
    return (
        spark.createDataFrame(listings, SCHEMA).repartition(3),
        spark.createDataFrame([(i, D, "t") for i in sorted(free)] + [(1, D, "f")], "listing_id long, date date, available string"),
    )


def found(df):
    return {(r["id"], r["rank"]): (r["listing_id"], r["common_amenities"], round(r["distance"], 6)) for r in df.collect()}


def some(rng, count, places, kinds=1000):
    lists = [rng.choices(TOKENS, [1 / (i + 1) for i in range(40)], k=rng.randrange(1, 9)) for _ in range(kinds)]
    rows = []
    for i in range(count):
        lat, lon = places(rng)
        price = None if i % 37 == 0 else f"${rng.randrange(50, 200)}.00"
        amenities = None if i % 41 == 0 else "{" + ",".join(lists[rng.randrange(kinds)]) + "}"
        rows.append((i, f"n{i}", rng.choice("RRS"), price, None if i % 43 == 0 else lat, lon, amenities, "h", "9"))
    return rows


PLACES = {
    "town": lambda r: (47.5 + r.random() / 4, -122.4 + r.random() / 4),
    "date line": lambda r: (-17 + r.random() / 4, r.choice([-180.0 + r.random() / 5, 180.0 - r.random() / 5])),
    "pole": lambda r: (89.7 + 0.3 * r.random(), -180 + 360 * r.random()),
    "far north": lambda r: (78 + r.random() / 3, 15 + r.random()),
}


@pytest.mark.parametrize("place", PLACES)
def test_against_brute_force(spark, place):
    rng = random.Random(place)
    rows = some(rng, 300, PLACES[place])
    free = {i for i in range(300) if rng.random() < 0.6}
    lst, cal = data(spark, rows, free)
    got = found(alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 20, 9.0, 4, block_size=8))
    want = brute(rows, free, 20, 9.0, 4)
    assert len(want) > 300
    assert got == want


def test_agrees_with_the_single_listing_query(spark):
    rng = random.Random(2)
    rows = some(rng, 200, PLACES["town"])
    lst, cal = data(spark, rows, set(range(200)))
    every = found(alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 20, 9.0, 5, block_size=16))
    for i in (1, 2, 50, 41, 199):
        one = alternatives.alternative_listings(lst, cal, i, "2020-05-01", 20, 9.0, 5).collect()
        ids = [every[i, k][0] for k in range(1, 6) if (i, k) in every]
        assert ids == [r["listing_id"] for r in one]


@pytest.mark.parametrize("kinds", [1, 60, 3000])
def test_a_dense_cell_opens_few_pairs(spark, kinds):
    """All listings within one radius: with one amenity list only distance prunes, with many the shared
    amenities do. The ranked pairs stay far below the square of the cell."""
    rng = random.Random(kinds)
    m = 3000
    rows = [r[:2] + ("R", "$100.00") + (47.5 + rng.random() / 8, *r[5:6]) for r in some(rng, m, PLACES["town"], kinds)]
    more = some(random.Random(kinds), m, PLACES["town"], kinds)
    rows = [(*r, x[6] or "{t0}", "h", "9") for r, x in zip(rows, more, strict=True)]
    lst, cal = data(spark, rows, set(range(m)))
    pairs = alternatives_all.opened_pairs(lst, cal, "2020-05-01", 0, 100.0, 5, block_size=32)
    assert pairs.count() < m * m / 15
    got = found(alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 0, 100.0, 5, block_size=32))
    assert len(got) == 5 * m
    sample = rows[:: m // 10]
    for c in sample:
        mine = c[6][1:-1].split(",")
        want = sorted(
            (-sum(x in mine for x in a[6][1:-1].split(",")), round(km(c[4:6], a[4:6]), 6), a[0]) for a in rows if a[0] != c[0]
        )[:5]
        assert [got[c[0], k] for k in range(1, 6)] == [(i, -s, d) for s, d, i in want]


def test_no_rows(spark):
    lst, cal = data(spark, some(random.Random(1), 20, PLACES["town"]), {2, 3})
    assert alternatives_all.alternatives_all_pairs(lst.limit(0), cal, D, 20, 9.0, 4).count() == 0
    assert alternatives_all.alternatives_all_pairs(lst, cal.limit(0), D, 20, 9.0, 4).count() == 0
