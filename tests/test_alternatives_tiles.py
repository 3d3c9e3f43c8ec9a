"""Alternatives of every listing by tiles and chunks: only a listing's best leave a task, whatever the lists are like."""

import datetime as dt
import random

from staylens.operators import alternatives_all

D = dt.date(2020, 5, 1)
SCHEMA = "id long, room_type string, price string, latitude double, longitude double, amenities string"


def frames(spark, rows, free):
    cal = spark.createDataFrame([(i, D, "t") for i in free], "listing_id long, date date, available string")
    return spark.createDataFrame(rows, SCHEMA).repartition(3), cal


def test_lists_without_likeness_leave_n_pairs_a_listing(spark):
    rng = random.Random(5)
    names = [f"t{i}" for i in range(64)]
    m, n = 1500, 5
    rows = [
        (i, "R", f"${rng.randrange(50, 200)}.00", 47.5 + rng.random() / 50, -122.4 + rng.random() / 50, "{" + ",".join(rng.sample(names, 4)) + "}")
        for i in range(m)
    ]
    lst, cal = frames(spark, rows, range(m))
    # one chunk of candidates in each of the cells
    assert alternatives_all.opened_pairs(lst, cal, "2020-05-01", 30, 20.0, n, block_size=32).count() <= 1.1 * n * m
    # several chunks and the same result
    few = alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 30, 20.0, n, block_size=4).collect()
    one = alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 30, 20.0, n).collect()
    assert sorted(few) == sorted(one) and len(one) > 4 * m


def test_listings_at_one_place_are_ranked_by_id_and_few_leave(spark):
    m, n = 900, 3
    lst, cal = frames(spark, [(i, "R", "$9.00", 47.5, -122.4, "{a,b}") for i in range(m)], range(m))
    assert alternatives_all.opened_pairs(lst, cal, "2020-05-01", 0, 20.0, n, block_size=16).count() <= 2 * n * m
    got = alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 0, 20.0, n, block_size=16).collect()
    want = {(i, k): j for i in range(m) for k, j in enumerate([j for j in range(n + 1) if j != i][:n], 1)}
    assert {(r["id"], r["rank"]): r["listing_id"] for r in got} == want
    assert all(r["common_amenities"] == 2 and r["distance"] == 0 for r in got)


def test_unknown_room_types_have_no_alternatives_and_repeated_candidates_count_each(spark):
    rows = [(i, None if i < 3 else "R", "$9.00", 47.5, -122.4 + i * i / 1000, "{a}") for i in range(6)]
    lst, cal = frames(spark, [*rows, (5, "R", "$8.00", 47.5, -122.4, "{a,a}")], range(6))
    got = alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 20, 20.0, 9).collect()
    found = {}
    for r in sorted(got):
        found.setdefault(r["id"], []).append((r["listing_id"], r["common_amenities"]))
    # of rows that repeat an id the first in order searches; each of them is an alternative
    assert found == {3: [(5, 2), (4, 1), (5, 1)], 4: [(5, 2), (3, 1), (5, 1)], 5: [(3, 1), (4, 1)]}
