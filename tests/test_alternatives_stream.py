"""Alternatives of every listing with the candidates streaming past tiles of listings: what a listing's task finds is final,
and counts alone, distances alone or both decide."""

import datetime as dt
import random
import re

import pytest
from test_alternatives_all import brute, found, some
from test_alternatives_all import data as tables

from staylens.operators import alternatives_all
from staylens.plans.catalog import QUERIES

D = dt.date(2020, 5, 1)


def test_listings_are_shuffled_by_cell_once_and_pairs_never(spark):
    df = QUERIES["alternatives_all_pairs"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    after = plan[: plan.index("InArrow")]
    assert "Exchange" not in after and "Sort" not in after and "Window" not in after
    # the amenities are put together once for the listings and the candidates
    assert len(re.findall(r"FileScan parquet \[p_partkey", plan)) == 1


def words(rng, kind):
    often, seldom = [f"t{i}" for i in range(12)], [f"s{i}" for i in range(4000)]
    if kind == "long lists":
        return ["t0"] * rng.randrange(200, 400) + rng.sample(often, 3)
    lists = {"common words": (often, 4), "rare words": (seldom, 3), "no words in common": (None, 0)}
    of, k = lists.get(kind, (None, 0))
    if kind == "both":
        return rng.sample(often, 2) + rng.sample(seldom[:300], 3)
    return rng.sample(of, k) if of else [f"u{rng.random()}"]


@pytest.mark.parametrize("kind", ["common words", "rare words", "both", "no words in common", "long lists"])
@pytest.mark.parametrize("block_size", [2, 256])
def test_lists_of_each_kind_against_brute_force(spark, kind, block_size):
    rng = random.Random(kind)
    place = lambda r: (47.3 + r.random() / 2, -122.4 + r.random() / 2)
    rows = some(rng, 500 if kind != "long lists" else 120, place)
    rows = [(*r[:6], "{" + ",".join(words(rng, kind)) + "}", *r[7:]) for r in rows]
    free = {r[0] for r in rows if rng.random() < 0.8}
    lst, cal = tables(spark, rows, free)
    got = found(alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 25, 14.0, 6, block_size=block_size))
    assert got == brute(rows, free, 25, 14.0, 6)
    assert len(got) > len(rows)


def test_counts_that_the_radius_shuts_out_set_no_bar(spark):
    """The candidates alike in amenities lie in the same cells but out of reach, those near have less in common."""
    rng = random.Random(3)
    rows = [(i, "n", "R", "$100.00", 47.5 + rng.random() / 200, -122.4, "{a,b,c,d}", "h", "9") for i in range(40)]
    rows += [(i, "n", "R", "$100.00", 47.68 + rng.random() / 200, -122.4, "{a,b,c,d}", "h", "9") for i in range(40, 400)]
    rows += [(i, "n", "R", "$100.00", 47.5 + rng.random() / 20, -122.4, rng.choice(["{a}", "{e}"]), "h", "9") for i in range(400, 600)]
    lst, cal = tables(spark, rows, set(range(10, 600)))
    got = found(alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 0, 15.0, 45, block_size=4))
    want = brute(rows, set(range(10, 600)), 0, 15.0, 45)
    # some distances differ by less than brute force rounds them
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()} and len(want) == 45 * 600


def test_a_cell_of_several_tiles_and_ids_that_are_text(spark, monkeypatch):
    rng = random.Random(4)
    rows = some(rng, 300, lambda r: (47.5 + r.random() / 50, -122.4 + r.random() / 50))
    lst, cal = tables(spark, rows, set(range(300)))
    lst, cal = lst.withColumn("id", lst.id.cast("string")), cal.withColumn("listing_id", cal.listing_id.cast("string"))
    one = alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 20, 9.0, 4).collect()
    monkeypatch.setattr(alternatives_all, "TILE", 16)
    several = alternatives_all.alternatives_all_pairs(lst, cal, "2020-05-01", 20, 9.0, 4, block_size=1)
    assert sorted(several.collect()) == sorted(one) and len(one) > 900
    want = brute([(str(r[0]), *r[1:]) for r in rows], {str(i) for i in range(300)}, 20, 9.0, 4)
    assert found(several) == want
