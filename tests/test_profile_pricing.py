from pyspark.sql import functions as F

from listing_rows import rows
from staylens.operators import pricing, profile


def test_profile_case_insensitive_ascii(spark):
    df = spark.createDataFrame(
        [("Ab", "é", None, 1.0), ("aB", "É", None, 1.0), (None, "ß", None, 2.0), ("x", "SS", None, None)],
        "a string, b string, c string, d double",
    )
    got = dict(rows(profile.profile_distinct_ci(df)))
    assert got == {"a": 2, "b": 4, "c": 0, "d": 2}
    approx = dict(rows(profile.profile_distinct_approx(df)))
    assert approx["c"] == 0 and approx["a"] == 2


def test_profile_odd_column_names(spark):
    df = spark.createDataFrame([("a", 1), ("A", 2)], "`host.name` string, value int")
    assert dict(rows(profile.profile_distinct_ci(df))) == {"host.name": 1, "value": 2}
    assert dict(rows(profile.profile_distinct_approx(df))) == {"host.name": 1, "value": 2}


def test_distinct_values_and_normalised(spark):
    df = spark.createDataFrame([("New York",), ("new york",), ("NY",), (None,), ("Seattle",)], "city string")
    assert len(profile.distinct_values(df, "city").collect()) == 5  # NULL kept
    assert rows(profile.distinct_normalised(df, "city")) == [("NY",), ("SEATTLE",)]


LISTINGS = [
    # id, city, room_type, price, reviews_per_month
    (1, "A", "x", "$100.00", 1.4),
    (2, "A", "y", "$1,000.00", None),
    (3, "B", "x", "$50", 0.7),
    (4, "B", "x", "bad", 2.1),
]


def listings(spark):
    return spark.createDataFrame(LISTINGS, "id long, city string, room_type string, price string, reviews_per_month double")


def test_pricing(spark):
    df = listings(spark)
    avg = dict(rows(pricing.avg_price_by(df, ["city"])))
    assert avg == {"A": 550.0, "B": 50.0}  # unparsable price ignored
    by_room = rows(pricing.avg_price_by(df, ["city", "room_type"]))
    assert by_room == [("A", "x", 100.0), ("A", "y", 1000.0), ("B", "x", 50.0)]
    one = pricing.avg_price_one_city(df, "A").collect()[0]
    assert one["avg_price"] == 550.0 and one["n_listings"] == 2
    rev = dict(rows(pricing.avg_reviews_by_city(df)))
    assert abs(rev["A"] - 0.7) < 1e-12  # NULL counted as 0, stays in the denominator
    nights = dict(rows(pricing.avg_nights_per_year_by_city(df)))
    for c in rev:  # invariant: nights = reviews / 0.7 * 36
        assert abs(nights[c] - rev[c] / 0.7 * 36) < 1e-9
    spend = dict(rows(pricing.yearly_spend_by_city(df)))
    assert abs(spend["A"] - (1.4 / 0.7 * 36 * 100)) < 1e-9
    assert abs(spend["B"] - (0.7 / 0.7 * 36 * 50)) < 1e-9


def test_sketches_of_parts_merge_into_one_profile(spark):
    from staylens.operators import profile

    rows = [(f"c{i % 3}", i, f"Name {i % 700}" if i % 7 else None, None) for i in range(6000)]
    df = spark.createDataFrame(rows, "city string, id long, name string, nothing string")
    parts = profile.profile_sketches(df, ["city"])
    assert parts.count() == 9
    whole = {r["column_name"]: tuple(r)[1:] for r in profile.merged_profile(profile.profile_sketches(df, columns=["id", "name", "nothing"])).collect()}
    merged = {r["column_name"]: tuple(r)[1:] for r in profile.merged_profile(parts).collect()}
    assert merged == whole  # merging parts equals one pass
    # a later load is added without reading the earlier one again
    more = spark.createDataFrame([("c9", 10_000 + i, f"NAME {i}", None) for i in range(900)], df.schema)
    both = profile.merged_profile(parts.unionByName(profile.profile_sketches(more, ["city"])))
    got = {r["column_name"]: r["approx_distinct_count"] for r in both.collect()}
    exact = {r["column_name"]: r["distinct_count"] for r in profile.profile_distinct_ci(df.unionByName(more)).collect()}
    for c in ("id", "name"):
        assert abs(got[c] - exact[c]) <= 0.05 * exact[c]
    assert got["nothing"] == exact["nothing"] == 0
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "hll_union_agg" in plan and "distinct" not in plan.replace("approx_distinct_count", "")
