"""A third of all rows on one key: results stay exact when Spark splits the
hot partition (AQE skew join) instead of broadcasting."""

from collections import Counter

import pytest

from staylens.operators import guests, hosts, spatial, terms

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_listing_reviews(skew_session):
    spark = skew_session
    n = 3000
    listings = [(i, 100 + i % 7, f"c{i % 3}", f"${10 + i % 5}.00") for i in range(n)]
    # listing 0 holds a third of all reviews
    reviews = [(0, r % 50) for r in range(n)] + [(1 + r % (n - 1), r % 50) for r in range(2 * n)]
    lst = spark.createDataFrame(listings, "id long, host_id long, city string, price string")
    rev = spark.createDataFrame(reviews, "listing_id long, reviewer_id long").repartition(8)
    got = guests.reviews_by_city_guest(rev, lst)
    plan = final_plan(got)
    assert "SortMergeJoin" in plan and "skew=true" in plan  # the hot partition was split
    city = {i: c for i, _, c, _ in listings}
    want = Counter((city[l], r) for l, r in reviews)
    assert {(r["city"], r["reviewer_id"]): r["n_reviews"] for r in got.collect()} == dict(want)


def test_hot_city_top_hosts_and_hot_calendar(skew_session):
    spark = skew_session
    import datetime as dt

    d = dt.date(2020, 1, 1)
    n = 900
    # city A holds two thirds of the listings; listing 0 a third of the calendar
    listings = [(i, i % 97, "A" if i % 3 else "B", f"${1 + i % 11}.00") for i in range(n)]
    cal = [(0, d, "f")] * n + [(i % n, d, "f" if i % 2 else "t") for i in range(2 * n)]
    lst = spark.createDataFrame(listings, "id long, host_id long, city string, price string")
    c = spark.createDataFrame(cal, "listing_id long, date date, available string").repartition(8)
    got = {(r["city"], r["rank"]): r["host_id"] for r in hosts.top_hosts_by_city(lst, c, k=3).collect()}
    booked = Counter(l for l, _, a in cal if a == "f")
    income = Counter()
    on_calendar = {l for l, _, _ in cal}
    for i, h, ci, p in listings:
        if i in on_calendar:  # inner join: listings without calendar rows drop out
            income[(ci, h)] += float(p[1:]) * booked[i]
    want = {}
    for ci in ("A", "B"):
        ranked = sorted(((h, v) for (cc, h), v in income.items() if cc == ci), key=lambda x: (-x[1], x[0]))[:3]
        for k, (h, _) in enumerate(ranked, 1):
            want[(ci, k)] = h
    assert got == want


def test_hot_cell_spatial(skew_session):
    spark = skew_session
    square = [[[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]]]
    other = [[[[20.0, 0.0], [30.0, 0.0], [30.0, 10.0], [20.0, 10.0], [20.0, 0.0]]]]
    f = spark.createDataFrame(
        [(0, "hot", "g", square), (1, "cold", "g", other)],
        "pid long, neighbourhood string, neighbourhood_group string, coordinates array<array<array<array<double>>>>",
    )
    pts = [(i, 5.0 + (i % 7) / 10, 5.0 + (i % 5) / 10) for i in range(1000)]  # one cell, a third+
    pts += [(1000 + i, 20.5 + (i % 90) / 10, 0.5 + (i % 80) / 10) for i in range(2000)]
    pdf = spark.createDataFrame(pts, "id long, longitude double, latitude double").repartition(8)
    got = spatial.assign_neighbourhood(pdf, spatial.polygon_edges(f), cell_size=5.0)
    res = {r["id"]: r["neighbourhood"] for r in got.collect()}
    assert sum(1 for v in res.values() if v == "hot") == 1000
    assert sum(1 for v in res.values() if v == "cold") == 2000


def test_hot_term_and_hot_neighbourhood_are_dealt_to_many_tasks(skew_session):
    """One term in every description, a third of the listings in one
    neighbourhood: no task of the salted joins gets a share near the whole."""
    from pyspark.sql import functions as F

    spark = skew_session
    texts = [(i, f"the w{i % 50} x{i}", "hot" if i % 3 == 0 else f"n{i % 40}") for i in range(1200)]
    c = spark.createDataFrame(texts, "id long, description string, neighbourhood string").repartition(8)
    salted = terms.term_counts(c).where(F.col("term") == "the").withColumn(
        "_salt", F.pmod(F.xxhash64("id"), F.lit(terms.SALTS))
    )
    dealt = [r["count"] for r in salted.groupBy("_salt").count().collect()]
    assert len(dealt) == terms.SALTS and max(dealt) < 2 * 1200 / terms.SALTS
    for mode, key in (("listing", "id"), ("neighbourhood", "neighbourhood")):
        df = terms.tfidf_top_terms_all(c, mode, 3)
        assert "_salt" in final_plan(df)
        got = {(r[key], r["term"]): r["weight"] for r in df.collect()}
        docs = {}
        for i, t, n in texts:
            docs.setdefault(i if mode == "listing" else n, []).extend(t.split())
        df_of = Counter(t for d in docs.values() for t in set(d))
        for (k, t), w in got.items():
            want = docs[k].count(t) / len(docs[k]) * len(docs) / df_of[t]
            assert abs(w - want) < 1e-9
        assert len(got) == sum(min(3, len(set(d))) for d in docs.values())
