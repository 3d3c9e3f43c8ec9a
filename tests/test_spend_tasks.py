"""Spend by guest and listing: the tasks of the sum are so many as stated, whatever AQE would merge."""

from collections import Counter

from staylens.operators import guests


def test_the_sum_is_dealt_over_stated_tasks(spark):
    lst = spark.createDataFrame([(i, f"${10 + i % 5}.00") for i in range(300)], "id long, price string")
    reviews = [(i % 300, i * i % 97) for i in range(3000)]
    rev = spark.createDataFrame(reviews, "listing_id long, reviewer_id long").repartition(3)
    df = guests.spend_by_guest_listing(rev, lst)
    got = {(r["reviewer_id"], r["listing_id"]): r["spend"] for r in df.collect()}
    want = Counter()
    for i, g in reviews:
        want[g, i] += 3.0 * (10 + i % 5)
    assert got == dict(want)
    tasks = guests.TASKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(listing_id#" in final and f", {tasks}), REPARTITION_BY_NUM" in final
    assert "hashpartitioning(reviewer_id" not in final
