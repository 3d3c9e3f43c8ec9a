"""The polygon index follows the polygons' edges, and hot keys are dealt over copies."""

import math
import random

from pyspark.sql import functions as F

from staylens.operators import spatial
from staylens.plans.scalars import scalar

FEATURE = "pid long, neighbourhood string, neighbourhood_group string, coordinates array<array<array<array<double>>>>"


def square(x, y, side):
    return [[[[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]]]


def index_of(spark, features):
    edges = spatial.polygon_edges(spark.createDataFrame(features, FEATURE)).cache()
    polygons = spatial._with_kind(edges, None, None)
    return edges, polygons, spatial.polygon_index(edges, polygons)


def test_one_huge_polygon_among_small_ones(spark):
    rng = random.Random(1)
    small = [(i, f"s{i}", "g", square(rng.uniform(0, 1e6), rng.uniform(0, 1e6), rng.uniform(0.5, 1.5))) for i in range(10_000)]
    # a coast of 4,000 edges around them all
    ring = [
        [5e5 + 9e5 * math.cos(a) * (1 + 0.02 * (k % 2)), 5e5 + 9e5 * math.sin(a) * (1 + 0.02 * (k % 2))]
        for k, a in enumerate(2 * math.pi * k / 4000 for k in range(4000))
    ]
    huge = (10_000, "huge", "g", [[ring + ring[:1]]])
    edges, polygons, index = index_of(spark, [*small, huge])
    sizes = index.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.aggregate("polys", F.lit(0), lambda a, p: a + F.size(p["edges"]))).alias("edges"),
        F.max(F.size("polys")).alias("most"),
    ).first()
    n = edges.count()
    assert sizes["rows"] < 4 * n  # 44,000 edges; one global grid needs 10^10 cells
    assert sizes["edges"] < 16 * n
    assert sizes["most"] < 50
    assert polygons.select("cs", "ss").distinct().count() < 10
    inside = [(i, small[i][3][0][0][0][0] + 0.2, small[i][3][0][0][0][1] + 0.2) for i in range(0, 10_000, 500)]
    points = [*inside, (20_001, -3e5, 5e5), (20_002, -9e6, 5e5), (20_003, None, 1.0)]
    df = spark.createDataFrame(points, "id long, longitude double, latitude double")
    got = {r["id"]: r["pid"] for r in spatial.assign_neighbourhood(df, edges).collect()}
    for i, x, y in inside:
        holds = [p for p, _, _, c in small if c[0][0][0][0] < x < c[0][0][2][0] and c[0][0][0][1] < y < c[0][0][2][1]]
        assert got[i] == min(holds)
    assert (got[20_001], got[20_002], got[20_003]) == (10_000, None, None)
    edges.unpersist()


def test_a_hot_cell_is_dealt_over_copies(spark):
    """A third of all points in one cell: no task of the join gets much more than the others."""
    squares = [(i, f"n{i}", "g", square(10.0 * (i % 40), 10.0 * (i // 40), 10.0)) for i in range(1600)]
    edges, polygons, index = index_of(spark, squares)
    rng = random.Random(2)
    n = 48_000
    rows = [
        (i, 5 + rng.random(), 5 + rng.random()) if i % 3 == 0 else (i, 400 * rng.random(), 400 * rng.random()) for i in range(n)
    ]
    points = spark.createDataFrame(rows, "_id long, _x double, _y double")
    kinds = scalar(polygons.agg(F.collect_set(F.struct("cs", "ss"))))
    keyed = spatial.with_keys(points, kinds)
    many, few = spatial.dealt_over_copies(keyed, index, spatial.hot_keys(keyed))
    parts = 16
    part = F.pmod(F.xxhash64("_key", "_copy"), F.lit(parts))
    dealt = sorted(r["count"] for r in many.groupBy(part.alias("p")).count().collect())
    assert len(dealt) == parts
    assert dealt[-1] < 2 * dealt[parts // 2]
    copies = few.groupBy("key").count().agg(F.max("count"), F.sum("count"), F.count(F.lit(1))).first()
    assert 100 < copies[0] <= spatial.HOT_PARTS
    assert copies[1] < copies[2] + 2 * spatial.HOT_PARTS  # only measured hot keys are repeated
    got = spatial.assign_neighbourhood(points.toDF("id", "longitude", "latitude"), edges).collect()
    want = {i: int(y // 10) * 40 + int(x // 10) for i, x, y in rows}
    assert len(got) == n
    assert {r["id"]: r["pid"] for r in got} == want
    edges.unpersist()


def test_equal_rows_are_told_as_often(spark):
    edges = spatial.polygon_edges(spark.createDataFrame([(0, "a", "g", square(0.0, 0.0, 1.0)), (1, "b", "g", square(0.0, 0.0, 90.0))], FEATURE))
    rows = [(1, 0.5, 0.5)] * 3 + [(2, 50.0, 50.0)] + [(None, 0.5, 0.5)] * 2 + [(3, None, None)] * 2
    points = spark.createDataFrame(rows, "id long, longitude double, latitude double")
    got = sorted(((r["id"], r["pid"]) for r in spatial.assign_neighbourhood(points, edges).collect()), key=repr)
    assert got == sorted([(1, 0)] * 3 + [(2, 1)] + [(None, 0)] * 2 + [(3, None)] * 2, key=repr)
    none = spatial.assign_neighbourhood(points, edges.limit(0)).collect()
    assert len(none) == len(rows) and all(r["pid"] is None for r in none)
