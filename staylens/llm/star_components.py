"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import staged
from staylens.llm.shingle_links import salted_join


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest neighbour of each u in rows (u, v), or u itself."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the smallest node among its neighbours and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = salted_join(both.where("v > u"), _least(both), ["u"], "v")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node sends its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    joined = salted_join(down, least, ["u"], "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least.toDF("u", "v")).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of a set of edges; the sum is exact, as decimals don't wrap."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in the links (a, b): the smallest id that it reaches. Rounds of
    large-star and small-star run until neither changes an edge; then each node points at its component's
    smallest. A node with very many neighbours is spread over tasks. NULL ids and links of a row
    with itself aren't links; an empty table has no components."""
    edges = staged(links.where("a <> b").selectExpr("a AS u", "b AS v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = staged(small_star(staged(large_star(edges), "large-star")), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.greatest("u", "v").alias("id"), F.least("u", "v").alias("label"))
    return stars.union(stars.select(F.col("label").alias("id"), "label")).distinct()
