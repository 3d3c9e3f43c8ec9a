"""Top-k shapes that plan to bounded operators.

* ``top_k_per_group``: ``row_number() <= k`` over a window. Spark plans this as
  a partial ``WindowGroupLimit`` before the shuffle and a final one after it,
  so each map task forwards at most k rows per group and a hot group never
  lands whole in one task.
* ``top_k``: ``orderBy(...).limit(k)`` plans to ``TakeOrderedAndProject``: a
  bounded heap per partition, then a merge of at most k rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rank"
) -> DataFrame:
    """Keep the first ``k`` rows of each ``keys`` group under ``order`` and add a
    1-based ``rank_col`` (BIGINT). ``order`` must be a total order for a
    deterministic result (end it with a unique column).

    Spark inserts the bounding ``WindowGroupLimit`` only while ``k`` is at most
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (default 1000); the
    operators here use k of 3 to 100."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    return ranked.where(F.col(rank_col) <= k).withColumn(rank_col, F.col(rank_col).cast("bigint"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top ``k`` rows under ``order``."""
    return df.orderBy(*order).limit(k)


def collect_ranked(df: DataFrame, keys: Sequence[str], rank_col: str, value_col: str, out_col: str) -> DataFrame:
    """Per group, the ``value_col`` values as an array in ``rank_col`` order.

    Apply after ``top_k_per_group``: groups then hold at most k rows, so the
    collected arrays are bounded by k."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(value_col).alias("v"))))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda p: p["v"]).alias(out_col))
