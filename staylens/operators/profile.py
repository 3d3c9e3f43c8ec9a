"""Column profiling (distinct counts per column) and distinct-value queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import ascii_upper

# The one spelling normalised by the state clean-up
STATE_SPELLINGS = {"NEW YORK": "NY"}


def _long_values(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    cols = list(columns or df.columns)
    as_text = df.select(*[ascii_upper(F.col(f"`{c}`").cast("string")).alias(c) for c in cols])
    return as_text.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "value")


def profile_distinct_ci(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, distinct_count)``: for each column the number of distinct
    non-NULL values after ASCII upper-casing (``Ab`` = ``aB``, ``é`` != ``É``).

    One job for all columns: the table is unpivoted to (column_name, value) and
    de-duplicated by a partial + final aggregation on that pair, then counted
    per column. No per-column pass, no multi-``count_distinct`` ``Expand``.
    All-NULL columns report 0."""
    pairs = _long_values(df, columns).distinct()
    return pairs.groupBy("column_name").agg(F.count("value").cast("bigint").alias("distinct_count"))


def profile_distinct_approx(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """Approximate ``profile_distinct_ci`` with HyperLogLog++ sketches: one pass,
    partial sketches merged across the shuffle, no value is shuffled."""
    cols = list(columns or df.columns)
    sketches = df.agg(
        *[F.approx_count_distinct(ascii_upper(F.col(f"`{c}`").cast("string")), rsd).alias(c) for c in cols]
    )
    return sketches.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "approx_distinct_count").select(
        "column_name", F.col("approx_distinct_count").cast("bigint")
    )


def profile_distinct_approx_check(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """``(column_name, distinct_count, within_bound)``: the exact count, and
    whether the sketch of ``profile_distinct_approx`` is within 3 x ``rsd`` of it."""
    exact = profile_distinct_ci(df, columns)
    near = profile_distinct_approx(df, columns, rsd)
    error = F.abs(F.col("approx_distinct_count") - F.col("distinct_count"))
    return exact.join(near, "column_name").select(
        "column_name", "distinct_count", (error <= 3 * rsd * F.col("distinct_count")).alias("within_bound")
    )


def profile_sketches(
    df: DataFrame, parts: Sequence[str] = (), columns: Sequence[str] | None = None, log_registers: int = 12
) -> DataFrame:
    """``(*parts, column_name, n_values, sketch)``: a HyperLogLog sketch of each column's upper-cased
    values for each part of the table (a city, a day of loading). To be kept as a table: the
    profile of any set of parts, or of a table that grew, comes from :func:`merged_profile` without reading the values again.

    The rows are unpivoted and sketched by a partial aggregation on (part, column), so a sketch of 2^``log_registers``
    registers at most is what a task sends for each."""
    cols = [c for c in (columns or df.columns) if c not in parts]
    as_text = df.select(
        *[F.col(f"`{c}`") for c in parts], *[ascii_upper(F.col(f"`{c}`").cast("string")).alias(c) for c in cols]
    )
    long = as_text.unpivot([F.col(f"`{c}`") for c in parts], [F.col(f"`{c}`") for c in cols], "column_name", "value")
    return long.groupBy(*[F.col(f"`{c}`") for c in parts], "column_name").agg(
        F.count("value").cast("bigint").alias("n_values"), F.hll_sketch_agg("value", log_registers).alias("sketch")
    )


def merged_profile(sketches: DataFrame) -> DataFrame:
    """``(column_name, n_values, approx_distinct_count)`` from the sketches of any parts, those of several
    tables included (``unionByName``). The relative standard error is about 1.04 / sqrt(registers), 1.6 % with 2^12. Merging is
    associative: parts merged in steps and all at once give the same estimate. A column without values counts 0."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_values").cast("bigint").alias("n_values"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("bigint").alias("approx_distinct_count"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column``; NULL is kept as a value."""
    return df.select(F.col(f"`{column}`")).distinct()


def distinct_normalised(df: DataFrame, column: str, out_col: str = "value") -> DataFrame:
    """Drop NULLs, ASCII upper-case, map the known long spellings to their code,
    then de-duplicate."""
    c = F.col(f"`{column}`")
    v = ascii_upper(c)
    for long_form, code in STATE_SPELLINGS.items():
        v = F.when(v == long_form, F.lit(code)).otherwise(v)
    return df.where(c.isNotNull()).select(v.alias(out_col)).distinct()
