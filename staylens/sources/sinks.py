"""Writers for query results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = False,
    single_file: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Write ``df`` as delimited text.

    ``single_file=True`` funnels the last stage through one task (``coalesce(1)``)
    to get one part file; only use it for small results such as per-city
    aggregates. ``mode`` is Spark's save mode (the default fails if the path
    exists, like the surveyed scripts).
    """
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).option("sep", sep).option("header", header).csv(path)
