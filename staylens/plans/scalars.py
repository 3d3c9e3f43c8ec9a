"""Query-wide scalars (corpus size, totals, cell sizes, a chosen row) as
scalar subqueries.

The surveyed scripts pulled such values to the driver with ``count()`` /
``collect()`` and shipped them back in closures. Here a scalar stays inside
the plan as a scalar subquery (``DataFrame.scalar()``): Spark runs it once,
before the main query, and inlines its single value. Spark raises an error if
a scalar subquery yields more than one row, so the size bound is enforced,
not assumed. Only global aggregates (exactly one row) and ``limit(1)``
lookups are used this way; no join is needed to attach them, so no plan
here contains a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(one_value: DataFrame) -> Column:
    """The single value of a one-row, one-column DataFrame (NULL if it has no row)."""
    return one_value.scalar()


def scalar_row(one_row: DataFrame) -> Column:
    """The single row of a DataFrame with at most one row, as a struct column
    (fields by column name; NULL if it has no row)."""
    return one_row.select(F.struct(*one_row.columns).alias("row")).scalar()
