"""On which side of a line a point lies, exactly, for any finite doubles.

The sign of (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) decides every crossing and boundary test of a
polygon. It is computed in doubles with a bound on the rounding error, and where the result is
within that bound, from an exact sum: each difference and each product is a rounded value plus its
exact rounding error, and the sixteen terms are added up without loss as a list of doubles that don't
overlap. The largest of them gives the sign. The list is formed only for the few points near an edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half the distance from 1 to the next double.
EPSILON = 2.0**-53
#: A rounded determinant of absolute value above this times the sum of its products' has the right sign.
ERROR_BOUND = (3.0 + 16.0 * EPSILON) * EPSILON
#: Multiplying by this splits a double into two halves of 26 bits.
_SPLITTER = 2.0**27 + 1.0


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _difference_error(a: Column, b: Column) -> Column:
    """What rounding took from a - b."""
    d = a - b
    part = a - d
    return (a - (d + part)) + (part - b)


def _product(a: Column, b: Column) -> Column:
    """a * b as two doubles whose sum is exact."""

    def halves(v: Column) -> tuple[Column, Column]:
        c = F.lit(_SPLITTER) * v
        high = c - (c - v)
        return high, v - high

    (ah, al), (bh, bl) = halves(a), halves(b)
    p = a * b
    return F.array(p, al * bl - (((p - ah * bh) - al * bh) - ah * bl))


def _add(terms: Column, value: Column) -> Column:
    """A list of doubles that don't overlap, smallest first, with one more value added to it."""

    def step(acc: Column, x: Column) -> Column:
        s = acc["sum"] + x
        part = s - acc["sum"]
        error = (acc["sum"] - (s - part)) + (x - part)
        return F.struct(s.alias("sum"), F.concat(acc["rest"], F.array(error)).alias("rest"))

    start = F.struct(value.alias("sum"), F.array().cast("array<double>").alias("rest"))
    return F.aggregate(terms, start, step, lambda acc: F.concat(acc["rest"], F.array(acc["sum"])))


def _exact_sign(x1, y1, x2, y2, x, y) -> Column:
    pairs = F.array(
        F.struct((x2 - x1).alias("a"), _difference_error(x2, x1).alias("e")),
        F.struct((y - y1).alias("a"), _difference_error(y, y1).alias("e")),
        F.struct((x1 - x).alias("a"), _difference_error(x1, x).alias("e")),
        F.struct((y2 - y1).alias("a"), _difference_error(y2, y1).alias("e")),
    )

    def sign(d: Column) -> Column:
        factors = F.array(
            *[
                F.struct(d[i][u].alias("u"), d[i + 1][v].alias("v"))
                for i in (0, 2)
                for u in ("a", "e")
                for v in ("a", "e")
            ]
        )
        terms = F.flatten(F.transform(factors, lambda f: _product(f["u"], f["v"])))
        exact = F.aggregate(terms, F.array().cast("array<double>"), _add)
        return F.aggregate(exact, F.lit(0.0), lambda s, v: F.when(v != 0, F.signum(v)).otherwise(s))

    return _let(pairs, sign)


def side_of_line(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> Column:
    """1.0 if (x, y) lies to the left of the line from (x1, y1) to (x2, y2), -1.0 if to the right, 0.0 if on it."""
    rounded = F.struct(((x2 - x1) * (y - y1)).alias("p"), ((x - x1) * (y2 - y1)).alias("q"))

    def decide(r: Column) -> Column:
        t = r["p"] - r["q"]
        sure = F.abs(t) > F.lit(ERROR_BOUND) * (F.abs(r["p"]) + F.abs(r["q"]))
        return F.when(sure, F.signum(t)).otherwise(_exact_sign(x1, y1, x2, y2, x, y))

    return _let(rounded, decide)
