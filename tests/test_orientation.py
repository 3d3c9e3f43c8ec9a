"""The side of a line against exact rationals, for doubles near and on edges."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from staylens.functions.orientation import side_of_line


def exact(x1, y1, x2, y2, x, y):
    x1, y1, x2, y2, x, y = map(Fraction, (x1, y1, x2, y2, x, y))
    t = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
    return float((t > 0) - (t < 0))


def near_edges(n):
    rng = random.Random(11)
    rows = []
    for _ in range(n):
        scale = 10.0 ** rng.randrange(-6, 7)
        x1, y1, x2, y2 = (rng.uniform(-1, 1) * scale for _ in range(4))
        at = rng.random()
        x, y = x1 + at * (x2 - x1), y1 + at * (y2 - y1)
        if rng.random() < 0.5:
            x += rng.choice([0.0, 1e-16, -1e-16, 1e-13]) * scale
        rows.append((x1, y1, x2, y2, x, y))
    # on the line exactly, and next to it by one bit
    rows += [(0.0, 0.0, 3.0, 9.0, 1.0, 3.0), (0.1, 0.1, 0.3, 0.3, 0.2, 0.2), (0.5, 0.5, 12.0, 12.0, 24.0, 24.0)]
    rows += [(12.0, 12.0, 24.0, 24.0, 0.5 + k * 2.0**-53, 0.5 + j * 2.0**-53) for k in range(8) for j in range(8)]
    return rows


def test_against_exact_rationals(spark):
    names = ["x1", "y1", "x2", "y2", "x", "y"]
    rows = near_edges(1500)
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = df.select(*names, side_of_line(*[F.col(n) for n in names]).alias("side")).collect()
    assert len(got) == len(rows)
    plain_wrong = 0
    for r in got:
        want = exact(*r[:6])
        assert r["side"] == want
        t = (r["x2"] - r["x1"]) * (r["y"] - r["y1"]) - (r["x"] - r["x1"]) * (r["y2"] - r["y1"])
        plain_wrong += ((t > 0) - (t < 0)) != want
    assert plain_wrong > 20  # plain doubles get some of these wrong
