"""Stored layouts: tables written so that later queries shuffle or read less.

* :func:`write_bucketed`: two tables with the same buckets of a key join, and aggregate by it,
  without an exchange (listings by ``id`` and their calendar by ``listing_id``).
* :func:`write_partitioned`: a folder for each value; a query of one date lists and reads its folder only.
* :func:`with_cell`, :func:`write_by_cell`, :func:`near`: rows in the order of a space-filling curve, so
  that a circle is some ranges of one integer column, which the scan holds against the statistics of
  its files and row groups.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.columns import EARTH_RADIUS_KM

CELL = "cell"
# Cells of 180 / 2^16 degrees of latitude (0.3 km) by 360 / 2^16 of longitude
AXIS_BITS = 16
# Ranges of cells that a circle is cut into at most
MAX_RANGES = 32
# The haversine distance is computed in doubles; bounds get half a per cent of slack
SLACK = 1.005


def write_bucketed(
    df: DataFrame, table: str, by: str, buckets: int, path: str | None = None, mode: str = "errorifexists"
) -> None:
    """Write ``df`` as the catalog table ``table`` in ``buckets`` buckets of ``by``, sorted by it within.

    Rows are shuffled once, here, to one task and one file a bucket. Size ``buckets`` so that a
    bucket is some hundred MB; tables that are joined need the same number and key type. NULL keys share a bucket.
    """
    out = df.repartition(buckets, by).write.mode(mode).format("parquet").bucketBy(buckets, by).sortBy(by)
    if path is not None:
        out = out.option("path", path)
    out.saveAsTable(table)


def write_partitioned(
    df: DataFrame, path: str, by: str, spread_by: str, files_per_value: int = 1, mode: str = "errorifexists"
) -> None:
    """Write ``df`` as Parquet with a folder for each value of ``by`` (NULL has its own) and at most
    ``files_per_value`` files in each, so that a value with very many rows is written, and read, by as many tasks."""
    salt = F.pmod(F.xxhash64(spread_by), F.lit(files_per_value))
    df.repartition(F.col(by), salt).write.mode(mode).partitionBy(by).parquet(path)


def _step(value: Column, low: float, span: float) -> Column:
    cells = 1 << AXIS_BITS
    at = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(cells)))
    return F.least(at.cast("bigint"), F.lit(cells - 1).cast("bigint"))


def _spread(v: Column) -> Column:
    """The bits of ``v`` at the even places: its binary digits read to the base of four."""
    return F.conv(F.bin(v), 4, 10).cast("bigint")


def with_cell(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude", cell: str = CELL) -> DataFrame:
    """``df`` with the place of its point on the Z-order curve; NULL where a coordinate is missing
    or outside of -90..90 or -180..180. A column of the name ``cell`` is replaced."""
    lat, lon = F.col(latitude).cast("double"), F.col(longitude).cast("double")
    code = F.shiftleft(_spread(_step(lat, -90.0, 180.0)), 1).bitwiseOR(_spread(_step(lon, -180.0, 360.0)))
    return df.withColumn(cell, F.when(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), code))


def write_by_cell(
    df: DataFrame,
    path: str,
    files: int,
    spread_by: str = "id",
    mode: str = "errorifexists",
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> None:
    """Write ``df`` with its cells as ``files`` Parquet files of ascending cells. A cell with very many rows is
    cut by ``spread_by``."""
    order = [CELL, spread_by]
    cells = with_cell(df, latitude, longitude)
    cells.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode(mode).parquet(path)


def circle_boxes(latitude: float, longitude: float, max_km: float) -> list[tuple[float, float, float, float]]:
    """(south, north, west, east) in degrees of one or two boxes that hold all points within ``max_km``; two
    where the circle crosses the 180th meridian. A circle around a pole spans all longitudes."""
    reach = max(0.0, max_km) / EARTH_RADIUS_KM * SLACK + 1e-9
    degrees = math.degrees(reach)
    south, north = max(-90.0, latitude - degrees), min(90.0, latitude + degrees)
    if math.radians(abs(latitude)) + reach >= math.pi / 2:
        return [(south, north, -180.0, 180.0)]
    half = math.degrees(math.asin(min(1.0, math.sin(reach) / math.cos(math.radians(latitude))))) * SLACK
    if half >= 180.0:
        return [(south, north, -180.0, 180.0)]
    west, east = longitude - half, longitude + half
    # the two names of the 180th meridian are both kept
    if west <= -180.0:
        return [(south, north, -180.0, east), (south, north, west + 360.0, 180.0)]
    if east >= 180.0:
        return [(south, north, west, 180.0), (south, north, -180.0, east - 360.0)]
    return [(south, north, west, east)]


def cell_ranges(boxes: list[tuple[float, float, float, float]], max_ranges: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``max_ranges`` ascending ranges of cells (both ends included) that cover the boxes. Squares of the
    curve are cut in four, the largest first, while they lie partly outside and the ranges allow it."""
    cells = 1 << AXIS_BITS

    def axis(value: float, low: float, span: float) -> int:
        return min(cells - 1, max(0, math.floor((value - low) / span * cells)))

    rects = [
        (axis(w, -180.0, 360.0), axis(e, -180.0, 360.0), axis(s, -90.0, 180.0), axis(n, -90.0, 180.0))
        for s, n, w, e in boxes
    ]

    def overlap(x: int, y: int, size: int) -> int:
        """0: apart from all boxes, 2: within one, 1: else."""
        found = 0
        for x0, x1, y0, y1 in rects:
            if x0 <= x and x + size - 1 <= x1 and y0 <= y and y + size - 1 <= y1:
                return 2
            if x <= x1 and x0 < x + size and y <= y1 and y0 < y + size:
                found = 1
        return found

    def merged(squares) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for first, size, _, _, _ in sorted(squares):
            if out and out[-1][1] + 1 == first:
                out[-1] = (out[-1][0], first + size * size - 1)
            else:
                out.append((first, first + size * size - 1))
        return out

    squares = [(0, cells, 0, 0, overlap(0, 0, cells))]  # first cell, side, x, y, overlap
    best = merged(squares)
    size = cells
    while size > 1:
        finer = []
        for square in squares:
            first, side, x, y, kind = square
            if kind == 2:
                finer.append(square)
                continue
            half = side // 2
            for q in range(4):
                qx, qy = x + half * (q & 1), y + half * (q >> 1)
                k = overlap(qx, qy, half)
                if k:
                    finer.append((first + q * half * half, half, qx, qy, k))
        ranges = merged(finer)
        if len(ranges) > max_ranges:
            break
        squares, best, size = finer, ranges, size // 2
    return best


def near(stored: DataFrame, latitude: float, longitude: float, max_km: float, cell: str = CELL) -> DataFrame:
    """The rows whose cell can lie within ``max_km`` of a point, and those without a cell: no row within the
    distance is missing, some beyond it are left. The ranges are literals, so they reach the scan. A point with
    impossible coordinates prunes nothing."""
    if not (-90.0 <= latitude <= 90.0 and -180.0 <= longitude <= 180.0):
        return stored
    keep = F.col(cell).isNull()
    for first, last in cell_ranges(circle_boxes(latitude, longitude, max_km)):
        keep = keep | ((F.col(cell) >= F.lit(first)) & (F.col(cell) <= F.lit(last)))
    return stored.where(keep)
