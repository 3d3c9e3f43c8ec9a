"""Stored layouts: the same rows with fewer exchanges, folders and row groups."""

import datetime as dt
import math
import random

import pytest

from listing_rows import SF_SMALL, rows
from staylens.operators import alternatives, hosts
from staylens.sources import schemas, stored
from staylens.sources import testdata


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_listings_and_calendar_join_without_exchange(spark, tmp_path, no_broadcast):
    t = testdata.TestTables(spark, SF_SMALL)
    want = rows(hosts.booked_nights_by_listing(t.listings(), t.calendar()))
    try:
        stored.write_bucketed(t.listings(), "listings_by_id", "id", 6, str(tmp_path / "l"))
        stored.write_bucketed(t.calendar(), "calendar_by_listing", "listing_id", 6, str(tmp_path / "c"))
        nights = hosts.booked_nights_by_listing(spark.table("listings_by_id"), spark.table("calendar_by_listing"))
        plan = _plan(nights)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(nights) == want
        assert len(list((tmp_path / "c").glob("*.parquet"))) <= 6
        income = hosts.host_income_by_city(spark.table("listings_by_id"), spark.table("calendar_by_listing"))
        assert _plan(income).count("Exchange hashpartitioning") == 1  # to (city, host_id) only
    finally:
        spark.sql("DROP TABLE IF EXISTS listings_by_id")
        spark.sql("DROP TABLE IF EXISTS calendar_by_listing")


def test_one_date_reads_one_partition(spark, tmp_path):
    days = [dt.date(2016, 1, 1) + dt.timedelta(i % 40) for i in range(4000)]
    data = [(i, d if i % 3 else dt.date(2016, 1, 5), "t" if i % 5 else "f") for i, d in enumerate(days)]
    data += [(1, None, "t"), (None, dt.date(2016, 1, 5), "t"), (2, dt.date(2016, 1, 5), None)]
    calendar = spark.createDataFrame(data, schemas.CALENDAR)
    path = tmp_path / "calendar"
    # small shuffles are otherwise put together in one task
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    old = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        stored.write_partitioned(calendar, str(path), "date", "listing_id", files_per_value=3)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    back = spark.read.parquet(str(path))
    assert rows(back.select(calendar.columns)) == rows(calendar)
    got = alternatives.available_on_date(back, "2016-01-05")
    plan = got._jdf.queryExecution().executedPlan()
    assert rows(got) == rows(alternatives.available_on_date(calendar, "2016-01-05"))
    metrics = _leaf(got).metrics()
    assert metrics.apply("numPartitions").value() == 1
    assert "PartitionFilters: [isnotnull(date" in plan.toString()
    # a third of the rows have this date; they are in several files
    assert 1 < len(list((path / "date=2016-01-05").glob("*.parquet"))) <= 3


def _leaf(df):
    """The scan of a single-scan query after it has run."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    return plan.collectLeaves().head()


def _interleaved(x, y):
    return sum(((x >> i) & 1) << (2 * i) | ((y >> i) & 1) << (2 * i + 1) for i in range(16))


def test_cells_against_bits(spark):
    r = random.Random(3)
    points = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(300)]
    points += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (-0.0, 179.999999)]
    odd = [(None, 1.0), (1.0, None), (90.001, 0.0), (0.0, -180.5), (math.nan, 0.0), (0.0, math.inf)]
    df = spark.createDataFrame([(*p, "clash") for p in points + odd], "latitude double, longitude double, cell string")
    got = {(a, b): c for a, b, c in (tuple(x) for x in stored.with_cell(df).collect()) if a == a}
    for lat, lon in points:
        y = min(65535, math.floor((lat + 90) / 180 * 65536))
        x = min(65535, math.floor((lon + 180) / 360 * 65536))
        assert got[lat, lon] == _interleaved(x, y)
    assert stored.with_cell(df).where("cell is null").count() == len(odd)


def _km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * math.asin(math.sqrt(min(1.0, h))) * stored.EARTH_RADIUS_KM


def test_no_point_of_a_circle_is_outside_of_its_ranges():
    r = random.Random(4)
    centres = [(0.0, 0.0), (47.6, -122.3), (89.9, 10.0), (-90.0, 0.0), (10.0, 179.99), (-60.0, -180.0), (70.0, 180.0)]
    centres += [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(60)]
    for centre in centres:
        for km in (0.0, 0.2, 3.0, 80.0, 1500.0, 9000.0, 30000.0):
            ranges = stored.cell_ranges(stored.circle_boxes(*centre, km))
            assert 1 <= len(ranges) <= stored.MAX_RANGES
            assert all(a <= b for a, b in ranges) and all(p[1] + 1 < q[0] for p, q in zip(ranges, ranges[1:]))
            reach = math.degrees(km / stored.EARTH_RADIUS_KM) + 0.01
            for _ in range(40):
                lat = min(90.0, max(-90.0, centre[0] + r.uniform(-reach, reach)))
                wide = min(360.0, reach / max(0.01, math.cos(math.radians(lat))))
                lon = (centre[1] + r.uniform(-wide, wide) + 180) % 360 - 180
                if _km(centre, (lat, lon)) < km:
                    y = min(65535, math.floor((lat + 90) / 180 * 65536))
                    x = min(65535, math.floor((lon + 180) / 360 * 65536))
                    assert any(a <= _interleaved(x, y) <= b for a, b in ranges), (centre, km, lat, lon)


def test_ranges_are_tight_for_small_circles():
    cells = sum(b - a + 1 for a, b in stored.cell_ranges(stored.circle_boxes(47.6, -122.3, 5.0)))
    assert cells < 4**16 / 10_000


def test_alternatives_near_read_few_row_groups(spark, tmp_path):
    r = random.Random(8)
    data = []
    for i in range(20_000):  # a third of the listings in one place
        lat, lon = (47.6, -122.3) if i % 3 == 0 and i > 10 else (r.uniform(-60, 70), r.uniform(-180, 180))
        data.append((i, f"n{i}", ("a", "b")[i % 2], f"${r.randint(20, 90)}", "{TV,Wifi}" if i % 4 else "{TV}", lat, lon))
    data += [(50_001, "no place", "a", "$20", "{TV}", None, 1.0), (50_002, "odd", "a", "$20", "{TV}", 95.0, 1.0)]
    schema = "id long, name string, room_type string, price string, amenities string, latitude double, longitude double"
    listings = spark.createDataFrame(data, schema)
    calendar = spark.range(60_000).selectExpr("id as listing_id", "date'2017-03-01' as date", "'t' as available")
    path = str(tmp_path / "listings")
    stored.write_by_cell(listings, path, 24)
    back = spark.read.parquet(path)
    for chosen, km in ((5, 400.0), (12, 3.0), (15, 0.1), (7, 30_000.0), (50_001, 10.0), (50_002, 10.0), (-1, 10.0)):
        args = (calendar, chosen, "2017-03-01", 30.0, km, 7)
        got = alternatives.alternative_listings_near(back, *args)
        assert rows(got) == rows(alternatives.alternative_listings(listings, *args)), chosen
    around = stored.near(back, *[d[5:] for d in data if d[0] == 5][0], 400.0)
    assert "PushedFilters: [Or(" in around._jdf.queryExecution().executedPlan().toString()
    around.collect()
    assert _leaf(around).metrics().apply("numOutputRows").value() < 6_000
    # the crowded cell is in several files
    crowded = back.where("latitude = 47.6").selectExpr("_metadata.file_path as f").distinct().count()
    assert crowded > 4
