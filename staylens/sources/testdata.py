"""Adapters from the driver's parquet tables to the listing-domain inputs.

The surveyed workload reads listings / calendar / reviews TSVs and a GeoJSON
neighbourhood file that are not shipped; the queries registered in
``__spark_entry__`` run on the driver's TPC-H-style tables instead, mapped as
below (and mirrored column by column in ``staylens.plans.oracle`` for DuckDB):

listings       one row per order: id=o_orderkey, host_id=o_custkey,
               city=o_orderpriority, room_type=o_orderstatus,
               price='$'+format_number(o_totalprice, 2); optional extras
               host_listings_count (orders per customer), reviews_per_month
               (lineitems per order / 12) and amenities ('{' + sorted part
               names of the order's lineitems + '}')
calendar       one row per lineitem: listing_id=l_orderkey, date=ship date,
               available='f' when l_linestatus='F' else 't'
reviews        one row per lineitem: listing_id=l_orderkey, reviewer_id=l_suppkey
descriptions   documents: id=doc_id, description=text, neighbourhood=source
features       one MultiPolygon per supplier on a planar grid of 100x100 cells,
               10 cells per row, four shapes (overlapping square, concave,
               square with a hole, two parts)
listing_points one planar point per order, banded so the point rows grow with
               the order count as the polygon rows grow with the supplier count
neighbourhood_test
               a reference labelling of every listing point: the supplier
               owning the point's grid cell (NULL outside the grid)

The driver's tables are clean, so the adapters make some rows irregular by their
keys (the ``Q_`` numbers): NULL, worded and foreign-currency prices, lower-case, NULL
and "New York" cities, NULL hosts and coordinates, quoted and empty amenities, blank
and NULL descriptions, a neighbourhood without words, repeated ids, and labels that
are missing or have a NULL id.

Every adapter is a lazy projection / aggregation of whole tables, so the work
of every registered query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the adapters (shared with the DuckDB oracle).
# ---------------------------------------------------------------------------
# pseudo-coordinates of a listing, in degrees (used by the distance queries)
LAT_BASE, LAT_SPAN, LAT_MULT, LAT_MOD = 47.5, 0.25, 7919, 10007
LON_BASE, LON_SPAN, LON_MULT, LON_MOD = -122.45, 0.22, 104729, 10009
# planar grid for the polygon queries
CELL = 100  # polygon cell edge
GRID_COLUMNS = 10  # cells per grid row
POINT_X_MULT, POINT_X_MOD = 7919, 1001  # x in 0..1000 (1000 lies outside the grid)
POINT_Y_MULT, POINT_Y_MOD = 104729, 101  # y offset in 0..100 inside a band
ORDERS_PER_BAND = 1500  # 150 orders per supplier x 10 suppliers per grid row
# polygon shapes by supplier key % 4, as rings of (dx, dy) offsets from the
# cell origin; rings are closed when built; ring 0 of a part is its exterior
SHAPES = (
    # 0: square reaching 20 units into the left and lower neighbour cells
    (((( -20, -20), (100, -20), (100, 100), (-20, 100)),),),
    # 1: concave pentagon (notch in the top edge)
    ((((0, 0), (100, 0), (100, 60), (50, 30), (0, 60)),),),
    # 2: full cell with a square hole
    ((((0, 0), (100, 0), (100, 100), (0, 100)), ((30, 30), (30, 70), (70, 70), (70, 30))),),
    # 3: two parts: a small square and a triangle
    ((((0, 0), (40, 0), (40, 40), (0, 40)),), (((50, 50), (100, 50), (100, 100)),)),
)
# irregular rows: a row whose key is divisible by the number is irregular that way
Q_PRICE_NULL, Q_PRICE_WORDS, Q_PRICE_USD = 97, 89, 83
Q_CITY_NEW_YORK, Q_CITY_LOWER, Q_CITY_NULL = 53, 7, 103
Q_HOST_NULL, Q_LATITUDE_NULL, Q_POINT_NULL = 101, 113, 127
Q_AMENITIES_NONE, Q_AMENITIES_QUOTED = 61, 5
Q_TEXT_BLANK, Q_TEXT_NULL, Q_TEXT_CAPITALS = 41, 43, 37
Q_NEIGHBOURHOOD_NULL, Q_ID_REPEATED = 47, 59
Q_LABEL_MISSING, Q_LABEL_ID_NULL = 31, 29
# ---------------------------------------------------------------------------


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def closed(ring):
    """Ring of (dx, dy) with the first point repeated at the end."""
    return tuple(ring) + (ring[0],)


class TestTables:
    """Lazy access to ``{sf_dir}/{name}.parquet`` and the adapters built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """The table as a lazy DataFrame. Each table is resolved once per
        instance (Spark runs a small job to read parquet footers for every
        ``read.parquet`` call); only the plan is kept, never the data."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]


    # -- listings -----------------------------------------------------------
    def listings(self, extras: tuple[str, ...] = ()) -> DataFrame:
        """Listing rows; ``extras`` adds the columns that need a join/aggregate:
        ``host_listings_count``, ``reviews_per_month``, ``amenities``.
        Only the requested ones are joined, so queries pay for what they use."""
        o = self.raw("orders")
        k = F.col("o_orderkey")
        city = (
            F.when(_every(k, Q_CITY_NEW_YORK), "New York")
            .when(_every(k, Q_CITY_LOWER), F.lower("o_orderpriority"))
            .when(_every(k, Q_CITY_NULL), F.lit(None))
            .otherwise(F.col("o_orderpriority"))
        )
        amount = F.format_number("o_totalprice", 2)
        price = (
            F.when(_every(k, Q_PRICE_NULL), F.lit(None))
            .when(_every(k, Q_PRICE_WORDS), "call us")
            .when(_every(k, Q_PRICE_USD), F.concat(F.lit("USD "), amount))
            .otherwise(F.concat(F.lit("$"), amount))
        )
        latitude = _scaled(F.col("o_orderkey"), LAT_MULT, LAT_MOD, LAT_BASE, LAT_SPAN)
        df = o.select(
            F.col("o_orderkey").alias("id"),
            F.when(~_every(k, Q_HOST_NULL), F.col("o_custkey")).alias("host_id"),
            F.concat(F.lit("host "), F.col("o_custkey").cast("string")).alias("host_name"),
            F.concat(F.lit("listing "), F.col("o_orderkey").cast("string")).alias("name"),
            city.alias("city"),
            F.col("o_orderstatus").alias("room_type"),
            price.alias("price"),
            F.when(~_every(k, Q_LATITUDE_NULL), latitude).alias("latitude"),
            _scaled(F.col("o_orderkey"), LON_MULT, LON_MOD, LON_BASE, LON_SPAN).alias("longitude"),
            (F.lit(80) + (F.col("o_orderkey") * 31) % 21).cast("string").alias("review_scores_rating"),
        )
        if "host_listings_count" in extras:
            per_host = o.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("host_listings_count"))
            df = df.join(per_host, df.host_id == per_host.o_custkey, "left").drop("o_custkey")
        want_rpm = "reviews_per_month" in extras
        want_amen = "amenities" in extras
        if want_rpm or want_amen:
            li = self.raw("lineitem").select("l_orderkey", "l_partkey")
            aggs = []
            if want_amen:
                part = self.raw("part").select("p_partkey", "p_name")
                li = li.join(part, li.l_partkey == part.p_partkey, "left")
                names = F.array_sort(F.collect_set("p_name"))
                plain = F.concat(F.lit("{"), F.array_join(names, ","), F.lit("}"))
                quoted = F.concat(F.lit('{"'), F.array_join(names, '","'), F.lit('"}'))
                order = F.col("l_orderkey")
                aggs.append(
                    F.when(_every(order, Q_AMENITIES_NONE), "{}")
                    .when(_every(order, Q_AMENITIES_QUOTED), quoted)
                    .otherwise(plain)
                    .alias("amenities")
                )
            if want_rpm:
                aggs.append((F.count(F.lit(1)).cast("double") / F.lit(12.0)).alias("reviews_per_month"))
            per_order = li.groupBy("l_orderkey").agg(*aggs)
            df = df.join(per_order, df.id == per_order.l_orderkey, "left").drop("l_orderkey")
        return df

    def calendar(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("listing_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.when(F.col("l_linestatus") == "F", F.lit("f")).otherwise(F.lit("t")).alias("available"),
        )

    def reviews(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("listing_id"), F.col("l_suppkey").alias("reviewer_id")
        )

    # -- descriptions ---------------------------------------------------------
    def descriptions(self) -> DataFrame:
        """Listing descriptions with their neighbourhood (already joined): some blank
        (all of those in one neighbourhood), NULL, with the two capitals that fold to
        ASCII, without neighbourhood, or under the id of the row before."""
        k = F.col("doc_id")
        text = (
            F.when(_every(k, Q_TEXT_BLANK), " ! ")
            .when(_every(k, Q_TEXT_NULL), F.lit(None))
            .when(_every(k, Q_TEXT_CAPITALS), F.concat(F.lit("\u0130N \u212aO "), F.col("text")))
            .otherwise(F.col("text"))
        )
        place = (
            F.when(_every(k, Q_TEXT_BLANK), "wordless")
            .when(_every(k, Q_NEIGHBOURHOOD_NULL), F.lit(None))
            .otherwise(F.col("source"))
        )
        return self.raw("documents").select(
            F.when(_every(k, Q_ID_REPEATED) & (k > 0), k - 1).otherwise(k).alias("id"),
            text.alias("description"),
            place.alias("neighbourhood"),
        )

    def description_listings(self) -> DataFrame:
        """Listing side of the corpus join: (id, description)."""
        return self.descriptions().select("id", "description")

    def neighbourhood_map(self) -> DataFrame:
        """Map side of the corpus join: (id, neighbourhood)."""
        return self.raw("documents").select(F.col("doc_id").alias("id"), F.col("source").alias("neighbourhood"))

    # -- polygons and points -------------------------------------------------
    def features(self) -> DataFrame:
        """One GeoJSON-shaped MultiPolygon feature per supplier (pid = s_suppkey):
        the supplier's shape template (a literal array) shifted to its cell."""
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        ox = ((k % GRID_COLUMNS) * CELL).cast("double")
        oy = (F.floor(k / GRID_COLUMNS) * CELL).cast("double")
        templates = F.lit([[[list(map(list, closed(r))) for r in rings] for rings in parts] for parts in SHAPES])
        shape = F.element_at(templates, (k % len(SHAPES) + 1).cast("int"))
        coords = F.transform(
            shape,
            lambda rings: F.transform(
                rings,
                lambda ring: F.transform(
                    ring, lambda p: F.array(ox + p[0].cast("double"), oy + p[1].cast("double"))
                ),
            ),
        )
        return s.select(
            k.alias("pid"),
            F.col("s_name").alias("neighbourhood"),
            F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("neighbourhood_group"),
            coords.alias("coordinates"),
        )

    def features_text(self) -> DataFrame:
        """The features as GeoJSON text, one Feature object per row, with their pid."""
        f = F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("MultiPolygon").alias("type"), F.col("coordinates")).alias("geometry"),
            F.struct("neighbourhood", "neighbourhood_group").alias("properties"),
        )
        return self.features().select("pid", F.to_json(f).alias("value"))

    def listing_points(self, amenities: bool = False) -> DataFrame:
        """(id, city, longitude=x, latitude=y) on the planar polygon grid; with
        ``amenities`` also that column of the listings."""
        k = F.col("o_orderkey")
        x = ((k * POINT_X_MULT) % POINT_X_MOD).cast("double")
        y = (F.floor(k / ORDERS_PER_BAND) * CELL + (k * POINT_Y_MULT) % POINT_Y_MOD).cast("double")
        points = self.raw("orders").select(
            k.alias("id"),
            F.col("o_orderpriority").alias("city"),
            F.when(~_every(k, Q_POINT_NULL), x).alias("longitude"),
            y.alias("latitude"),
        )
        if amenities:
            points = points.join(self.listings(("amenities",)).select("id", "amenities"), "id")
        return points

    def neighbourhood_test(self) -> DataFrame:
        """Reference labelling: the supplier owning the point's grid cell; some ids
        have no row, some rows a NULL id."""
        pts = self.listing_points().where(~_every(F.col("id"), Q_LABEL_MISSING))
        cx = F.floor(F.col("longitude") / CELL)
        cy = F.floor(F.col("latitude") / CELL)
        owner = F.when(cx < GRID_COLUMNS, cy * GRID_COLUMNS + cx)
        pts = pts.select("id", "city", owner.alias("owner"))
        s = self.raw("supplier").select("s_suppkey", "s_name")
        return pts.join(s, pts.owner == s.s_suppkey, "left").select(
            F.when(~_every(F.col("id"), Q_LABEL_ID_NULL), F.col("id")).alias("id"),
            F.col("s_name").alias("neighbourhood"),
            "city",
        )


def _scaled(key: Column, mult: int, mod: int, base: float, span: float) -> Column:
    return F.lit(base) + ((key * mult) % mod).cast("double") / F.lit(float(mod)) * F.lit(span)
