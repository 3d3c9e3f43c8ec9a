"""Neighbourhood polygons and the distributed point-in-polygon join.

Polygons are not objects here but rows: every ring becomes edge rows
``(pid, part, ring, i, x1, y1, x2, y2)``. Containment is then an equi-join
against a spatial index built from those rows:

1. each polygon gets a grid of its own size (cells of a power of four, about its extent) and,
   within a cell, horizontal bands about as high as its edges. Polygons of one cell and band size are a kind;
   the kinds are few, whatever the polygons;
2. a polygon's edges are filed under the bands they touch. With its extent between half a cell and two, it
   covers at most four columns of cells, so its index rows follow the number of its edges. One polygon that is a million times
   larger than the others changes nothing for them;
3. the index has exactly one row per (kind, column, band) key, listing the
   candidate polygons there with their bbox and their edges in that band;
4. each point has one key for each kind and equi-joins at most one index row by it; on that
   row, higher-order functions test each candidate: strict bbox, even-odd
   count of edges crossed by the ray to the right of the point, and an exact
   on-edge test (boundary excluded, all parts and holes honoured);
5. the smallest containing pid (first polygon in file order) over the kinds wins; points
   with no containing polygon get NULL.

Hot keys: a deterministic sample of the points tells which keys hold more than a small part
of all points. Their index rows are repeated and their points dealt over the copies, in proportion, so
that no key's points land in one task. The crossing and boundary tests are exact for all doubles
(:mod:`staylens.functions.orientation`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import amenity_tokens_raw
from staylens.functions.orientation import side_of_line
from staylens.plans.scalars import scalar

#: Cells and bands come in powers of this, so that polygons of similar size share a kind.
STEP = 4.0
#: Bands of a cell, at most, as a power of ``STEP``.
MOST_BANDS = 10
#: One point in so many, by a hash of its id, is looked at for hot keys.
SAMPLE = 16
#: A key with more than one in ``HOT_PARTS`` / 2 of the sampled points is hot; a key with all points has ``HOT_PARTS`` copies.
HOT_PARTS = 512


def polygon_edges(features: DataFrame, first_ring_only: bool = False) -> DataFrame:
    """Features ``(pid, neighbourhood, neighbourhood_group, coordinates)`` ->
    ``(pid, neighbourhood, neighbourhood_group, part, ring, i, x1, y1, x2, y2)``.

    Every part and ring is kept (ring 0 = exterior, others = holes); an open
    ring is closed. ``first_ring_only=True`` keeps only the exterior ring of the
    first part, which is all the surveyed scripts looked at."""
    meta = ["pid", "neighbourhood", "neighbourhood_group"]
    parts = features.select(*meta, F.posexplode("coordinates").alias("part", "rings"))
    if first_ring_only:
        parts = parts.where(F.col("part") == 0)
    rings = parts.select(*meta, "part", F.posexplode("rings").alias("ring", "pts"))
    if first_ring_only:
        rings = rings.where(F.col("ring") == 0)
    pts = F.col("pts")
    closed = F.when(pts[0] == F.element_at(pts, -1), pts).otherwise(F.concat(pts, F.array(pts[0])))
    rings = rings.where(F.size(pts) >= 2).select(*meta, "part", "ring", closed.alias("pts"))
    segs = F.transform(
        F.sequence(F.lit(0), F.size("pts") - 2),
        lambda i: F.struct(
            i.alias("i"),
            F.col("pts")[i][0].alias("x1"),
            F.col("pts")[i][1].alias("y1"),
            F.col("pts")[i + 1][0].alias("x2"),
            F.col("pts")[i + 1][1].alias("y2"),
        ),
    )
    return rings.select(*meta, "part", "ring", F.explode(segs).alias("e")).select(
        *meta, "part", "ring", "e.i", "e.x1", "e.y1", "e.x2", "e.y2"
    )


def polygon_bbox(edges: DataFrame) -> DataFrame:
    """``(pid, neighbourhood, min_x, min_y, max_x, max_y, n_edges)`` from the
    exterior rings (holes lie inside them)."""
    ext = edges.where(F.col("ring") == 0)
    return ext.groupBy("pid", "neighbourhood").agg(
        F.min(F.least("x1", "x2")).alias("min_x"),
        F.min(F.least("y1", "y2")).alias("min_y"),
        F.max(F.greatest("x1", "x2")).alias("max_x"),
        F.max(F.greatest("y1", "y2")).alias("max_y"),
        F.count(F.lit(1)).cast("bigint").alias("n_edges"),
    )


def _cell(v: Column, size: Column) -> Column:
    return F.floor(v / size)


def _with_kind(edges: DataFrame, cell_size: float | None, stripe_size: float | None) -> DataFrame:
    """One row per polygon: its bbox (of the exterior rings), cell size ``cs`` and band height ``ss``."""
    ext = F.col("ring") == 0
    bbox = edges.groupBy("pid", "neighbourhood").agg(
        F.min(F.when(ext, F.least("x1", "x2"))).alias("min_x"),
        F.min(F.when(ext, F.least("y1", "y2"))).alias("min_y"),
        F.max(F.when(ext, F.greatest("x1", "x2"))).alias("max_x"),
        F.max(F.when(ext, F.greatest("y1", "y2"))).alias("max_y"),
        F.avg(F.abs(F.col("y2") - F.col("y1"))).alias("dy"),
    )
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    fitting = F.when(extent > 0, F.pow(F.lit(STEP), F.ceil(F.log(STEP, extent / 2)))).otherwise(F.lit(1.0))
    bbox = bbox.where(F.col("min_x").isNotNull())
    bbox = bbox.withColumn("cs", fitting if cell_size is None else F.lit(float(cell_size)))
    bands = F.least(F.greatest(F.floor(F.log(STEP, F.col("cs") / F.col("dy"))), F.lit(0)), F.lit(MOST_BANDS))
    height = F.when(F.col("dy") > 0, F.col("cs") / F.pow(F.lit(STEP), bands)).otherwise(F.col("cs"))
    return bbox.withColumn("ss", height if stripe_size is None else F.lit(float(stripe_size))).drop("dy")


def polygon_index(edges: DataFrame, polygons: DataFrame) -> DataFrame:
    """(cs, ss, cx, sy, polys): one row for each kind, column of cells and band that polygons reach."""
    boxes = polygons.withColumnRenamed("pid", "b_pid")
    filed = edges.select("pid", "x1", "y1", "x2", "y2").join(boxes, F.col("pid") == F.col("b_pid"))
    band = F.sequence(_cell(F.least("y1", "y2"), F.col("ss")), _cell(F.greatest("y1", "y2"), F.col("ss")))
    own = ["pid", "neighbourhood", "min_x", "min_y", "max_x", "max_y"]
    rows = filed.select(*own, "cs", "ss", "x1", "y1", "x2", "y2", F.explode(band).alias("sy"))
    rows = rows.groupBy(*own, "cs", "ss", "sy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    columns = F.sequence(_cell(F.col("min_x"), F.col("cs")), _cell(F.col("max_x"), F.col("cs")))
    rows = rows.withColumn("cx", F.explode(columns))
    return rows.groupBy("cs", "ss", "cx", "sy").agg(F.collect_list(F.struct(*own, "edges")).alias("polys"))


def with_keys(points: DataFrame, kinds: Column) -> DataFrame:
    """``points`` (with ``_x``, ``_y``) repeated for each kind (``_kind`` counts them), with the key ``_key`` there.
    Points without kinds or coordinates keep a row with a NULL key."""
    rows = points.withColumn("_kinds", kinds)
    rows = rows.select(*points.columns, F.posexplode_outer("_kinds").alias("_kind", "k"))
    key = F.struct(
        F.col("k.cs").alias("cs"),
        F.col("k.ss").alias("ss"),
        _cell(F.col("_x"), F.col("k.cs")).alias("cx"),
        _cell(F.col("_y"), F.col("k.ss")).alias("sy"),
    )
    known = F.col("k").isNotNull() & F.col("_x").isNotNull() & F.col("_y").isNotNull()
    return rows.withColumn("_key", F.when(known, key)).drop("k")


def hot_keys(keyed: DataFrame) -> Column:
    """How many copies the index rows of hot keys get, as a map from the keys' hashes: a scalar subquery over a
    sample of the points of one kind each. At most ``HOT_PARTS`` / 2 keys of a kind can be hot."""
    sample = keyed.where((F.pmod(F.xxhash64("_id"), F.lit(SAMPLE)) == 0) & F.col("_key").isNotNull())
    counts = sample.groupBy("_kind", F.xxhash64("_key").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") * HOT_PARTS / F.sum("n").over(Window.partitionBy("_kind"))
    copies = counts.withColumn("copies", F.ceil(share).cast("int")).where(F.col("copies") > 2)
    return scalar(copies.groupBy("h").agg(F.max("copies").alias("copies")).agg(
        F.map_from_entries(F.collect_list(F.struct("h", "copies"))).alias("hot")
    ))


def dealt_over_copies(keyed: DataFrame, index: DataFrame, hot: Column) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join with ``_copy``: points of a hot key are dealt over its copies."""

    def copies(h: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("_hot"), h), F.lit(1))

    points = keyed.withColumn("_hot", hot)
    points = points.withColumn("_copy", F.pmod(F.xxhash64("_id", "_x", "_y"), copies(F.xxhash64("_key"))).cast("int"))
    rows = index.withColumn("key", F.struct("cs", "ss", "cx", "sy")).withColumn("_hot", hot)
    rows = rows.select(
        "key", "polys", F.explode(F.sequence(F.lit(0), copies(F.xxhash64("key")) - 1)).alias("copy")
    )
    return points.drop("_hot"), rows


def _first_containing(x: Column, y: Column) -> Column:
    """(pid, nb) of the first polygon of ``polys`` that strictly contains the point."""

    def against(e):
        x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
        beside = (y >= F.least(y1, y2)) & (y <= F.greatest(y1, y2)) & (x <= F.greatest(x1, x2))
        # an edge wholly to the right is crossed if the point's height lies within it; no side is needed
        side = F.when(~beside, F.lit(9.0)).when(x < F.least(x1, x2), F.lit(5.0)).otherwise(side_of_line(x1, y1, x2, y2, x, y))
        return F.struct(side.alias("side"), ((y1 > y) != (y2 > y)).alias("spans"), (y2 > y1).alias("up"), (x >= F.least(x1, x2)).alias("at"))

    def crossed(t):
        right = F.when(t["side"] == 5.0, True).when(t["up"], t["side"] == 1.0).otherwise(t["side"] == -1.0)
        return t["spans"] & (t["side"] < 9.0) & right

    def contains(p):
        in_box = (x > p["min_x"]) & (x < p["max_x"]) & (y > p["min_y"]) & (y < p["max_y"])
        tests = F.transform(p["edges"], against)
        tally = F.aggregate(
            tests,
            F.struct(F.lit(0).alias("c"), F.lit(False).alias("on")),
            lambda acc, t: F.struct(
                (acc["c"] + crossed(t).cast("int")).alias("c"), (acc["on"] | (t["at"] & (t["side"] == 0.0))).alias("on")
            ),
        )
        return F.when(in_box, F.transform(F.array(tally), lambda r: (r["c"] % 2 == 1) & ~r["on"])[0]).otherwise(False)

    hits = F.filter("polys", contains)
    return F.array_min(F.transform(hits, lambda p: F.struct(p["pid"].alias("pid"), p["neighbourhood"].alias("nb"))))


def assign_neighbourhood(
    points: DataFrame,
    edges: DataFrame,
    cell_size: float | None = None,
    id_col: str = "id",
    x_col: str = "longitude",
    y_col: str = "latitude",
    keep: tuple[str, ...] = (),
    stripe_size: float | None = None,
) -> DataFrame:
    """``(id, *keep, pid, neighbourhood)``: per point row, the first polygon
    (smallest pid) strictly containing it; NULL when none (or a NULL
    coordinate). ``keep`` columns of ``points`` are carried through.

    ``cell_size`` and ``stripe_size`` give all polygons one size of cells or bands; by default each
    polygon has its own (see the module's text).

    Plan: a point row is repeated for each kind of polygons (one, where polygons have about one
    size), joined by key with the polygon index, hot keys spread, and put together again by an aggregation on
    (id, kept columns, coordinates) with partial results. Rows equal in all of these are counted and told as often."""
    polygons = _with_kind(edges, cell_size, stripe_size)
    kinds = scalar(polygons.agg(F.collect_set(F.struct("cs", "ss")).alias("kinds")))
    pts = points.select(
        F.col(id_col).alias("_id"),
        *keep,
        F.col(x_col).cast("double").alias("_x"),
        F.col(y_col).cast("double").alias("_y"),
    )
    keyed = with_keys(pts, kinds)
    hot = hot_keys(with_keys(pts.select("_id", "_x", "_y"), kinds))
    keyed, index = dealt_over_copies(keyed, polygon_index(edges, polygons), hot)
    # double keys are compared as they are: both sides compute them by the same expressions
    j = keyed.join(index, (F.col("_key") == F.col("key")) & (F.col("_copy") == F.col("copy")), "left")
    j = j.withColumn("first", _first_containing(F.col("_x"), F.col("_y")))
    one = F.sum(F.when(F.coalesce("_kind", F.lit(0)) == 0, 1).otherwise(0))
    rows = j.groupBy("_id", *keep, "_x", "_y").agg(F.min("first").alias("first"), one.cast("int").alias("_n"))
    rows = rows.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return rows.select(
        F.col("_id").alias(id_col),
        *keep,
        F.col("first.pid").cast("bigint").alias("pid"),
        F.col("first.nb").alias("neighbourhood"),
    )


def _row_presence(assigned: DataFrame, test: DataFrame) -> DataFrame:
    """``(id, neighbourhood, city, m_rows, t_rows)``: for every distinct row of
    either side, how often it occurs in each side (NULLs group together, like
    a set difference).

    Both sides are unioned and reduced by a partial + final aggregation on the
    full row, so repeated rows (even a third of the input on one id) collapse
    map-side before the shuffle; nothing is partitioned by ``id`` alone before
    that reduction."""
    cols = ["id", "neighbourhood", "city"]
    m = assigned.select(*cols, F.lit(1).alias("_m"), F.lit(0).alias("_t"))
    t = test.select(*cols, F.lit(0).alias("_m"), F.lit(1).alias("_t"))
    u = m.unionByName(t)
    return u.groupBy(*cols).agg(F.sum("_m").alias("m_rows"), F.sum("_t").alias("t_rows"))


def neighbourhood_disagreements(assigned: DataFrame, test: DataFrame) -> DataFrame:
    """``(id, my_neighbourhood, test_neighbourhood)``: distinct rows of each side
    that are not in the other (set difference on (id, neighbourhood, city),
    NULL-safe), paired up by id. A city mismatch also counts; ids present on
    one side only drop out. With one row per id and side (listing ids are
    keys) each id yields at most one pair."""
    rows = _row_presence(assigned, test)
    mine = rows.where((F.col("m_rows") > 0) & (F.col("t_rows") == 0)).select(
        F.col("id").alias("m_id"), F.col("neighbourhood").alias("my_neighbourhood")
    )
    theirs = rows.where((F.col("t_rows") > 0) & (F.col("m_rows") == 0)).select(
        F.col("id").alias("t_id"), F.col("neighbourhood").alias("test_neighbourhood")
    )
    return mine.join(theirs, mine.m_id == theirs.t_id, "inner").select(
        F.col("m_id").alias("id"), "my_neighbourhood", "test_neighbourhood"
    )


def neighbourhood_agreement(assigned: DataFrame, test: DataFrame) -> DataFrame:
    """One row ``(n_listings, n_disagreements, n_unlabelled, agreement_pct)``:
    ``(n - disagreements) / n * 100`` with n the assigned rows; assigned rows
    whose id has no test row (``n_unlabelled``) therefore count as agreeing.

    One pass: per id, the disagreement count is (mine-only rows) x (test-only
    rows), computed from counts without materialising any pair."""
    rows = _row_presence(assigned, test)
    mine_only = (F.col("m_rows") > 0) & (F.col("t_rows") == 0)
    test_only = (F.col("t_rows") > 0) & (F.col("m_rows") == 0)
    per_id = rows.groupBy("id").agg(
        F.sum("m_rows").alias("n_m"),
        F.sum("t_rows").alias("n_t"),
        F.count_if(mine_only).alias("a"),
        F.count_if(test_only).alias("b"),
    )
    out = per_id.agg(
        F.sum("n_m").cast("bigint").alias("n_listings"),
        # a NULL id pairs with nothing, as in neighbourhood_disagreements
        F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("a") * F.col("b"))), F.lit(0))
        .cast("bigint")
        .alias("n_disagreements"),
        F.coalesce(F.sum(F.when((F.col("n_t") == 0) | F.col("id").isNull(), F.col("n_m"))), F.lit(0))
        .cast("bigint")
        .alias("n_unlabelled"),
    )
    pct = F.try_divide(
        (F.col("n_listings") - F.col("n_disagreements")).cast("double"), F.col("n_listings").cast("double")
    ) * F.lit(100.0)
    return out.withColumn("agreement_pct", pct)


def amenities_by_neighbourhood(assigned: DataFrame, city: str | None = None) -> DataFrame:
    """``(city, neighbourhood, amenities)``: the distinct raw amenity tokens of
    each neighbourhood's listings, sorted and joined with ``,``. ``assigned`` is
    ``assign_neighbourhood`` with ``keep=("city", "amenities")``, so listings are
    not joined again. Listings no polygon contains form the neighbourhood ``''``.
    With ``city`` only that city is kept.

    Tokens are de-duplicated by an aggregation on (city, neighbourhood, token)
    before anything is collected, so each output list holds distinct values."""
    j = assigned.where(F.col("amenities").isNotNull())
    if city is not None:
        j = j.where(F.col("city") == city)
    j = j.withColumn("neighbourhood", F.coalesce("neighbourhood", F.lit("")))
    tokens = j.select("city", "neighbourhood", F.explode(amenity_tokens_raw("amenities")).alias("amenity")).distinct()
    return tokens.groupBy("city", "neighbourhood").agg(
        F.array_join(F.array_sort(F.collect_list("amenity")), ",").alias("amenities")
    )
