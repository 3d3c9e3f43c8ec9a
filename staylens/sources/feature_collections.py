"""Large GeoJSON FeatureCollections, read by several tasks.

A FeatureCollection is one JSON document, which Spark's JSON reader parses in one task. Here the
file is read as text fragments that end at a closing brace: the text reader cuts those at any byte
range. Whether a fragment starts within a string, and how deep in objects, follows from all
fragments before it, so each split sums its quotes and braces for both cases, the splits' sums (one
row a split) are added up in file order, and a fragment's place is its split's plus its own. Objects
on the second level are then put together from their fragments, also across splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylens.sources import schemas
from staylens.sources.readers import flatten_features, numbered

_SPLIT = ["_file", "_start"]
# A prefix without an object: whole strings, and all else but opening braces
_BEFORE_OBJECT = r'(?s)^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+'


def read_geojson_split(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`read_geojson_features`, from files of any size.

    Features are the objects on the second level of a file whose ``type`` is ``Feature``; other
    members of the collection (``crs``, names) give no row, nor does an empty collection. A file is
    split by ``spark.sql.files.maxPartitionBytes`` unless it is compressed. A task holds the
    fragments of a split, and one feature at a time. Files have to be valid JSON in UTF-8.
    """
    placed = _placed(_fragments(spark, path))
    features = _features(placed)
    in_split = Window.partitionBy(*_SPLIT).orderBy("_row")
    rows = features.withColumn("_pos", F.row_number().over(in_split) - 1)
    return flatten_features(numbered(rows, _SPLIT))


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each closing brace, with its file, split and order in the split."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("value").alias("_text"),
    )


def _outside_strings(text: Column, in_string: bool) -> Column:
    """What a fragment has outside of strings; a string that the fragment doesn't end is dropped.
    Escapes only occur in strings, and no escape has a brace after its backslash."""
    plain = F.regexp_replace(text, r"(?s)\\.", "")
    if in_string:
        plain = F.concat(F.lit('"'), plain)
    return F.regexp_replace(F.regexp_replace(plain, '"[^"]*"', ""), '"[^"]*$', "")


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _placed(fragments: DataFrame) -> DataFrame:
    """Fragments with ``_in`` (starts within a string), ``_depth`` (objects open before it),
    ``_opens`` (objects that it opens) and ``_after`` (objects open after its closing brace)."""
    before = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    quotes = _count(F.regexp_replace("_text", r"(?s)\\.", ""), '"').cast("long")
    f = fragments.withColumn("_quotes", quotes)
    for s in (0, 1):
        f = f.withColumn(f"_opens{s}", _count(_outside_strings(F.col("_text"), bool(s)), "{").cast("long"))
    f = f.withColumn("_before", F.coalesce(F.sum("_quotes").over(before), F.lit(0)))

    def within(h: int) -> Column:
        """Starts within a string, if the split starts so (h = 1) or not."""
        return (F.col("_before") + h) % 2 == 1

    def opens(h: int) -> Column:
        return F.when(within(h), F.col("_opens1")).otherwise(F.col("_opens0"))

    def change(h: int) -> Column:
        ends_within = (F.col("_before") + F.col("_quotes") + h) % 2 == 1
        return opens(h) - F.when(ends_within, 0).otherwise(1)

    for h in (0, 1):
        f = f.withColumn(f"_change{h}", change(h))
    for h in (0, 1):
        f = f.withColumn(f"_level{h}", F.coalesce(F.sum(f"_change{h}").over(before), F.lit(0)))

    # one row a split: where it starts
    sums = f.groupBy(*_SPLIT).agg(F.sum("_quotes").alias("_q"), F.sum("_change0").alias("_c0"), F.sum("_change1").alias("_c1"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_h", F.coalesce(F.sum("_q").over(earlier), F.lit(0)) % 2)
    own = F.when(F.col("_h") == 1, F.col("_c1")).otherwise(F.col("_c0"))
    starts = starts.withColumn("_own", own).withColumn("_base", F.coalesce(F.sum("_own").over(earlier), F.lit(0)))
    f = f.join(starts.select(*_SPLIT, "_h", "_base"), _SPLIT)

    def by_start(of0: Column, of1: Column) -> Column:
        return F.when(F.col("_h") == 1, of1).otherwise(of0)

    f = f.select(
        *_SPLIT,
        "_row",
        "_text",
        by_start(within(0), within(1)).alias("_in"),
        (F.col("_base") + by_start(F.col("_level0"), F.col("_level1"))).alias("_depth"),
        by_start(opens(0), opens(1)).alias("_opens"),
        by_start(F.col("_change0"), F.col("_change1")).alias("_change"),
    )
    return f.withColumn("_after", F.col("_depth") + F.col("_change"))


def _features(placed: DataFrame) -> DataFrame:
    """One row a feature: the split and row of its first fragment, and ``f``."""
    opener = (F.col("_depth") <= 1) & (F.col("_depth") + F.col("_opens") >= 2)
    p = placed.where(opener | (F.col("_depth") >= 2))
    at = F.struct("_start", "_row")
    so_far = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = p.withColumn("_opener", F.when(opener, at))
    p = p.withColumn("_own", F.last("_opener", ignorenulls=True).over(so_far))
    # a split's first fragments may belong to an object of an earlier split
    lasts = p.groupBy(*_SPLIT).agg(F.max("_opener").alias("_l"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(*_SPLIT, F.last("_l", ignorenulls=True).over(earlier).alias("_carried"))
    p = p.join(carried, _SPLIT).withColumn("_at", F.coalesce("_own", "_carried"))

    # an object starts at its brace: after the collection's own, where the fragment opens both
    start = F.concat(F.when(F.col("_in"), F.lit('"')).otherwise(F.lit("")), "_text")
    cut = F.regexp_replace(start, _BEFORE_OBJECT, "")
    inner = F.regexp_replace(F.substr(cut, F.lit(2)), _BEFORE_OBJECT, "")
    part = F.when(~opener, F.col("_text")).when(F.col("_depth") == 0, inner).otherwise(cut)
    parts = F.sort_array(F.collect_list(F.struct("_start", "_row", part.alias("_part"))))
    whole = p.groupBy("_file", "_at").agg(
        F.concat(F.array_join(F.transform(parts, lambda x: x["_part"]), "}"), F.lit("}")).alias("_json")
    )
    return whole.select(
        "_file",
        F.col("_at._start").alias("_start"),
        F.col("_at._row").alias("_row"),
        F.from_json("_json", schemas.FEATURE_RAW).alias("f"),
    ).where(F.col("f.type") == "Feature")
