"""Readers for the native input formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.sources import schemas


def read_tsv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Tab-separated text with a header line; every field arrives as text and
    an empty field is NULL.

    Without ``schema`` all columns come back as strings under their header
    names. With a schema, its fields are picked **by header name** (the real
    listings file has ~95 columns, so a positional schema would misalign) and
    converted with ``try_cast`` (an unparsable value becomes NULL instead of
    failing the job). Only the selected columns are parsed (CSV column
    pruning), and the file is split across tasks by byte range.

    ``multi_line=True`` accepts quoted fields with embedded newlines (free-text
    descriptions); Spark then parses each file in one task, so keep it off
    for files without such fields.
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("mode", "PERMISSIVE")
    if multi_line:
        reader = reader.option("multiLine", True).option("escape", '"')
    raw = reader.csv(path)
    if schema is None:
        return raw
    return raw.select(
        *[
            (F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`").try_cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON FeatureCollection file(s) -> one row per feature.

    Output columns: ``pid`` (0-based position over all files, by file path and
    then by position in the file: the order in which polygons are tried),
    ``neighbourhood``, ``neighbourhood_group``, ``coordinates`` (MultiPolygon
    arrays).

    A FeatureCollection is one JSON document, so each file is parsed by one task
    (``multiLine``); neighbourhood files are small. For large polygon sets use
    :func:`read_geojson_seq`, which splits across tasks.
    """
    doc = spark.read.schema(schemas.FEATURE_COLLECTION).option("multiLine", True).json(path)
    rows = doc.select(F.col("_metadata.file_path").alias("_file"), F.posexplode("features").alias("_pos", "f"))
    return flatten_features(numbered(rows, ["_file"]))


def read_geojson_seq(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited GeoJSON features (one Feature object per line).

    ``pid`` numbers the features by file path and line. Tasks read splits of
    files in any order, so a split's rows are numbered within and shifted by the
    rows of the splits before it.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    lines = lines.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.from_json("value", schemas.FEATURE_RAW).alias("f"),
    )
    in_split = Window.partitionBy("_file", "_start").orderBy("_row")
    rows = lines.withColumn("_pos", F.row_number().over(in_split) - 1).drop("_row")
    return flatten_features(numbered(rows, ["_file", "_start"]))


def features_from_text(rows: DataFrame, value: str = "value", pid: str = "pid") -> DataFrame:
    """Feature objects as JSON text, with their number -> one row per feature, as
    the file readers give it."""
    return flatten_features(rows.select(F.col(pid).alias("pid"), F.from_json(value, schemas.FEATURE_RAW).alias("f")))


def numbered(rows: DataFrame, parts: list[str]) -> DataFrame:
    """``rows`` with ``pid``: ``_pos`` (0-based and gapless within the files or
    splits ``parts``) plus the rows of the parts before. Only the counts, one row
    for each part, are ordered as a whole."""
    counts = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*parts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(starts, parts).withColumn("pid", F.col("_before") + F.col("_pos"))


def flatten_features(rows: DataFrame) -> DataFrame:
    """Features -> (pid, neighbourhood, neighbourhood_group, coordinates); a
    Polygon geometry becomes a one-part MultiPolygon, other geometry types get
    NULL coordinates (they contain no point)."""
    raw = F.col("f.geometry.coordinates")
    gtype = F.col("f.geometry.type")
    coords = F.when(gtype == "MultiPolygon", F.from_json(raw, schemas.COORDINATES)).when(
        gtype == "Polygon", F.array(F.from_json(raw, schemas.POLYGON_COORDINATES))
    )
    return rows.select(
        F.col("pid").cast("bigint").alias("pid"),
        F.col("f.properties.neighbourhood").alias("neighbourhood"),
        F.col("f.properties.neighbourhood_group").alias("neighbourhood_group"),
        coords.alias("coordinates"),
    )
