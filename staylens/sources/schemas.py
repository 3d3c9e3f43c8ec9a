"""Explicit schemas for the native inputs (no schema inference on big inputs).

TSV inputs arrive as text; money and boolean-like columns stay strings and are
parsed by column functions, numeric ids and rates are typed on read.
"""

from pyspark.sql import types as T

LISTINGS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("host_id", T.LongType()),
        T.StructField("host_name", T.StringType()),
        T.StructField("host_listings_count", T.DoubleType()),
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("room_type", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("reviews_per_month", T.DoubleType()),
        T.StructField("amenities", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("review_scores_rating", T.StringType()),
    ]
)

CALENDAR = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("available", T.StringType()),
    ]
)

REVIEWS = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("reviewer_id", T.LongType()),
    ]
)

NEIGHBOURHOOD_MAP = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("neighbourhood", T.StringType()),
    ]
)

NEIGHBOURHOOD_TEST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("neighbourhood", T.StringType()),
        T.StructField("city", T.StringType()),
    ]
)

# MultiPolygon coordinates[part][ring][point] = [x (longitude), y (latitude)];
# a Polygon has one nesting level less (coordinates[ring][point])
COORDINATES = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
POLYGON_COORDINATES = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))

FEATURE = T.StructType(
    [
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("coordinates", COORDINATES),
                    T.StructField("type", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("neighbourhood", T.StringType()),
                    T.StructField("neighbourhood_group", T.StringType()),
                ]
            ),
        ),
        T.StructField("type", T.StringType()),
    ]
)

# the same Feature with the coordinates left as JSON text, so Polygon and
# MultiPolygon features can share one file and be parsed by geometry type
FEATURE_RAW = T.StructType(
    [
        T.StructField(
            "geometry",
            T.StructType([T.StructField("coordinates", T.StringType()), T.StructField("type", T.StringType())]),
        ),
        FEATURE["properties"],
        T.StructField("type", T.StringType()),
    ]
)

FEATURE_COLLECTION = T.StructType(
    [
        T.StructField("features", T.ArrayType(FEATURE_RAW)),
        T.StructField("type", T.StringType()),
    ]
)
