import math

from pyspark.sql import functions as F

from staylens.functions import (
    amenity_list,
    amenity_tokens_raw,
    ascii_upper,
    count_found_in,
    haversine_km,
    money_a,
    money_b,
    nights_per_year,
    text_tokens,
)


def one(spark, value, expr, schema="v string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr(F.col("v")).alias("r")).collect()[0]["r"]


def test_money_forms(spark):
    # D1/D2: form A deletes only '$' and ','; form B keeps digits and dots
    assert one(spark, "$1,234.00", money_a) == 1234.0
    assert one(spark, "$5", money_a) == 5.0
    assert one(spark, None, money_a) is None
    assert one(spark, "USD 20", money_a) is None  # unparsable -> NULL, no job failure
    assert one(spark, "USD 20", money_b) == 20.0
    assert one(spark, "-$5", money_a) == -5.0
    assert one(spark, "-$5", money_b) == 5.0
    assert one(spark, "abc", money_a) is None
    assert one(spark, "abc", money_b) is None


def test_ascii_upper_folds_ascii_only(spark):
    # D3: Python-2 str().upper() folds ASCII letters only
    assert one(spark, "aB", ascii_upper) == "AB"
    assert one(spark, "é", ascii_upper) == "é"
    assert one(spark, "ß", ascii_upper) == "ß"
    assert one(spark, None, ascii_upper) is None


def py_tokens(text):
    """Reference definition: replace, collapse, strip, split."""
    import re

    t = re.sub("[^0-9a-z'\\-&]", " ", text.replace("\u0130", "i").lower())
    t = re.sub(" +", " ", t).strip()
    return t.split(" ")


def test_text_tokens_match_definition(spark):
    samples = [
        "It's R&B -- wi-fi!!",
        "",
        "   ",
        "Ωμέγα",  # only non-token characters -> one empty token (D13)
        "Café au lait, 2 rooms\n\tnear the SEA",
        "a--b 'quoted' & more",
    ]
    for s in samples:
        assert one(spark, s, text_tokens) == py_tokens(s), s
    assert one(spark, None, text_tokens) is None
    # simple case mapping, as the surveyed (Python 2) code: dotted capital I and
    # the Kelvin sign lower-case to ASCII letters and stay inside their token
    assert one(spark, "\u0130stanbul 5\u212a", text_tokens) == ["istanbul", "5k"]


def test_amenity_tokens(spark):
    # raw form: no trimming, quoted commas split, {} -> one empty token
    assert one(spark, "{}", amenity_tokens_raw) == [""]
    assert one(spark, '{TV,"A, B"}', amenity_tokens_raw) == ["TV", "A", " B"]
    assert one(spark, '{TV,"Wireless Internet"}', amenity_list) == ["tv", "wireless internet"]


def test_common_amenities_counts_candidate_duplicates(spark):
    # D17: duplicates on the candidate side each count (not array_intersect)
    df = spark.createDataFrame([(["a", "a", "b", "c"], ["a", "b"])], "cand array<string>, ref array<string>")
    got = df.select(count_found_in("cand", "ref").alias("n")).collect()[0]["n"]
    assert got == 3
    assert df.select(F.size(F.array_intersect("cand", "ref"))).collect()[0][0] == 2


def test_haversine_and_nights(spark):
    df = spark.createDataFrame([(47.6, -122.3, 47.7, -122.4, None, 0.7)], "a double, b double, c double, d double, r1 double, r2 double")
    out = df.select(
        haversine_km("a", "b", "c", "d").alias("km"),
        nights_per_year("r1").alias("n0"),
        nights_per_year("r2").alias("n1"),
    ).collect()[0]
    p1, p2 = math.radians(47.6), math.radians(47.7)
    dl = math.radians(-122.4) - math.radians(-122.3)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    assert abs(out["km"] - 2 * 6371 * math.asin(math.sqrt(a))) < 1e-9
    assert out["n0"] == 0.0
    assert abs(out["n1"] - 36.0) < 1e-12
