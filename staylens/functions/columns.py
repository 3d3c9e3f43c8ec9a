"""Native column expressions for the parsing and arithmetic the queries share.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the surveyed workload for equal results.
# ---------------------------------------------------------------------------
# money form A deletes exactly these characters before parsing a number
MONEY_A_DELETE = "$,"
# money form B keeps only characters matching this class
MONEY_B_DROP_PATTERN = r"[^0-9.]"
# description tokeniser: a token is a maximal run of characters of the class
# [0-9a-z'-&] after lower-casing. Matched case-insensitively (ASCII only), with
# a second, anchored alternative that yields one empty token for a text
# without any token character.
TOKEN_RUN_PATTERN = r"(?i)[0-9a-z'\-&]+|^(?![\s\S]*[0-9a-z'\-&])"
# the only non-ASCII characters whose simple lower-case mapping is ASCII:
# LATIN CAPITAL LETTER I WITH DOT ABOVE -> i, KELVIN SIGN -> k
NON_ASCII_UPPER = "\u0130\u212a"
NON_ASCII_UPPER_LOWERED = "ik"
# amenity cleaning for the alternatives query: characters outside this class are deleted
AMENITY_CLEAN_DROP_PATTERN = r"[^0-9a-z,'/ \-]"
# raw amenity splitting for the per-neighbourhood amenity list: these characters are deleted
AMENITY_RAW_DELETE = '{}"'
# booking model: a review stands for a stay; 70% of stays are reviewed,
# a stay lasts 3 nights, 12 months a year
REVIEW_RATE = 0.7
NIGHTS_PER_STAY = 3.0
MONTHS_PER_YEAR = 12.0
# mean Earth radius in km used by the distance filter
EARTH_RADIUS_KM = 6371.0
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _try_double(c: Column) -> Column:
    return c.try_cast("double")


def money_a(c: Column | str) -> Column:
    """``"$1,234.50" -> 1234.5``: delete ``$`` and ``,`` then parse (NULL if malformed)."""
    return _try_double(F.translate(_col(c), MONEY_A_DELETE, ""))


def money_b(c: Column | str) -> Column:
    """Keep only digits and dots, then parse: ``"USD 20" -> 20.0`` (NULL if malformed)."""
    return _try_double(F.regexp_replace(_col(c), MONEY_B_DROP_PATTERN, ""))


def ascii_upper(c: Column | str) -> Column:
    """Upper-case ASCII letters only (``é`` and ``ß`` stay as they are)."""
    return F.translate(_col(c), string.ascii_lowercase, string.ascii_uppercase)


def nights_per_year(reviews_per_month: Column | str) -> Column:
    """Estimated booked nights per year; a NULL review rate counts as 0."""
    rpm = F.coalesce(_col(reviews_per_month).cast("double"), F.lit(0.0))
    return rpm / F.lit(REVIEW_RATE) * F.lit(NIGHTS_PER_STAY) * F.lit(MONTHS_PER_YEAR)


def text_tokens(c: Column | str) -> Column:
    """Tokens of a text: the maximal runs of ``[0-9a-z'-&]`` characters of the
    lower-cased text (everything else separates tokens), lower-cased. A text
    without any token character yields one empty token, like
    ``"".split(" ")``.

    Equivalent to lower-casing the text (simple case mapping), replacing every
    other character by a space, collapsing spaces, trimming and splitting on a
    space, but done as one case-insensitive regex pass over the raw text plus
    a lower-case of the (ASCII) tokens. Lower-casing the whole text first
    would convert every non-ASCII text to UTF-16 and back. The two non-ASCII
    capitals whose lower case is ASCII are folded first, only in texts that
    contain them.
    """
    text = _col(c)
    special = F.lit(False)
    for ch in NON_ASCII_UPPER:
        special = special | text.contains(ch)
    folded = F.when(special, F.translate(text, NON_ASCII_UPPER, NON_ASCII_UPPER_LOWERED)).otherwise(text)
    runs = F.regexp_extract_all(folded, F.lit(TOKEN_RUN_PATTERN), 0)
    return F.transform(runs, lambda t: F.lower(t))


def amenity_tokens_raw(c: Column | str) -> Column:
    """``{TV,"Wi Fi"}`` -> ``["TV", "Wi Fi"]``: delete braces and quotes, split on
    commas; no trimming, ``{}`` gives one empty token."""
    return F.split(F.translate(_col(c), AMENITY_RAW_DELETE, ""), ",")


def amenity_list(c: Column | str) -> Column:
    """Lower-case, delete characters outside ``[0-9a-z,'/ -]``, split on commas."""
    return F.split(F.regexp_replace(F.lower(_col(c)), AMENITY_CLEAN_DROP_PATTERN, ""), ",")


def count_found_in(candidates: Column | str, reference: Column | str) -> Column:
    """Number of elements of ``candidates`` that occur in ``reference``.

    Duplicates on the candidate side each count (a multiset count), which is
    why this is ``filter`` + ``array_contains`` and not ``array_intersect``.
    """
    ref = _col(reference)
    return F.size(F.filter(_col(candidates), lambda x: F.array_contains(ref, x))).cast("bigint")


def haversine_km(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance in km between (lat1, lon1) and (lat2, lon2), in doubles."""
    p1, l1 = F.radians(_col(lat1)), F.radians(_col(lon1))
    p2, l2 = F.radians(_col(lat2)), F.radians(_col(lon2))
    dlat = p2 - p1
    dlon = l2 - l1
    a = F.pow(F.sin(dlat / F.lit(2.0)), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(
        F.sin(dlon / F.lit(2.0)), F.lit(2.0)
    )
    return F.lit(2.0) * F.asin(F.sqrt(a)) * F.lit(EARTH_RADIUS_KM)
