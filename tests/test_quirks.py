"""Each kind of irregular row that the adapters make changes a registered result: with that kind
taken out, the result differs."""

import pytest

from listing_rows import SF_CHECK, rows
from staylens.plans.catalog import QUERIES
from staylens.sources import testdata as TD

#: Beyond all keys; the row with key 0 alone stays irregular.
NEVER = 10**12

QUIRKS = {
    "Q_PRICE_NULL": "avg_price_by_city",
    "Q_PRICE_WORDS": "avg_price_by_city",
    "Q_PRICE_USD": "avg_price_by_city",
    "Q_CITY_NEW_YORK": "avg_price_by_city",
    "Q_CITY_LOWER": "distinct_cities",
    "Q_CITY_NULL": "distinct_cities",
    "Q_HOST_NULL": "host_income_by_city",
    "Q_LATITUDE_NULL": "haversine_distance",
    "Q_POINT_NULL": "assign_neighbourhood",
    "Q_AMENITIES_NONE": "amenities_by_neighbourhood",
    "Q_TEXT_BLANK": "idf_by_neighbourhood",
    "Q_TEXT_NULL": "idf_by_listing",
    "Q_TEXT_CAPITALS": "term_counts",
    "Q_NEIGHBOURHOOD_NULL": "tfidf_top_terms_all_neighbourhoods",
    "Q_ID_REPEATED": "term_counts",
    "Q_LABEL_MISSING": "neighbourhood_agreement_pct",
    "Q_LABEL_ID_NULL": "neighbourhood_agreement_pct",
}


@pytest.mark.parametrize("name", sorted(QUIRKS))
def test_quirk_changes_a_result(spark, monkeypatch, name):
    query = QUERIES[QUIRKS[name]]
    with_it = rows(query(spark, SF_CHECK))
    monkeypatch.setattr(TD, name, NEVER)
    without = query(spark, SF_CHECK)
    if name == "Q_POINT_NULL":
        assert sum(r["pid"] is None for r in without.collect()) < sum(r[2] is None for r in with_it)
    else:
        assert rows(without) != with_it
