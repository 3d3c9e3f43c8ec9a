"""The native input formats end to end: listing / calendar / review TSVs with
more columns than used (picked by header name), embedded quotes in
amenities, money strings, a GeoJSON FeatureCollection; plus the CLI."""

import json

from listing_rows import rows
from staylens import cli
from staylens.operators import guests, hosts, pricing, spatial
from staylens.sources import read_geojson_features, read_tsv, schemas

HEADER = [
    "access", "amenities", "city", "description", "host_id", "host_listings_count", "host_name", "id",
    "latitude", "longitude", "name", "price", "review_scores_rating", "reviews_per_month", "room_type", "zipcode",
]
LISTINGS = [
    ["x", '{TV,"Wireless Internet",Kitchen}', "Seattle", "Sunny loft near the park", "10", "2", "Ann", "1",
     "47.61", "-122.33", "Loft", "$120.00", "95", "1.5", "Entire home/apt", "98101"],
    ["x", "{TV,Kitchen}", "Seattle", "Quiet room, park view", "10", "2", "Ann", "2",
     "47.62", "-122.34", "Room", "$80.00", "90", "", "Entire home/apt", "98102"],
    ["x", '{TV,"Wireless Internet"}', "New York", "Busy loft", "11", "1", "Bo", "3",
     "40.71", "-74.00", "NY Loft", "$1,200.00", "", "0.5", "Entire home/apt", "10001"],
]


def write_tsv(path, header, data):
    path.write_text("\t".join(header) + "\n" + "".join("\t".join(r) + "\n" for r in data))


def setup_files(tmp_path):
    write_tsv(tmp_path / "listings.tsv", HEADER, LISTINGS)
    write_tsv(tmp_path / "calendar.tsv", ["listing_id", "date", "available", "price"],
              [["1", "2016-12-15", "f", "$1"], ["2", "2016-12-15", "t", ""], ["3", "2016-12-15", "f", ""],
               ["1", "2016-12-16", "f", ""]])
    write_tsv(tmp_path / "reviews.tsv", ["listing_id", "id", "date", "reviewer_id"],
              [["1", "1", "2016-01-01", "7"], ["1", "2", "2016-01-02", "7"], ["2", "3", "2016-01-03", "8"],
               ["3", "4", "2016-01-04", "9"]])
    write_tsv(tmp_path / "nb.tsv", ["id", "neighbourhood"], [["1", "Downtown"], ["2", "Downtown"], ["3", "SoHo"]])
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"neighbourhood": "Downtown", "neighbourhood_group": "Seattle"},
         "geometry": {"type": "MultiPolygon",
                      "coordinates": [[[[-122.4, 47.6], [-122.3, 47.6], [-122.3, 47.7], [-122.4, 47.7], [-122.4, 47.6]]]]}},
    ]}
    (tmp_path / "nb.geojson").write_text(json.dumps(fc))


def test_native_inputs(spark, tmp_path):
    setup_files(tmp_path)
    lst = read_tsv(spark, str(tmp_path / "listings.tsv"), schemas.LISTINGS)
    cal = read_tsv(spark, str(tmp_path / "calendar.tsv"), schemas.CALENDAR)
    rev = read_tsv(spark, str(tmp_path / "reviews.tsv"), schemas.REVIEWS)
    assert dict(rows(pricing.avg_price_by(lst, ["city"]))) == {"New York": 1200.0, "Seattle": 100.0}
    assert rows(hosts.top_hosts_by_city(lst, cal, 3), "city", "host_id", "income") == [
        ("New York", 11, 1200.0), ("Seattle", 10, 240.0)]
    assert rows(guests.reviews_by_city_guest(rev, lst)) == [("New York", 9, 1), ("Seattle", 7, 2), ("Seattle", 8, 1)]
    edges = spatial.polygon_edges(read_geojson_features(spark, str(tmp_path / "nb.geojson")))
    asg = spatial.assign_neighbourhood(lst, edges, keep=("city", "amenities"))
    assert rows(asg, "id", "neighbourhood") == [(1, "Downtown"), (2, "Downtown"), (3, None)]
    am = rows(spatial.amenities_by_neighbourhood(asg, city="Seattle"))
    assert am == [("Seattle", "Downtown", "Kitchen,TV,Wireless Internet")]


def test_cli(spark, tmp_path):
    setup_files(tmp_path)
    out = tmp_path / "tfidf"
    cli.main(["tfidf", "--listings", str(tmp_path / "listings.tsv"), "--neighbourhoods", str(tmp_path / "nb.tsv"),
              "--listing", "1", "--out", str(out)], spark=spark)
    got = {t: float(w) for t, w in rows(read_tsv(spark, str(out)))}
    assert len(got) == 5
    assert abs(got["sunny"] - 0.2 * 3.0) < 1e-12  # tf 1/5, in 1 of 3 documents
    assert abs(got["loft"] - 0.2 * 1.5) < 1e-12  # tf 1/5, in 2 of 3 documents
    out2 = tmp_path / "alts"
    cli.main(["alternatives", "--listings", str(tmp_path / "listings.tsv"), "--calendar", str(tmp_path / "calendar.tsv"),
              "1", "2016-12-15", "10", "5", "3", "--out", str(out2)], spark=spark)
    alts = rows(read_tsv(spark, str(out2)), "listing_id", "common_amenities")
    assert alts == [("2", "2")]


def test_cli_neighbourhood_and_include_self(spark, tmp_path):
    setup_files(tmp_path)
    out = tmp_path / "tfidf_nb"
    cli.main(["tfidf", "--listings", str(tmp_path / "listings.tsv"), "--neighbourhoods", str(tmp_path / "nb.tsv"),
              "--neighbourhood", "SoHo", "--out", str(out)], spark=spark)
    got = {t: float(w) for t, w in rows(read_tsv(spark, str(out)))}
    assert set(got) == {"busy", "loft"}  # SoHo = listing 3: "Busy loft"; N = 2 neighbourhoods
    assert abs(got["busy"] - 0.5 * 2.0) < 1e-12 and abs(got["loft"] - 0.5 * 1.0) < 1e-12
    out2 = tmp_path / "alts_self"
    cli.main(["alternatives", "--listings", str(tmp_path / "listings.tsv"), "--calendar", str(tmp_path / "calendar.tsv"),
              "2", "2016-12-15", "100", "5", "3", "--include-self", "--out", str(out2)], spark=spark)
    assert [r[0] for r in rows(read_tsv(spark, str(out2)), "listing_id")] == ["2"]
