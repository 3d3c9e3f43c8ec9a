"""FeatureCollections of several splits against the one-task reader."""

import json

import pytest

from listing_rows import rows
from staylens.sources import read_geojson_features, read_geojson_split


def _feature(name, x, kind="MultiPolygon"):
    ring = [[x, 0.0], [x + 4.0, 0.0], [x + 4.0, 4.0], [x, 4.0], [x, 0.0]]
    coordinates = [[ring]] if kind == "MultiPolygon" else [ring]
    return {
        "type": "Feature",
        "geometry": {"type": kind, "coordinates": coordinates},
        "properties": {"neighbourhood": name, "neighbourhood_group": "g{"},
    }


NAMES = ['a}b', '{', '}}', 'say "hi"}', 'back\\', '\\"}{', '[{"type":"Feature"}]', 'tab\t', 'Zürich – {ß}', '']


@pytest.fixture
def split_bytes(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _same(spark, path):
    got = read_geojson_split(spark, path)
    want = read_geojson_features(spark, path)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    return got


@pytest.mark.parametrize("size", ["128m", "300", "61"])
def test_same_rows_at_any_split(spark, tmp_path, split_bytes, size):
    for file, n, indent in (("b", 23, None), ("a", 41, 2)):
        features = [_feature(NAMES[i % len(NAMES)], float(i), ("MultiPolygon", "Polygon")[i % 2]) for i in range(n)]
        doc = {"type": "FeatureCollection", "name": 'odd } { " name', "crs": {"type": "name", "properties": {"name": "}"}}}
        doc["features"] = features
        (tmp_path / f"{file}.geojson").write_text(json.dumps(doc, indent=indent, ensure_ascii=file == "a"), "utf-8")
    split_bytes(size)
    got = _same(spark, str(tmp_path))
    assert got.count() == 64


def test_members_after_the_features_and_other_orders(spark, tmp_path, split_bytes):
    feature = _feature("x", 1.0)
    late = {"features": [dict(reversed(feature.items())), feature], "crs": {"type": "name"}, "type": "FeatureCollection"}
    (tmp_path / "late.geojson").write_text(json.dumps(late) + "\n\n")
    split_bytes("50")
    _same(spark, str(tmp_path))


def test_empty_collections_and_missing_properties(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type": "FeatureCollection", "features": []}')
    assert read_geojson_split(spark, str(tmp_path)).collect() == []
    bare = [{"type": "Feature", "geometry": None, "properties": None}, {"type": "Feature"}]
    (tmp_path / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": bare}))
    assert rows(read_geojson_split(spark, str(tmp_path))) == [(0, None, None, None), (1, None, None, None)]


def test_one_file_is_read_by_several_tasks(spark, tmp_path, split_bytes):
    doc = {"type": "FeatureCollection", "features": [_feature(f"n{i}", float(i)) for i in range(400)]}
    path = tmp_path / "large.geojson"
    path.write_text(json.dumps(doc))
    split_bytes("8k")
    from staylens.sources.feature_collections import _fragments

    fragments = _fragments(spark, str(path))
    assert fragments.rdd.getNumPartitions() >= path.stat().st_size // 8192
    assert fragments.select("_start").distinct().count() >= path.stat().st_size // 8192
    got = [r["neighbourhood"] for r in read_geojson_split(spark, str(path)).orderBy("pid").collect()]
    assert got == [f"n{i}" for i in range(400)]
