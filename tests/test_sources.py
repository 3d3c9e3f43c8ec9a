from pyspark.sql import types as T

from listing_rows import rows
from staylens.sources import read_tsv, write_delimited
from staylens.sources import schemas


def test_tsv_roundtrip(spark, tmp_path):
    src = tmp_path / "listings.tsv"
    src.write_text("id\thost_id\tcity\tprice\n1\t10\tSeattle\t$1,234.00\n2\t\tNew York\t\n")
    df = read_tsv(spark, str(src))
    assert rows(df) == [("1", "10", "Seattle", "$1,234.00"), ("2", None, "New York", None)]
    cal = tmp_path / "calendar.tsv"
    # extra and reordered columns: fields are picked by header name
    cal.write_text("date\tprice\tavailable\tlisting_id\n2016-01-04\t$5\tf\t1\n2016-01-05\t\tt\tx\n")
    typed = read_tsv(spark, str(cal), schemas.CALENDAR)
    assert typed.columns == ["listing_id", "date", "available"]
    import datetime as dt

    assert rows(typed) == [(1, dt.date(2016, 1, 4), "f"), (None, dt.date(2016, 1, 5), "t")]
    out = tmp_path / "out"
    write_delimited(df, str(out), sep="\t", header=True, single_file=True)
    back = read_tsv(spark, str(out))
    assert rows(back) == rows(df)
    assert len([p for p in out.iterdir() if p.name.startswith("part-")]) == 1


def test_tsv_multi_line_descriptions(spark, tmp_path):
    src = tmp_path / "listings.tsv"
    src.write_text('id\tdescription\tcity\n1\t"Sunny loft.\nNear the park"\tSeattle\n2\tplain\tNew York\n')
    schema = T.StructType([f for f in schemas.LISTINGS.fields if f.name in ("id", "description", "city")])
    df = read_tsv(spark, str(src), schema, multi_line=True)
    assert rows(df, "id", "city") == [(1, "Seattle"), (2, "New York")]
    assert [r["description"] for r in df.orderBy("id").collect()][0] == "Sunny loft.\nNear the park"


def _feature(name, x):
    square = [[[[x, 0.0], [x + 4.0, 0.0], [x + 4.0, 4.0], [x, 4.0], [x, 0.0]]]]
    return {
        "type": "Feature",
        "geometry": {"type": "MultiPolygon", "coordinates": square},
        "properties": {"neighbourhood": name, "neighbourhood_group": "g"},
    }


def test_geojson_identity_over_several_files(spark, tmp_path):
    import json

    from staylens.operators import spatial
    from staylens.sources import read_geojson_features

    for file, names in (("b", ["b0", "b1"]), ("a", ["a0", "a1", "a2"])):
        features = [_feature(n, float(i)) for i, n in enumerate(names)]
        (tmp_path / f"{file}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    df = read_geojson_features(spark, str(tmp_path))
    assert rows(df, "pid", "neighbourhood") == [(0, "a0"), (1, "a1"), (2, "a2"), (3, "b0"), (4, "b1")]
    # a point inside polygons of both files is in the first of them
    point = spark.createDataFrame([(1, 3.5, 2.0), (2, 5.5, 2.0)], "id long, longitude double, latitude double")
    assigned = spatial.assign_neighbourhood(point, spatial.polygon_edges(df))
    assert rows(assigned, "id", "neighbourhood") == [(1, "a0"), (2, "a2")]


def test_geojson_lines_in_file_order_over_splits(spark, tmp_path):
    import json

    from staylens.sources import read_geojson_seq

    names = {"a": 7, "b": 200, "c": 30}
    for file, n in names.items():
        lines = [json.dumps(_feature(f"{file}{i}", float(i))) for i in range(n)]
        (tmp_path / f"{file}.jsonl").write_text("\n".join(lines) + "\n\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = [r["neighbourhood"] for r in read_geojson_seq(spark, str(tmp_path)).orderBy("pid").collect()]
        pids = sorted(r["pid"] for r in read_geojson_seq(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"{f}{i}" for f, n in names.items() for i in range(n)]
    assert pids == list(range(len(got)))


def test_delimited_round_trip_against_typed_rows(spark, tmp_path):
    import datetime as dt

    typed = [(i, dt.date(2016, 1, 1 + i % 28), "t" if i % 3 else "f") for i in range(200)]
    typed.append((None, dt.date(2016, 2, 1), None))
    df = spark.createDataFrame(typed, schemas.CALENDAR)
    write_delimited(df, str(tmp_path / "cal"), sep="\t", header=True)
    assert rows(read_tsv(spark, str(tmp_path / "cal"), schemas.CALENDAR)) == rows(df)
