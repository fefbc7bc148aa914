"""FeatureCollections cut at any place."""

import json
import random

import pytest

from lotwise.schema import srid_of, with_srid
from lotwise.sources import collection, geojson, sinks
from tests.shapes import LONG, STRING, rectangle, shape_table

FIELDS = "id:bigint,name:string"


@pytest.fixture
def split_size(spark):
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def feature(i, name):
    coordinates = [[[float(i), 0.0], [i + 1.0, 0.0], [i + 1.0, 1.0], [float(i), 0.0]]]
    more = {"nested": {"deep": ["{", {"x": "}\""}]}} if i % 3 == 0 else {}
    return {
        "type": "Feature",
        "properties": {"id": i, "name": name, **more},
        "geometry": {"type": "Polygon", "coordinates": coordinates},
    }


NAMES = ["plain", "a } b", "{{{", '"', '\\"}', "\\", "}{", "é } ü", "", None, 'say "{" twice: "}"', "\n}\n"]


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("size", [97, 800, 1 << 20])
def test_every_feature_comes_once(spark, tmp_path, split_size, indent, size):
    rng = random.Random(size)
    want = []
    for f in range(3):
        own = [feature(100 * f + i, rng.choice(NAMES)) for i in range([40, 0, 7][f])]
        want += [(x["properties"]["id"], x["properties"]["name"]) for x in own]
        crs = {"crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::3735"}}}
        whole = {"type": "FeatureCollection", "name": "a } \" {", **crs, "features": own, "bbox": [0, 0, 1, 1]}
        (tmp_path / f"{f}.geojson").write_text(json.dumps(whole, indent=indent, ensure_ascii=False))
    split_size(size)
    df = collection.read_collection(spark, str(tmp_path), FIELDS)
    assert srid_of(df) == 3735
    if size == 97:
        assert collection._records(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    rows = df.collect()
    assert sorted((r["id"], r["name"] or "") for r in rows) == sorted((i, n or "") for i, n in want)
    assert all(r["geometry"][0][0][0]["x"] == r["id"] for r in rows)


def test_written_collections_are_whole_and_name_their_system(spark, tmp_path):
    rows = [(i, NAMES[i % len(NAMES)], rectangle(i, 0, i + 1, 1)) for i in range(50)]
    df = with_srid(shape_table(spark, rows, ("id", LONG), ("name", STRING)), 3735).repartition(3)
    path = tmp_path / "out"
    collection.write_collection(df, str(path))
    for part in path.glob("part-*"):
        whole = json.loads(part.read_text())
        assert whole["type"] == "FeatureCollection" and whole["crs"]["properties"]["name"].endswith(":3735")
    back = collection.read_collection(spark, str(path), FIELDS)
    assert srid_of(back) == 3735 and back.exceptAll(df).count() == 0 and back.count() == 50
    one = geojson.read_geojson(spark, str(path), FIELDS)
    assert one.count() == 50
    with pytest.raises(Exception, match="already exists"):
        collection.write_collection(df, str(path))


def test_undeclared_empty_and_mixed_systems(spark, tmp_path):
    df = shape_table(spark, [(1, "x", rectangle(0, 0, 1, 1))], ("id", LONG), ("name", STRING))
    collection.write_collection(df.limit(0), str(tmp_path / "none"))
    assert collection.read_collection(spark, str(tmp_path / "none"), FIELDS).count() == 0
    collection.write_collection(df, str(tmp_path / "all"))
    back = collection.read_collection(spark, str(tmp_path / "all"), FIELDS)
    assert not back.schema["geometry"].metadata and back.count() == 1
    collection.write_collection(with_srid(df, 3735), str(tmp_path / "mixed"))
    collection.write_collection(with_srid(df, 3734), str(tmp_path / "mixed"), mode="append")
    with pytest.raises(ValueError, match="different reference systems"):
        collection.read_collection(spark, str(tmp_path / "mixed"), FIELDS)


def test_broken_features_raise(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"id":}}]}')
    with pytest.raises(Exception, match="MALFORMED|parse"):
        collection.read_collection(spark, str(tmp_path), FIELDS).collect()


def test_a_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    for batch, n in (("a", 3), ("b", 4), ("a", 3)):
        sinks.append_rows(spark.range(n), path, batch=batch)
    assert spark.read.parquet(path).groupBy("batch").count().orderBy("batch").collect() == [("a", 3), ("b", 4)]
