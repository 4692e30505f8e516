"""Collections read in ranges of any size give what reading them whole gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.sources import geojson, ranges


def collection(rng, n, late=False, **more):
    """Features whose texts hold brackets, quotes and backslashes, with members in any order."""
    words = ["{", "}", '"', "\\", "[", "]", '\\"', '{"type":"Feature"', "é😀", '"features":[{', "\n", "x"]

    def feature(k):
        members = [("type", "Feature"), ("properties", {"k": k, "note": "".join(rng.choice(words) for _ in range(rng.randint(0, 30))), "deep": [{"a": [{}]}] * rng.randint(0, 2)}),
                   ("geometry", {"type": "Point", "coordinates": [k, -k / 7], "crs": {"type": "x"}})]
        rng.shuffle(members)
        return dict(members)

    doc = {"type": "FeatureCollection", "links": [{"href": "a"}, {"href": "b"}], **more, "features": [feature(k) for k in range(n)]}
    if late:
        doc = {k: doc[k] for k in sorted(doc)}  # features before the links, the system first
    return doc


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 20])
def test_same_as_whole(tmp_path, size):
    rng = random.Random(size)
    for late, indent, n in ((False, None, 12), (True, 2, 9), (False, 1, 0), (True, None, 1)):
        doc = collection(rng, n, late, crs={"type": "name", "properties": {"name": "EPSG:3857"}})
        text = json.dumps(doc, indent=indent, ensure_ascii=rng.random() < 0.5)
        (tmp_path / "c.geojson").write_text(text, encoding="utf-8")
        file = ranges._File(str(tmp_path / "c.geojson"))
        length = len(text.encode())
        places = [(a, min(size, length - a)) for a in range(0, length, size)]
        states, system = ranges._followed([json.loads(json.dumps(ranges._summed(file, *p))) for p in places])
        assert json.loads(system)["properties"]["name"] == "EPSG:3857"
        got, numbers = [], []
        for place, state in zip(places, states):
            found = list(ranges._features(file, *place, *state[:3]))
            numbers.append((state[3], len(got)))
            got += [json.loads(f) for f in found]
        assert got == doc["features"] and all(a == b for a, b in numbers)


def test_read_by_spark(spark, tmp_path):
    rng = random.Random(1)
    for name, n in (("a.geojson", 300), ("b.geojson", 40), ("c.geojson", 0)):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(json.dumps(collection(rng, n)))
    whole = geojson.parse_collections(spark.read.text(str(tmp_path / "in"), wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name")))

    def rows(df):
        return sorted((r["file_name"], r["ord"], json.loads(r["properties"])["k"], r["x"]) for r in df.select("file_name", "ord", "properties", g.x_of(F.col("geom")).alias("x")).collect())

    split = geojson.read_geojson(spark, str(tmp_path / "in"), range_bytes=4000)
    assert rows(split) == rows(whole) and len(rows(split)) == 340
    with pytest.raises(FileNotFoundError):
        geojson.read_geojson(spark, str(tmp_path / "none"))
    (tmp_path / "cut.geojson").write_text('{"features":[{"a":1},{"b":')
    with pytest.raises(Exception, match="ends within a feature"):
        geojson.read_geojson(spark, str(tmp_path / "cut.geojson")).collect()


def test_systems(spark, tmp_path):
    points = {"EPSG:32638": (444140.54, 3684706.36), "urn:ogc:def:crs:EPSG::2154": (700000.0, 6600000.0), "urn:ogc:def:crs:OGC:1.3:CRS84": (5.0, 6.0)}
    want = {"EPSG:32638": (44.4, 33.3), "urn:ogc:def:crs:EPSG::2154": (3.0, 46.5), "urn:ogc:def:crs:OGC:1.3:CRS84": (5.0, 6.0)}
    for k, (name, (x, y)) in enumerate(points.items()):
        shape = {"type": "Polygon", "coordinates": [[[x, y], [x + 1, y], [x, y + 1], [x, y]]]}
        doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": name}},
               "features": [{"type": "Feature", "geometry": shape, "properties": {"n": name}}, {"type": "Feature", "geometry": None, "properties": {"n": "none"}}]}
        (tmp_path / f"{k}.geojson").write_text(json.dumps(doc))
    df = geojson.read_geojson(spark, str(tmp_path))
    got = {r["n"]: r for r in df.select(F.get_json_object("properties", "$.n").alias("n"), g.x_of(F.col("geom")).alias("x"), g.y_of(F.col("geom")).alias("y"), "geom.srid", g.n_points(F.col("geom")).alias("p")).collect()}
    for name, at in want.items():
        assert (got[name]["x"], got[name]["y"]) == pytest.approx(at, abs=1e-6) and got[name]["srid"] == 4326 and got[name]["p"] == 4
    (tmp_path / "bad.geojson").write_text(json.dumps({"crs": {"properties": {"name": "EPSG:99999"}}, "features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    with pytest.raises(Exception, match="99999"):
        geojson.read_geojson(spark, str(tmp_path / "bad.geojson")).select("geom").collect()
