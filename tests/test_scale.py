"""Work and memory that must not grow faster than the tables."""

import numpy as np

from geosync.functions import shapes


def test_boxes_of_all_sizes_are_not_all_looked_at(monkeypatch):
    rng = np.random.default_rng(5)
    n = 4000
    x, y = rng.random(n), rng.random(n)
    half = np.where(np.arange(n) % 500 == 0, 40.0, 0.002)
    index = shapes.Boxes(x - half, y - half, x + half, y + half)
    looked, spread = [0], shapes.spread

    def counted(starts, counts):
        looked[0] += int(counts.sum())
        return spread(starts, counts)

    monkeypatch.setattr(shapes, "spread", counted)
    at = rng.random((2, n))
    found = np.concatenate([np.stack(p, 1) for p in index.candidates(at[0], at[1], at[0] + 0.001, at[1] + 0.001)])
    low, high = at[:, :, None], at[:, :, None] + 0.001
    meet = ((x - half <= high[0]) & (low[0] <= x + half)) & ((y - half <= high[1]) & (low[1] <= y + half))
    assert sorted(map(tuple, found)) == sorted(map(tuple, np.argwhere(meet)))
    assert looked[0] < 20 * len(found)


def test_boxes_made_of_one_ring_fill_their_box(spark):
    from geosync.functions import geom as g
    from pyspark.sql import functions as F

    texts = [
        ("POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))", True), ("POLYGON ((0 0, 0 1, 2 1, 2 0, 0 0))", True), ("POINT (1 1)", True),
        ("POLYGON ((0 0, 2 0, 2 1, 1 1, 0 0))", False), ("POLYGON ((0 0, 2 0, 0 0, 2 0, 0 0))", False), ("LINESTRING (0 0, 2 0)", False),
        ("POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))", False), ("MULTIPOINT ((0 0), (1 1))", False), ("POLYGON EMPTY", False),
        ("MULTIPOLYGON (((0 0, 2 0, 2 1, 0 1, 0 0)), ((5 5, 6 5, 6 6, 5 6, 5 5)))", False), ("MULTIPOLYGON (((0 0, 2 0, 2 1, 0 1, 0 0)))", True),
    ]
    made = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "id int, wkt string").coalesce(1).select(g.from_wkt(F.col("wkt")).alias("geom"))
    assert shapes.Shapes(made.toArrow().column("geom")).fills_box().tolist() == [w for _, w in texts]


def test_a_batch_of_broken_polygons_is_cut_at_once(monkeypatch):
    import pyarrow as pa

    from geosync.functions import arrangement, planar

    def ring(*points):
        return [{"x": float(x), "y": float(y)} for x, y in points]

    def geom(k, *members):
        return {"kind": "geometrycollection", "parts": [{"kind": "polygon", "member": m, "rings": [r]} for m, r in enumerate(members)], "srid": 4326}

    bows = [ring((k, 0), (k + 2, 2), (k + 2, 0), (k, 2), (k, 0)) for k in range(200)]
    fine = ring((9, 9), (10, 9), (10, 10), (9, 10), (9, 9))
    calls, noded = [0], arrangement.noded

    def counted(*args):
        calls[0] += 1
        return noded(*args)

    monkeypatch.setattr(arrangement, "noded", counted)
    fixed = planar._examined.func(pa.array([geom(k, bow, fine) for k, bow in enumerate(bows)], planar._GEOMETRY), None).field("fixed").to_pylist()
    assert calls[0] == 1
    for k, made in enumerate(fixed):
        assert [p["member"] for p in made["parts"]] == [0, 0, 1] and made["parts"][2]["rings"] == [fine]
        assert sorted({v["x"] - k for p in made["parts"][:2] for v in p["rings"][0]}) == [0, 1, 2]


def _crowd(spark):
    """Points that all lie in 60 squares, beside some in none, one without a place and one without a key."""
    from geosync.functions import geom as g
    from pyspark.sql import functions as F

    x = F.when(F.col("id") < 150, 0.5).otherwise(9.0 + F.col("id"))
    points = spark.range(160).select(
        F.when(F.col("id") != 3, F.col("id")).alias("task_key"), F.when(F.col("id") != 4, g.point(x, F.lit(0.5))).cast(g.GEOMETRY).alias("geom")
    )
    squares = spark.range(60).select(
        F.when(F.col("id") != 7, F.col("id").cast("string")).alias("area_key"), g.polygon(g.box_ring(F.lit(0.0), F.lit(0.0), F.col("id") * 0.001 + 1, F.lit(1.0))).alias("geom")
    )
    wanted = sorted(str(k) for k in range(60) if k != 7)
    return points, squares, {k: wanted if k is not None and k < 150 and k != 4 else None for k in [*range(3), None, *range(4, 160)]}


def test_area_keys_are_gathered_where_they_are_found(spark, monkeypatch):
    from geosync.operators import spatial

    points, squares, wanted = _crowd(spark)
    gathered = spatial.area_keys(points, squares)
    assert {r["task_key"]: r["area_keys"] for r in gathered.collect()} == wanted
    plan = gathered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Join" not in plan
    dealt = spatial.area_keys(points, squares, sent=0)
    assert {r["task_key"]: r["area_keys"] for r in dealt.collect()} == wanted


def test_gathered_rows_are_halved_where_pairs_are_many(spark, monkeypatch):
    import pyarrow as pa

    from geosync.functions import geom as g
    from geosync.operators import spatial
    from pyspark.sql import functions as F

    points, squares, wanted = _crowd(spark)
    left = points.select(F.col("task_key").alias("_lid"), F.col("geom").alias("_lg"), g.bbox(F.col("geom")).alias("_lb")).toArrow().combine_chunks().to_batches()[0]
    right = spatial._Rows(spatial._boxed(squares, "area_key", "geom", "r").toArrow(), "r")
    monkeypatch.setattr(spatial, "GATHERED_PAIRS", 500)
    parts = list(spatial._gathered(left, right, shapes.Boxes(*right.box), spatial._Names(right.array("_rid"))))
    assert len(parts) > 8 and pa.concat_arrays([rows.column("_lid") for rows, _ in parts]).equals(left.column("_lid"))
    assert [v for _, lists in parts for v in lists.to_pylist()] == [wanted[k] for k in left.column("_lid").to_pylist()]


def test_dealt_pairs_are_handed_on_in_steps(spark, monkeypatch):
    from geosync.operators import spatial

    points, squares, _ = _crowd(spark)
    pairs = spatial.spatial_join(points.filter("task_key IS NOT NULL"), squares.filter("area_key IS NOT NULL"), "task_key", "area_key", sent=0)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CoGroups" not in plan and "MapInArrow" in plan
    assert pairs.count() == 148 * 59


def test_small_ranges_share_tasks_and_read_little_behind(spark, tmp_path):
    from geosync.sources import ranges

    path = tmp_path / "one.geojson"
    path.write_text('{"type":"FeatureCollection","features":[' + ",".join('{"type":"Feature","properties":{"n":%d},"geometry":null}' % k for k in range(3000)) + "]}")
    features = ranges.split_features(spark, str(path), 256)
    assert features.rdd.getNumPartitions() <= ranges.WAVES * spark.sparkContext.defaultParallelism
    assert [r["ord"] for r in features.select("ord").orderBy("ord").collect()] == list(range(3000))

    read = []

    class Counted(ranges._File):
        def read(self, start, size):
            out = super().read(start, size)
            read.append(len(out))
            return out

    start = path.read_text().index('{"type":"Feature"', 1 << 14)
    found = list(ranges._features(Counted(str(path)), start, 1 << 14, False, 2, True))
    assert len(found) > 100 and sum(read) < 3 << 14


def test_many_pages_share_tasks(tmp_path):
    import json

    from geosync.sources import paged

    for page in range(700):
        (tmp_path / f"page={page}").mkdir()
        (tmp_path / f"page={page}" / "part-0.txt").write_text(json.dumps({"features": [2 * page, 2 * page + 1]}))
    reader = paged._StreamReader({"path": str(tmp_path), "pagesize": "2"})
    spans = reader.partitions({"page": 1, "row": 1}, reader.latestOffset())
    assert len(spans) <= paged.SPANS + 1
    seen = []
    for span in spans:
        for page, before, first, last, body in reader.read(span):
            seen += [k for i, k in enumerate(json.loads(body)["features"]) if first <= before + i < last]
    assert seen == list(range(3, 1400))


def test_nfc_makes_few_python_strings_at_once(spark, monkeypatch):
    import unicodedata

    import pyarrow as pa

    from geosync.functions import text
    from pyspark.sql import functions as F

    long = "e\u0301\u1100\u1161 \u0438\u0306" * 300
    texts = spark.range(40).coalesce(1).select("id", F.when(F.col("id") % 9 != 0, F.lit(long)).alias("t"))
    rows = texts.select("id", text.nfc(F.col("t")).alias("name")).collect()
    assert [r["name"] for r in rows] == [None if k % 9 == 0 else unicodedata.normalize("NFC", long) for k in range(40)]
    held = []
    monkeypatch.setattr(text.pa, "array", lambda values, kind: held.append(len(values)) or pa.lib.array(values, kind))
    assert len(text._compose.func(pa.lib.array([long] * 1000))) == 1000 and sum(held) == 1000 and max(held) <= text.NFC_ROWS


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_key_passes_one_pattern_and_members_are_not_sliced(spark):
    from geosync.functions import jsonx, text
    from pyspark.sql import functions as F

    given = {"aBCd": "a_b_cd", "ABc9D-eF": "a_bc9_d_e_f", "__A1B": "a1_b", "éA": "a", "x\U0001f600Y": "x_y", "- -": None}
    named = spark.createDataFrame([(k,) for k in given], "k string").coalesce(1).select("k", text.to_column_name(F.col("k")).alias("n"))
    assert {r.k: r.n for r in named.collect()} == given
    assert plan_of(named).count("regexp_replace(") == 1
    doc = '{"A": 1, "b": 2, "a": 3, "attributes": {"B": 4, "c": 5, "C": 6}}'
    flat = spark.createDataFrame([(doc,)], "d string").select(jsonx.flatten_properties(F.col("d")).alias("m"))
    assert [(m["name"], m["raw"]) for m in flat.first().m] == [("a", "3"), ("b", "4"), ("c", "6")]
    assert "slice(" not in plan_of(flat)
    assert plan_of(flat).count("get_json_object(") == 1


def test_a_point_is_parsed_once(spark):
    from geosync.functions import geom as g
    from pyspark.sql import functions as F

    given = {"[1, 2]": [(1.0, 2.0)], "[1, 2, 3]": [(1.0, 2.0)], "[]": [], "[1]": None, "[1, null]": None, "null": None}
    texts = spark.createDataFrame([(c, '{"type": "Point", "coordinates": ' + c + "}") for c in given], "c string, t string")
    read = texts.select("c", g.from_geojson(F.col("t")).alias("geom"))
    found = {r.c: r.geom and [(v.x, v.y) for p in r.geom.parts for ring in p.rings for v in ring] for r in read.collect()}
    assert found == given
    assert plan_of(read).count("from_json(ArrayType(DoubleType,true)") == 1


def test_keys_of_a_place_are_added_without_a_shuffle(spark):
    from geosync.operators import spatial
    from pyspark.sql import functions as F

    points, squares, wanted = _crowd(spark)
    rows = points.select("task_key", F.col("geom").alias("at"), F.concat(F.lit("n"), "task_key").alias("note"))
    made = spatial.placed_keys(rows, "at", squares, "task_key")
    assert made.columns == ["task_key", "note", "area_keys"]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Join" not in plan
    for found in (made, spatial.placed_keys(rows, "at", squares, "task_key", sent=0)):
        assert {r["task_key"]: (r["note"], r["area_keys"]) for r in found.collect()} == {k: (None if k is None else f"n{k}", w) for k, w in wanted.items()}


def test_backfill_looks_for_keys_last(spark):
    from datetime import date

    from geosync.functions import geom as g
    from geosync.plans import items
    from pyspark.sql import functions as F

    _, squares, _ = _crowd(spark)
    areas = squares.select(F.col("area_key").alias("key"), "geom")
    services = []
    for k, name in enumerate(("permits", "earthworks")):
        # rows of both are linked to one item, which the second moves out of the areas
        rows = spark.range(3).select(
            "id", F.col("id").alias("source_id"), F.col("id").alias("global_id"), F.lit("points").alias("layer"), F.lit("h").alias("geom_hash"),
            g.point(0.5 + 40 * k * (F.col("id") % 2), F.lit(0.5)).alias("geom"), F.when(F.col("id") < 2, F.concat(F.lit("t"), "id")).alias("task_key"),
        )
        parents = rows.select("id", F.lit(False).alias("tasked"))
        services.append((items.Service(name, name, f"{name[:-1]}_id"), rows, parents))
    current = spark.createDataFrame([("t0", ["old"]), ("t1", ["old"]), ("t9", ["old"])], "key string, area_key array<string>")
    current = spark.createDataFrame([], items.ITEM_SCHEMA).unionByName(current, allowMissingColumns=True)
    made, results = items.backfill(services, current, F.lit(date(2024, 1, 1)), areas=areas)
    assert made.columns == current.columns == results["permits"]["items"].columns
    every = sorted(str(k) for k in range(60) if k != 7)
    found = {r["key"]: r["area_key"] for r in made.collect()}
    assert (found["t0"], found["t1"], found["t9"]) == (every, None, ["old"])
    assert {tuple(v or ()) for k, v in found.items() if k[0] != "t"} == {tuple(every)} and len(found) == 5
    assert {r["key"]: r["area_key"] for r in results["permits"]["items"].collect()}["t1"] == every
    # no checkpoint holds the keys
    assert "MapInArrow" in made._jdf.queryExecution().optimizedPlan().toString()
