import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.plans import areas, features, items, mirrors, photos
from geosync.sources import buckets, geojson, paged, runlog, versions
from geosync.sources.paged import paged_features
from geosync.streaming import inbox

c = F.col
DAY = date(2024, 6, 15)
SERVICE = items.Service("permits", "Permits", "permit_id")
TABLE = f"id bigint, geom {g.GEOMETRY}, geom_hash string, global_id bigint, loaded_at timestamp, tasked boolean, derived_from_id bigint, task_key string"
LAYERS = f"id bigint, layer string, geom {g.GEOMETRY}, geom_hash string, global_id bigint, source_id bigint, derived_from_id bigint, task_key string, loaded_at timestamp"


def load(spark, rows):
    data = [(json.dumps({"attributes": p}), w, i) for i, (p, w) in enumerate(rows)]
    df = spark.createDataFrame(data, "properties string, wkt string, ord int")
    return df.select("properties", g.from_wkt(c("wkt")).alias("geom"), "ord")


RING = "LINESTRING (37.6 55.75, 37.602 55.75, 37.602 55.751, 37.6 55.751, 37.6 55.75)"


def test_load_keeps_ids_and_links(spark):
    first = load(spark, [
        ({"global_id": 1, "WorkEndDate": "2030-01-01"}, "POINT (37.6 55.7)"),
        ({"global_id": 2, "WorkEndDate": "2030-01-01"}, RING),
        ({"global_id": 3, "WorkEndDate": "01.01.2020"}, "POINT (37.7 55.7)"),
    ])
    empty = spark.createDataFrame([], items.ITEM_SCHEMA)
    rule = features.PurgeRule("work_end_date", "date")
    done = features.load_preserving(
        first, spark.createDataFrame([], TABLE), spark.createDataFrame([], LAYERS), empty, SERVICE, rule, F.lit(DAY)
    )
    table = [tuple(r) for r in done["table"].select("id", "global_id", "derived_from_id", "tasked").orderBy("id").collect()]
    # The expired permit is gone, the closed line has a polygon, and all parents are linked.
    assert table == [(1, 1, None, True), (2, 2, None, True), (4, 2, 2, True)]
    linked = {r["layer"]: r["task_key"] for r in done["layers"].collect()}
    assert set(linked) == {"points", "lines", "polygons"} and all(linked.values())
    assert done["items"].filter("source_row_id IS NOT NULL").count() == 3

    second = load(spark, [({"global_id": 2, "WorkEndDate": "2030-01-01"}, RING), ({"global_id": 5, "Note": "n"}, "POINT (37.9 55.7)")])
    again = features.load_preserving(second, done["table"], done["layers"], done["items"], SERVICE, rule, F.lit(DAY))
    # Frozen rows stay although they are absent, their links too, and the new row gets a new id.
    ids = {r["id"]: r["global_id"] for r in again["table"].collect()}
    assert ids == {1: 1, 2: 2, 4: 2, 5: 5} and "note" in again["table"].columns
    kept = {r["layer"]: r["task_key"] for r in again["layers"].filter("global_id <> 5").collect()}
    assert kept == linked and again["items"].count() == 4


def photo(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, uuid string, cam_id string, disruption boolean")
    return df.withColumn("geom", g.point(c("id"), c("id")))


def test_photo_items_are_reused_per_camera(spark):
    have = spark.createDataFrame(
        [("a", "u1", ["etl"], None), ("b", "u2", ["user"], None), ("c", "u3", ["etl"], True)],
        "key string, photo_id string, user_last_edit array<string>, field_observed boolean",
    )
    current = spark.createDataFrame([], items.ITEM_SCHEMA).unionByName(have, allowMissingColumns=True)
    seen = photo(spark, [
        (1, "u1", "cam1", True), (2, "u2", "cam2", True), (3, "u3", "cam3", True), (4, "u4", "cam1", True), (5, "u5", "cam2", True),
        (6, "u6", "cam2", True), (7, "u7", None, True), (8, "u8", "cam1", False), (9, " ", "cam9", True),
    ])
    done = items.sync_photo_items(seen, current, "Photos", "photos", F.lit(DAY))
    counts = {r["step"]: r["n"] for r in done["counts"].collect()}
    got = {r["key"]: r["photo_id"] for r in done["items"].collect()}
    # cam1 reuses its item for u4; cam2's item is the user's, so its newest photo makes one; so does u7.
    assert got["a"] == "u4" and got["b"] == "u2" and sorted(got.values()) == ["u2", "u3", "u4", "u6", "u7"]
    assert counts == {"updated": 1, "inserted": 2, "anchored": 4}
    again = items.sync_photo_items(seen, done["items"], "Photos", "photos", F.lit(DAY))
    assert {r["step"]: r["n"] for r in again["counts"].collect()} == {"updated": 0, "inserted": 0, "anchored": 0}


def box(x0, y0, x1, y1):
    return f"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def test_numbers_and_repair(spark):
    district = spark.createDataFrame([(1, "ЦАО", "Центральный", "Тверской", box(37, 55, 38, 56)), (2, None, " ", "Пустой", box(38, 55, 39, 56))],
                                     "gid int, okrug_shor string, okrug string, rayon string, wkt string").withColumn("geom", g.from_wkt(c("wkt")))
    rows = [("a", box(37.1, 55.1, 37.2, 55.2), None, None, "free"), ("b", box(37.3, 55.5, 37.4, 55.6), None, None, "done"),
            ("c", box(38.1, 55.1, 38.2, 55.2), None, "x", "free"), ("d", box(37.9, 55.1, 38.1, 55.2), "САО", "Край - 2", "wip"), ("e", None, "САО", "y", "free")]
    zone = spark.createDataFrame(rows, "key string, wkt string, okrug_shor string, rayon string, status string").withColumn("geom", g.from_wkt(c("wkt"))).withColumn(
        "okrug", F.lit(None).cast("string")).withColumn("task_number", F.when(c("key") == "c", "old-7")).withColumn("area", F.lit(0.0))
    numbered, report = areas.number_areas_job(zone, district, F.lit(DAY))
    got = {r["key"]: r["task_number"] for r in numbered.collect()}
    assert got == {"a": "М/ЦАО-24-2/Тверской-2", "b": "М/ЦАО-24-2/Тверской-1", "c": "old-7", "d": "М/САО-24-2/Край_2-1", "e": None}
    assert report.first()["n"] == 0
    doubled = numbered.withColumn("task_number", F.when(c("key").isin("a", "b", "d"), "p-1").when(c("key") == "c", "p-2"))
    fixed = {r["key"]: r["task_number"] for r in areas.repair_numbers(doubled, district).collect()}
    assert fixed == {"b": "p-1", "d": "p-3", "a": "p-4", "c": "p-2", "e": None}
    clean = areas.repair_numbers(areas.repair_numbers(doubled, district).drop("action"), district)
    assert clean.filter("action = 'update'").count() == 0


def test_reactivation_needs_one_district(spark):
    district = spark.createDataFrame([(1, "Солнечный", box(0, 0, 1, 1)), (2, "Лунный", box(2, 0, 3, 1))], "gid int, rayon string, wkt string").withColumn("geom", g.from_wkt(c("wkt")))
    places = spark.createDataFrame([("k1", "POINT (0.5 0.5)"), ("k2", "POINT (2.5 0.5)")], "task_key string, wkt string").select("task_key", g.from_wkt(c("wkt")).alias("geom"))
    snapshots = spark.createDataFrame([("clear", "k1", None), ("clear", "k2", None), ("delay", "k3", "СОЛНЕЧНЫЙ")], "status string, task_key string, rayon string")
    work = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string")
    kept, report = areas.reactivate("солнеч", work, places, district, snapshots)
    assert [r["task_key"] for r in kept.collect()] == ["k2"]
    assert {tuple(r) for r in report.collect()} == {("clear", 2, 1, 1, 2), ("delay", 1, 1, 0, 2)}
    with pytest.raises(ValueError):
        areas.reactivate("ный", work, places, district, snapshots)


def test_labels_follow_the_high_water(spark):
    source = spark.createDataFrame(
        [(i, " РАЗР 5 " if i % 2 else "дом", str(i), "POINT (100 200)") for i in range(1, 8)] + [(9, "яма", None, "POINT (1 1)"), (10, "ЯМА", "10", None)],
        "fid bigint, label string, number string, wkt string",
    ).withColumn("geom", g.from_wkt(c("wkt"), 980077))
    target = spark.createDataFrame([], f"label_text string, filter_pass string, source_json string, lon double, lat double, geometry {g.GEOMETRY}, source_fid bigint, loaded_at timestamp")
    wanted = mirrors.by_keyword(c("label"))
    first = mirrors.ingest_labels(source, target, "topo", wanted, F.lit(DAY), bootstrap=2)
    assert sorted(r["source_fid"] for r in first["table"].collect()) == [5, 7]
    assert {r["fid"] for r in first["rejects"].collect()} == {9, 10}
    more = source.unionByName(source.filter("fid = 7").withColumn("fid", F.lit(12).cast("long")))
    second = mirrors.ingest_labels(more, first["table"], "topo", wanted, F.lit(DAY))
    assert {r["action"]: r["n"] for r in second["counts"].collect()} == {"keep": 1, "update": 1}
    assert sorted(r["source_fid"] for r in second["table"].collect()) == [5, 12]


def test_inbox_applies_files_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("order_no,date,executor\nN1,2026-08-12,Old\nN1,12.08.2026,New\n,2026-08-12,X\nN2,bad,Y\nN3,45292,\nO2,45292,Second\nZ,1/2/2026,Lost\n")
    (folder / "~$b.csv").write_text("order_no,date,executor\nN1,2026-08-12,Locked\n")
    target = spark.createDataFrame([("N1", "O1", None, None), (None, "O2", None, None)], "order_name string, order string, assigned_on date, executor string")
    buckets.create(target, f"{tmp_path}/target", ["order"])
    for _ in range(2):
        inbox.inbox_stream(spark, str(folder), f"{tmp_path}/target", f"{tmp_path}/log", f"{tmp_path}/cp", once=True).awaitTermination()
    got = {r["order"]: (r["assigned_on"], r["executor"]) for r in buckets.read(spark, f"{tmp_path}/target").collect()}
    assert got == {"O1": (date(2026, 8, 12), "New"), "O2": (date(2024, 1, 1), "Second")}
    log = spark.read.parquet(f"{tmp_path}/log").first()
    assert (log["rows"], log["filled_first"], log["filled_second"], log["missing"], log["skipped_rows"]) == (3, 1, 1, 1, 3)
    assert versions.current_version(spark, f"{tmp_path}/target/list") == 2


def test_inbox_rewrites_the_buckets_of_its_matches(spark, tmp_path):
    target = spark.range(400).select(
        c("id"), F.concat(F.lit("N"), "id").alias("order_name"), F.concat(F.lit("O"), "id").alias("order"),
        F.lit(None).cast("date").alias("assigned_on"), F.lit(None).cast("string").alias("executor"),
    )
    root = f"{tmp_path}/target"
    buckets.create(target, root, ["id"], buckets=32)
    before = set(buckets.read(spark, root).inputFiles())
    rows = spark.createDataFrame([("N3", "2026-08-12", "A"), ("O5", "2026-08-12", "B"), ("N7", "2026-08-12", "C"), ("none", "2026-08-12", "D")], inbox.ASSIGNMENT)
    rows = rows.withColumn("file_name", F.lit("f")).withColumn("ord", F.struct(F.lit(0).alias("block"), F.lit(1).alias("row")))
    for _ in range(2):  # run again, the same
        log, touched = inbox.apply_to_buckets(rows, root)
        assert 0 < len(touched) <= 3 and log.first()["missing"] == 1
    after = set(buckets.read(spark, root).inputFiles())
    assert len(before) == len(after) == 32 and len(before - after) == len(touched)
    table = {r["id"]: r["executor"] for r in buckets.read(spark, root).collect()}
    assert len(table) == 400 and {k: v for k, v in table.items() if v} == {3: "A", 5: "B", 7: "C"}
    assert inbox.apply_to_buckets(rows.limit(0), root)[1] == []


def test_buckets(spark, tmp_path):
    root = f"{tmp_path}/t"
    rows = spark.createDataFrame([(k, f"v{k}") for k in range(50)] + [(None, "no key")], "k long, v string")
    buckets.create(rows, root, ["k"], buckets=8)
    assert sorted(map(tuple, buckets.read(spark, root).collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
    touched = buckets.touched_by(spark.createDataFrame([(4,), (4,), (9,)], "k long"), root)
    some = buckets.read(spark, root, touched)
    assert len(some.inputFiles()) == len(touched) <= 2
    with pytest.raises(ValueError):
        buckets.replace(buckets.read(spark, root), root, touched)
    # a write that was not committed is not seen, and the next one takes its place
    assert buckets.read(spark, root).count() == 51
    assert buckets.replace(some.filter("k <> 4"), root, touched) == len(touched)
    assert buckets.read(spark, root).count() == 50 and buckets.read(spark, root).filter("k = 4").isEmpty()
    assert buckets.replace(some.limit(0), root, touched) == len(touched)
    assert buckets.read(spark, root, touched).isEmpty() and buckets.read(spark, root, touched).schema == rows.schema
    buckets.create(rows.limit(0), f"{tmp_path}/none", ["k"])
    assert buckets.read(spark, f"{tmp_path}/none").isEmpty()


def test_paged_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    def write(page, features, part=0):
        (tmp_path / "pages" / f"page={page}").mkdir(parents=True, exist_ok=True)
        body = {"features": [{"geometry": None, "properties": {"rowNo": k}} for k in features]}
        (tmp_path / "pages" / f"page={page}" / f"part-{part}.txt").write_text(json.dumps(body))

    paths = [f"{tmp_path}/{x}" for x in ("pages", "rows", "types", "cp")]
    write(0, [0, 1])
    write(1, [2], 0)
    write(1, [3, 4], 1)
    write(3, [7])  # not before page 2 is there
    inbox.paged_stream(spark, *paths, once=True).awaitTermination()
    assert sorted((r["page"], r["ord"], r["row_no"]) for r in spark.read.parquet(paths[1]).collect()) == [(0, 0, 0), (0, 1, 1), (1, 0, 2), (1, 1, 3), (1, 2, 4)]
    write(2, [5, 6])
    for _ in range(2):
        inbox.paged_stream(spark, *paths, once=True).awaitTermination()
    assert sorted(r["row_no"] for r in spark.read.parquet(paths[1]).collect()) == list(range(8))


def test_offsets_of_a_growing_service(monkeypatch):
    size, asked = 5, []
    total = [0]

    def load(self, page):
        asked.append(page)
        return json.dumps({"features": list(range(page * size, min(total[0], (page + 1) * size)))})

    monkeypatch.setattr(paged._Reader, "_load", load)
    reader = paged._StreamReader({"path": "http://service/x", "pagesize": str(size)})
    at, seen = reader.initialOffset(), []
    for n in (0, 3, 5, 12, 12, 2003):
        total[0] = n
        asked.clear()
        end = reader.latestOffset()
        assert (end["page"], end["row"]) == (n // size, n % size) and len(asked) < 30
        for span in reader.partitions(at, end):
            for page, before, first, last, body in reader.read(span):
                seen += [k for i, k in enumerate(json.loads(body)["features"]) if first <= before + i < last]
        at = end
        assert seen == list(range(n))
    # started again, and a span read again: the same rows
    again = paged._StreamReader({"path": "http://service/x", "pagesize": str(size)})
    spans = again.partitions({"page": 1, "row": 2}, {"page": 2, "row": 1})
    assert [(s.page, s.first, s.last) for s in spans] == [(1, 2, None), (2, 0, 1)]


def test_pages_are_all_read(spark, tmp_path):
    for page, n in enumerate([3, 3, 3, 3, 1]):
        (tmp_path / f"page={page}").mkdir()
        (tmp_path / f"page={page}" / "part-0.txt").write_text(json.dumps({"data": [{"k": page * 3 + i} for i in range(n)]}))
    for stripes in (1, 3):
        df = paged_features(spark, str(tmp_path), page_size=3, stripes=stripes)
        assert sorted(json.loads(r["feature"])["k"] for r in df.collect()) == list(range(13))
    (tmp_path / "page=1" / "part-1.txt").write_text(json.dumps([{"k": 13}, {"k": 14}]))
    df = paged_features(spark, f"file://{tmp_path}", page_size=3)
    assert sorted((r["page"], r["idx"]) for r in df.collect())[3:8] == [(1, k) for k in range(5)] and df.count() == 15
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty" / "page=7").mkdir(parents=True)
        (tmp_path / "empty" / "page=7" / "part-0.txt").write_text("[]")
        paged_features(spark, str(tmp_path / "empty"))


def test_geojson_files(spark, tmp_path):
    doc = {"type": "FeatureCollection", "crs": {"properties": {"name": "urn:ogc:def:crs:EPSG::3857"}},
           "features": [{"geometry": {"type": "Point", "coordinates": [4187591.9, 7509137.6]}, "properties": {"a": 1}}, {"geometry": None, "properties": {"a": 2.5}}]}
    (tmp_path / "x.geojson").write_text(json.dumps(doc))
    df = geojson.read_geojson(spark, str(tmp_path / "x.geojson"))
    typed, types = geojson.typed_features(df)
    assert types == [("a", "double")]
    rows = typed.select("a", g.x_of(c("geom")).alias("x")).orderBy("ord").collect()
    assert rows[0]["x"] == pytest.approx(37.6176, abs=1e-3) and rows[1]["x"] is None
    geojson.write_geojson(typed, str(tmp_path / "out"), ["a"])
    assert geojson.read_geojson_lines(spark, str(tmp_path / "out")).count() == 2


def test_run_log(spark, tmp_path):
    run = runlog.log_run(spark, f"{tmp_path}/log", "load", "running", "started")
    runlog.log_run(spark, f"{tmp_path}/log", "load", "success", "done", 5, run)
    row = runlog.runs(spark.read.parquet(f"{tmp_path}/log")).first()
    assert (row["status"], row["rows_affected"]) == ("success", 5) and row["finished_at"] >= row["started_at"]


def test_uploaded_outcomes_stand(spark):
    log = spark.createDataFrame([("a", "uploaded", "id1"), ("b", "failed", "id2")], "source_relpath string, status string, photo_uuid string")
    new = spark.createDataFrame([("a", "failed", None, 1), ("b", "uploaded", None, 2), ("c", "failed", None, 3)], "source_relpath string, status string, photo_uuid string, ord int")
    done = {r["source_relpath"]: (r["status"], r["photo_uuid"]) for r in photos.record_outcomes(log, new, [c("ord")]).collect()}
    assert done == {"a": ("uploaded", "id1"), "b": ("uploaded", "id2"), "c": ("failed", None)}


def test_touched_items_are_refreshed(spark, tmp_path):
    from geosync.streaming.refresh import refresh_stream

    zones = spark.createDataFrame([("z1", box(0, 0, 1, 1)), ("z2", box(0.5, 0, 2, 1))], "area_key string, wkt string").select("area_key", g.from_wkt(c("wkt")).alias("geom"))
    places = spark.createDataFrame([("a", 0.7, 0.5), ("b", 0.2, 0.5), ("c", 9.0, 9.0)], "task_key string, x double, y double").select("task_key", g.point(c("x"), c("y")).alias("geom"))
    spark.createDataFrame([("a",), ("c",), ("a",), (None,)], "task_key string").write.parquet(f"{tmp_path}/changes")
    changes = spark.readStream.schema("task_key string").parquet(f"{tmp_path}/changes")
    buckets.create(places, f"{tmp_path}/places", ["task_key"])
    refresh_stream(changes, f"{tmp_path}/places", zones, f"{tmp_path}/out", f"{tmp_path}/cp", cell=0.3).awaitTermination()
    touched = buckets.touched_by(spark.createDataFrame([("a",)], "task_key string"), f"{tmp_path}/places")
    assert len(buckets.read(spark, f"{tmp_path}/places", touched).inputFiles()) == 1 < len(buckets.read(spark, f"{tmp_path}/places").inputFiles())
    got = {r["task_key"]: r["area_keys"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"a": ["z1", "z2"], "c": None}
