import os
import json
import random

import pytest
from pyspark.sql import functions as F

from geosync.functions import geom as g
from geosync.operators import audit, guards, keep, links, merge, numbering, spatial

c = F.col


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_numbers_in_groups_and_overall(spark):
    rng = random.Random(3)
    data = [(i, "hot" if i % 3 == 0 else f"g{rng.randint(0, 20)}", rng.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, grp string, v int").repartition(7)
    got = numbering.number_rows(df, ["grp"], [c("v").desc(), c("id").asc()], "n").collect()
    wanted = {}
    for grp in {d[1] for d in data}:
        for n, d in enumerate(sorted((d for d in data if d[1] == grp), key=lambda d: (-d[2], d[0])), 1):
            wanted[d[0]] = n
    assert {r["id"]: r["n"] for r in got} == wanted and len(got) == len(data)
    flat = numbering.number_rows(df, [], [c("id").asc()], "n").collect()
    assert all(r["n"] == r["id"] + 1 for r in flat) and len(flat) == len(data)


@pytest.mark.parametrize("chunk", [100_000, 4])
def test_free_numbers(spark, chunk):
    rng = random.Random(5)
    used, losers, wanted = [], [], set()
    for p in range(6):
        taken = {rng.randint(1, 40) for _ in range(rng.randint(0, 25))}
        used += [(f"p{p}", n) for n in taken]
        free = (n for n in range(1, 200) if n not in taken)
        for seq in range(1, rng.randint(2, 30)):
            losers.append((f"p{p}", seq))
            wanted.add((f"p{p}", seq, next(free)))
    used.append(("other", 1))
    made = numbering.allocate_free(
        spark.createDataFrame(losers, "prefix string, seq int"), spark.createDataFrame(used, "prefix string, n int"), chunk=chunk
    )
    assert set(rows(made, "prefix", "seq", "new_n")) == wanted


def test_last_wins_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert rows(keep.last_wins(df, ["k"], [c("v")]), "k", "v") == [(1, "b"), (None, "c"), (None, "d")]


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a", "note"), (2, "b", None)], "k int, v string, local string")
    changes = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 3)], "k int, v string, ord int")
    once = merge.upsert(target, changes, ["k"], [c("ord")])
    assert rows(once, "k", "v", "local", "action") == [
        (1, "a", "note", "keep"), (2, "y", None, "update"), (3, "z", None, "insert"),
    ]
    again = merge.settle(merge.upsert(merge.settle(once), changes, ["k"], [c("ord")]))
    assert rows(again, "k", "v", "local") == rows(merge.settle(once), "k", "v", "local")


def test_mirror_counts_add_up(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "id int, v string, mine string")
    source = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "id int, v string")
    tagged = merge.mirror(target, source, "id", ["v"])
    counts = {r["action"]: r["n"] for r in merge.count_actions(tagged).collect()}
    assert counts == {"delete": 1, "update": 1, "unchanged": 1, "insert": 1}
    settled = merge.settle(tagged)
    assert rows(settled, "id", "v", "mine") == [(2, "B", "y"), (3, None, "z"), (4, "d", None)]
    assert {r["action"] for r in merge.mirror(settled, source, "id", ["v"]).collect()} == {"unchanged"}
    assert merge.settle(merge.mirror(target, source, "id", ["v"], delete_missing=False)).count() == 4


def test_match_upsert_keeps_ids(spark):
    target = spark.createDataFrame(
        [(5, 1, "h", "old", False), (7, 1, "h", "twin", False), (9, 2, "h", "frozen", True), (11, 3, "h", "gone", False)],
        "id long, global_id long, geom_hash string, v string, tasked boolean",
    )
    changes = spark.createDataFrame(
        [(1, "h", "new", 1), (2, "h", "no", 2), (4, "h", "fresh", 3), (None, "h", "a", 4), (None, "h", "b", 5), (4, "h", "fresher", 6)],
        "global_id long, geom_hash string, v string, ord int",
    )
    tagged = merge.delete_absent(merge.match_upsert(target, changes, [c("ord")]))
    assert rows(tagged, "id", "v", "action") == sorted(
        [(5, "new", "update"), (7, "twin", "delete"), (9, "frozen", "frozen"), (11, "gone", "delete"), (12, "a", "insert"),
         (13, "b", "insert"), (14, "fresher", "insert")], key=repr
    )


def test_restored_links(spark):
    made = spark.createDataFrame(
        [(1, 10, "h", None), (2, 10, "h", None), (3, 10, "h", None), (4, 20, "h", "k9"), (5, None, None, None), (6, 30, "h", None)],
        "id long, global_id long, geom_hash string, task_key string",
    )
    saved = spark.createDataFrame(
        [("k1", 10, "h", 77), ("k9", 30, "h", 78), ("k5", None, None, 5), ("k6", None, "h", 99), ("k1", 10, "h", 80)],
        "task_key string, global_id long, geom_hash string, old_id long",
    )
    done = links.restore_links(made, saved)
    # One row of three gets the key, an occupied key is not used again, no pair falls back to the id.
    assert rows(done.filter("task_key IS NOT NULL"), "id", "task_key") == [(1, "k1"), (4, "k9"), (5, "k5")]
    assert done.count() == 6


def test_links_are_one_to_one(spark):
    layer = spark.createDataFrame(
        [(1, "point:1", None, 1), (2, "point:1", None, 1), (3, "point:3", "k3", 1), (4, "point:3", None, 1), (5, "point:5", None, None)],
        "id long, bid string, task_key string, geom int",
    )
    items = spark.createDataFrame([("k1", "point:1"), ("k3", "point:3"), ("k5", "point:5")], "key string, permit_id string")
    done = links.link_once(layer, items, "bid", "permit_id")
    assert rows(done, "id", "task_key") == [(1, "k1"), (2, None), (3, "k3"), (4, None), (5, None)]


def test_fallback_only_without_first_match(spark):
    target = spark.createDataFrame([("a", "x", None), (None, "a", None), (None, "b", None)], "order_name string, order string, who string")
    source = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "no string, who string")
    matched = links.fallback_match(source, target, "no", "order_name", "order")
    assert rows(matched, "no", "match") == [("a", "first"), ("b", "second"), ("c", "missing")]
    done = links.apply_fallback(target, matched, "no", "order_name", "order", ["who"])
    assert rows(done, "order_name", "order", "who") == sorted([("a", "x", "A"), (None, "a", None), (None, "b", "B")], key=repr)


def test_guarded_delete_warns(spark):
    items = spark.createDataFrame([(str(i), ["etl"] if i < 5 else ["user"]) for i in range(120)], "key string, user_created array<string>")
    tagged, report = guards.guarded_delete(items, items.select("key"))
    assert tuple(report.first()) == (115, 5, True)
    assert tagged.filter("action = 'blocked'").count() == 5


def test_lost_links_raise(spark):
    before = spark.createDataFrame([("a",), ("b",)], "task_key string")
    audit.require_links(before, before)
    with pytest.raises(RuntimeError):
        audit.require_links(before, before.limit(1))


def test_evolving_keeps_old_types(spark):
    target = spark.createDataFrame([(1, 2)], "id int, n int")
    new = spark.createDataFrame([(2, "x", True)], "id int, n string, b boolean")
    grown = merge.evolve(target, new)
    assert dict(grown.dtypes) == {"id": "int", "n": "int", "b": "boolean"}
    assert rows(grown, "id", "n", "b") == [(1, 2, None), (2, None, True)]


def test_null_keys_always_insert(spark):
    target = spark.createDataFrame([(None, "old"), (1, "a")], "k int, v string")
    changes = spark.createDataFrame([(None, "x", 1), (None, "y", 2), (1, "b", 3)], "k int, v string, ord int")
    done = merge.upsert(target, changes, ["k"], [c("ord")])
    assert rows(done, "k", "v", "action") == sorted(
        [(None, "old", "keep"), (None, "x", "insert"), (None, "y", "insert"), (1, "b", "update")], key=repr
    )


def test_null_keys_are_inserted_and_never_refused(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    changes = spark.createDataFrame([("a", 2), (None, 3), (None, 4), ("b", 5), ("b", 6), (None, 7)], "k string, v int")
    added = merge.insert_absent(target, changes, ["k"], [c("v")])
    assert rows(added, "k", "v") == sorted([("a", 1), (None, 3), (None, 4), ("b", 5), (None, 7)], key=repr)
    done, refused = merge.insert_only(target, changes, ["k"], [c("v")])
    assert rows(done, "k", "v") == rows(added, "k", "v")
    assert rows(refused, "k", "v") == [("a", 2), ("b", 6)]


def test_doubled_source_keys_do_not_double_the_target(spark):
    target = spark.createDataFrame([(1, 0), (2, 0), (None, 0)], "k int, v int")
    source = spark.createDataFrame([(1, 5), (1, 4), (None, 9), (3, 1)], "k int, v int")
    assert rows(merge.update_from(target, source, ["k"], ["v"]), "k", "v", "action") == sorted([(1, 4, "update"), (2, 0, "keep"), (None, 0, "keep")], key=repr)
    merged = merge.mirror(target.dropna(), source.dropna(), "k", ["v"])
    assert rows(merged, "k", "v", "action") == [(1, 5, "update"), (2, 0, "delete"), (3, 1, "insert")]


def test_a_taken_item_does_not_hide_a_free_one(spark):
    layer = spark.createDataFrame([(1, "x", None, 1), (2, "y", "k1", 1)], "id int, bid string, task_key string, geom int")
    items = spark.createDataFrame([("k1", "x"), ("k2", "x")], "key string, permit_id string")
    done = links.link_once(layer, items, "bid", "permit_id")
    assert rows(done, "id", "task_key", "action") == [(1, "k2", "update"), (2, "k1", "keep")]


def test_json_text_is_escaped(spark):
    from geosync.functions import jsonx

    texts = ['a\\b', 'x"y', "line\nbreak", "plain", "tab\t"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    made = df.select("v", jsonx.coerce(c("v"), F.lit("str"), "json").alias("j")).collect()
    assert [json.loads(r["j"]) for r in made] == [r["v"] for r in made]


def test_radius_across_the_meridian(spark):
    from geosync.functions import geom as g

    df = spark.createDataFrame([(1, 179.999), (2, -179.999), (3, 179.9)], "id int, lon double").withColumn("geom", g.point(c("lon"), F.lit(0.0)))
    for centre in (179.999, -179.999):
        assert sorted(r["id"] for r in spatial.radius_search(df, 0.0, centre, 1000).collect()) == [1, 2]


def square(x, y, half):
    return f"POLYGON (({x - half} {y - half}, {x + half} {y - half}, {x + half} {y + half}, {x - half} {y + half}, {x - half} {y - half}))"


def test_boxes_of_any_size_meet_once(spark):
    from geosync.functions import grid

    rng = random.Random(3)
    sizes = [0.001, 0.02, 0.3, 4.0, 170.0, 3_000_000.0]
    sides = []
    for key in ("a", "b"):
        rows = [(i, rng.uniform(-60, 60), rng.uniform(-60, 60), rng.choice(sizes)) for i in range(60)]
        # Many at one place, so that its cells are split on either side.
        rows += [(100 + i, 10.0, 10.0, 0.001) for i in range(15)]
        shapes = spark.createDataFrame([(i, square(x, y, h)) for i, x, y, h in rows] + [(999, None)], f"{key} int, wkt string")
        sides.append((rows, shapes.select(key, g.from_wkt(c("wkt")).alias("geom"))))
    (left, l), (right, r) = sides
    wanted = sorted(
        (i, k) for i, x, y, h in left for k, u, v, w in right if abs(x - u) <= h + w and abs(y - v) <= h + w
    )
    for hot, sent in ((4, 0), (1_000_000, 0), (1_000_000, spatial.SENT)):
        got = sorted(tuple(x) for x in spatial.spatial_join(l, r, "a", "b", cell=0.05, hot_rows=hot, sent=sent).collect())
        assert got == wanted
    assert spatial.spatial_join(l, r.limit(0), "a", "b", sent=-1).isEmpty() and spatial.spatial_join(l.filter("a = 999"), r, "a", "b", sent=0).isEmpty()
    assert spatial.spatial_join(l, r.limit(0), "a", "b").isEmpty() and spatial.spatial_join(l.filter("a = 999"), r, "a", "b").isEmpty()
    cells = l.withColumn("box", g.bbox(c("geom"))).select(F.size(grid.cover(c("box"), 0.05, grid.level_of(c("box"), 0.05))).alias("n"))
    assert cells.agg(F.max("n")).first()[0] <= 4


def test_items_keep_keys_of_other_tables(spark):
    from geosync.plans import items as item_jobs

    have = spark.createDataFrame([("k1", ["gone"]), ("k2", ["old"]), ("k3", ["gone"])], "key string, area_key array<string>")
    found = spark.createDataFrame([("k1", 0.5), ("k3", 50.0)], "task_key string, x double").select(
        "task_key", g.point(c("x"), c("x")).alias("geom"), F.lit(0).alias("prio"), F.lit("t").alias("source"), F.lit(1).alias("row_id")
    )
    zones = spark.createDataFrame([(7, square(0.5, 0.5, 0.2))], "key int, wkt string").select("key", g.from_wkt(c("wkt")).alias("geom"))
    got = {x["key"]: x["area_key"] for x in item_jobs.tag_areas(have, found, zones).collect()}
    assert got == {"k1": ["7"], "k2": ["old"], "k3": None}


def test_radius_at_the_poles(spark):
    rows = [(1, 0.0, 89.99), (2, 120.0, 89.99), (3, -120.0, 89.99), (4, 10.0, 89.9), (5, 0.0, -89.99)]
    df = spark.createDataFrame(rows, "id int, lon double, lat double").withColumn("geom", g.point(c("lon"), c("lat")))
    assert sorted(r["id"] for r in spatial.radius_search(df, 89.99, 0.0, 5000).collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in spatial.radius_search(df, -90.0, 77.0, 5000).collect()) == [5]
    near = spatial.radius_search(df, 89.95, 0.0, 4600)
    assert near.columns == df.columns and [r["id"] for r in near.collect()] == [1]


def test_refused_changes_are_all_counted(spark):
    target = spark.createDataFrame([("a", 0)], "k string, v int")
    changes = spark.createDataFrame([("b", 1, 7), ("b", 1, 7), ("b", 1, 3), ("a", 5, 5), ("a", 5, 5), (None, 1, 1), (None, 1, 1), ("c", 2, None)], "k string, v int, w int")
    done, refused = merge.insert_only(target, changes, ["k"], [c("v")])
    assert sorted(map(tuple, refused.collect())) == [("a", 5, 5), ("a", 5, 5), ("b", 1, 7), ("b", 1, 7)]
    assert sorted(map(tuple, done.select("k", "v").collect()), key=repr) == sorted([("a", 0), ("b", 1), ("c", 2), (None, 1), (None, 1)], key=repr)


def test_clearing_is_checked_against_what_was_written(spark):
    snapshots = spark.createDataFrame([("new", "t1"), ("new", "t2"), ("old", "t1"), ("old", None)], "status string, task_key string")
    items = spark.createDataFrame([("t1", 1), ("t2", 2)], "key string, n int")
    keys = spark.createDataFrame([("t1",), (None,)], "task_key string")
    kept, report = guards.clear_snapshots(snapshots, keys, items)
    report = spark.createDataFrame(report.collect(), report.schema)
    before = guards.items_state(items, keys)
    guards.check_cleared(report, before, kept, keys, items)
    wrong = [
        (snapshots, items), (kept.filter("task_key IS NOT NULL"), items), (kept.limit(0), items),
        (kept, items.withColumn("n", c("n") + 1)), (kept, items.filter("key <> 't1'")),
    ]
    for written, now in wrong:
        with pytest.raises(RuntimeError):
            guards.check_cleared(report, before, written, keys, now)


def test_staged_tables_belong_to_their_block(spark, tmp_path):
    from geosync import session

    def folders():
        return {f.rpartition("/")[0].removeprefix("file:") for f in made.inputFiles()}

    df = spark.range(3)
    with session.staging(spark):
        made = session.stage(df, "outer")
        outer = folders()
        with session.staging(spark):
            made = session.stage(df, "inner")
            inner = folders()
        assert not any(os.path.exists(f) for f in inner) and all(os.path.exists(f) for f in outer)
    assert not any(os.path.exists(f) for f in outer)
    assert session.shared_folder(spark) == session.shared_folder(spark)
