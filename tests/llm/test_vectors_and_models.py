"""Sharding, nearest neighbours and co-training."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geosync.llm import neighbours, quality, sharding


def plain_table(shards, slots):
    orders = []
    for shard in shards:
        digest = hashlib.md5(shard.encode()).digest()
        offset, skip = int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1
        orders.append(iter([(offset + k * skip) % slots for k in range(slots)]))
    table = {}
    while len(table) < slots:
        for k, order in enumerate(orders):
            slot = next((s for s in order if s not in table), None)
            if slot is not None:
                table[slot] = k
    return [table[s] for s in range(slots)]


def test_table():
    shards = tuple(f"s{k}" for k in range(7))
    table = sharding.fill_table(shards, 211)
    assert table == plain_table(shards, 211)
    sizes = Counter(table).values()
    assert max(sizes) - min(sizes) <= 1
    fewer = sharding.fill_table(shards[:-1], 211)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 211 // 4
    heavy = Counter(sharding.fill_table(shards, 211, {"s0": 3}))
    assert heavy[0] > 2 * heavy[1]
    for bad in ((shards, 210), ((), 211), (("a", "a"), 211)):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_placement(messy, nothing):
    placed = sharding.place(messy, "doc_id")
    assert placed.columns[-2:] == ["slot", "shard"] and placed.count() == messy.count()
    table = sharding.fill_table(sharding.SHARDS, sharding.SLOTS)
    for r in placed.collect():
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.place(nothing, "doc_id").count() == 0


def brute(vectors, queries, nearest):
    out = {}
    for q, v in queries:
        scores = sorted((-float(np.dot(v, w) / np.sqrt(np.dot(v, v) * np.dot(w, w))), i) for i, w in vectors if i != q)
        out[q] = [(i, -s) for s, i in scores[:nearest]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_ranking_all_is_exact(spark):
    draw = np.random.RandomState(0)
    rows = [(int(k), draw.randn(8).round(1).tolist()) for k in range(300)]
    rows += [(k, rows[7][1]) for k in range(1000, 1400)]  # one very common vector
    odd = [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] + [1.0] * 7), (2005, [None] + [1.0] * 7), (2006, [1.0] * 3), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd + rows[:5]], "vec_id long, vector array<double>, score string")
    usable = [(i, np.array(v)) for i, v in rows]
    got = found(neighbours.search(df, "vec_id % 50 = 0", neighbours.Index(ranked=1000, asked=3)))
    want = brute(usable, [(i, v) for i, v in usable if i % 50 == 0], 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [round(s, 12) for _, s in got[q]] == [round(s, 12) for _, s in want[q]]
        # equal vectors tie exactly: the smallest ids win
        if want[q][0][1] > 0.999999:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, vector array<double>")
    assert [i for i, _ in found(neighbours.search(few, "vec_id = 0"))[0]] == [2, 1]
    assert neighbours.search(few.where("vec_id > 9"), "true").count() == 0
    assert neighbours.search(few.where("vec_id = 0"), "true").count() == 0


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    index = neighbours.Index(sample=1_000, cell_part=20, bucket=150, asked=30)
    rows = [(r[0], np.array(r[1], float)) for r in vectors.collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 5)
    got = found(neighbours.search(vectors, "vec_id % 20 = 0", index))
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert all(len(hit) == 5 for hit in got.values())
    exact = dict(rows)
    for q, hit in list(got.items())[:20]:
        for i, s in hit:
            assert s == pytest.approx(exact[q] @ exact[i] / np.sqrt((exact[q] @ exact[q]) * (exact[i] @ exact[i])), abs=1e-14)


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_recall_with_production_parameters(spark, scale):
    vectors = spark.read.parquet(f"/root/testdata/sf{scale}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    rows = [(r[0], np.array(r[1], float)) for r in vectors.collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = found(neighbours.search(vectors, "vec_id % 50 = 0"))
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    print("recall", hits / (5 * len(want)))
    assert 0.9 * 5 * len(want) <= hits and all(len(hit) == 5 for hit in got.values())


def test_cells_come_by_summed_distance():
    draw = np.random.RandomState(1)
    own = neighbours.Quantiser((draw.randn(6, 3), draw.randn(5, 3)), 6, np.ones(30, int))
    q = draw.randn(6)
    sums = (neighbours.squared(q[None, :3], own.halves[0]).T + neighbours.squared(q[None, 3:], own.halves[1])).ravel()
    walked = own.walk(q, 30)
    assert sorted(walked) == list(range(30)) and np.all(np.diff(sums[walked]) >= 0)
    assert own.walk(q, 4) == walked[:4]


def labelled(spark):
    draw = random.Random(4)
    words = "the people of this house walk often along rivers and talk about gardens".split()
    rows, marks = [], []
    for k in range(600):
        good = k % 3 > 0
        text = " ".join(draw.choice(words) for _ in range(60))
        if not good:
            text = " ".join(f"{w.upper()}!!" for w in text.split()) if k % 2 else "buy now " * 40
        rows.append((k, text, "en", "src1" if good == (draw.random() < 0.9) else "src2", len(text)))
        marks += [(k, int(good), 0)] if k % 2 == 0 or k % 5 == 0 else []
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(marks + marks[:20] + [(None, 1, 0), (3, None, 0), (9, 7, 0)], "doc_id long, quality int, toxic int")


def test_co_training_on_rows_without_label(spark):
    docs, labels = labelled(spark)
    known = {r["doc_id"] for r in labels.where("quality IN (0, 1)").collect()}
    rows = [r for r in quality.score(docs, labels).collect() if r["doc_id"] not in known]
    assert len(rows) > 200
    assert sum(r["kept"] == (r["doc_id"] % 3 > 0) for r in rows) >= 0.98 * len(rows)
    assert sum((r["meta_score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in rows) >= 0.8 * len(rows)


def test_co_training_with_odd_input(spark, messy, nothing):
    docs, labels = labelled(spark)
    rows = quality.score(messy, labels.withColumn("doc_id", labels["doc_id"] % 60)).collect()
    assert len(rows) == messy.count() and all(0 <= r[c] <= 1 for r in rows for c in ("text_score", "meta_score", "score"))
    assert quality.score(nothing, labels).count() == 0
    unknown = quality.score(messy, labels.limit(0)).collect()
    assert {(r["score"], r["kept"]) for r in unknown} == {(0.5, True)}


def test_labels_are_learned_on_real_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    unseen = labels.where("doc_id % 4 = 0").select("doc_id", F.col("quality").alias("truth"))
    rows = quality.score(docs, labels.where("doc_id % 4 > 0")).join(unseen, "doc_id").collect()
    good, bad = [r["kept"] for r in rows if r["truth"] == 1], [r["kept"] for r in rows if r["truth"] == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.3
