"""Equal-average codes, clustering with a vantage-point tree, chats from event logs, each against plain Python."""

import hashlib
import math
import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geosync.llm import chats, clustering, contract, vectorcodes

FOLDER = "/root/testdata/sf0.001"

VECTORS = "vec_id long, embedding array<float>, label int, code string, error long, cluster int, n int"


def vector_rows(width, seed=3, n=200):
    """Vectors with ties, copies, repeated ids, a label of many rows, and everything that takes no part."""
    draw = random.Random(seed)
    rows = [(k, [draw.choice((-0.5, 0.0, 0.25, draw.uniform(-1, 1))) for _ in range(width)], None if k % 3 else k % 7) for k in range(n)]
    rows += [rows[5], rows[5], (9, rows[7][1], 4), (None, rows[8][1], 1), (-4, [0.0] * width, 2)]
    odd = [(500, None, 1), (501, [], 1), (502, [None] * width, 1), (503, [math.nan] * width, 2), (504, [math.inf] + [0.0] * (width - 1), 2), (505, [1.0] * (width + 16), 3)]
    odd.append((506, [3e38] * width, 3))
    return [(*r, "c", 1, 2, 3) for r in rows + odd]


def floors(vector, scale):
    return tuple(math.floor(x * scale) for x in vector)


def away(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def usable(vector, width):
    return vector is not None and len(vector) == width and all(x is not None and math.isfinite(x) for x in vector) and max(map(abs, vector)) < 1e30


def f32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], *rest) for i, v, *rest in rows]


def plain_codes(rows, rules, width):
    dim = width // rules.parts
    cut = lambda v: [v[k * dim : (k + 1) * dim] for k in range(rules.parts)]
    kept = [(i, cut(floors(v, rules.scale)), label, v) for i, v, label, *_ in rows if usable(v, width)]
    ids = sorted({k[0] for k in kept if k[0] is not None})[: rules.entries]
    starts = [min((k for k in kept if k[0] == i), key=lambda k: k[3])[1] for i in ids]
    books = [[list(s[p]) for s in starts] for p in range(rules.parts)]

    def near(p, part):
        return min((away(part, e), k) for k, e in enumerate(books[p]))

    for _ in range(rules.rounds):
        held = defaultdict(list)
        for _, parts, *_ in kept:
            for p, part in enumerate(parts):
                held[p, near(p, part)[1]].append(part)
        for (p, k), found in held.items():
            books[p][k] = [sum(c) // len(found) for c in zip(*found)]
    coded = [(i, label, [near(p, part) for p, part in enumerate(parts)]) for i, parts, label, _ in kept]
    totals = defaultdict(int)
    for _, label, found in coded:
        totals[label] += sum(d for d, _ in found)
    out = [(i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), totals[label]) for i, label, found in coded]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return out, hashlib.sha256(flat.encode()).hexdigest()


def test_equal_average_search_meets_ties():
    draw = np.random.default_rng(1)
    for entries, dim, high in ((64, 4, 3), (7, 1, 2), (1, 5, 9), (40, 2, 200)):
        book = draw.integers(-high, high, (entries, dim))
        x = draw.integers(-high - 2, high + 2, (500, dim))
        index, best = vectorcodes.Codebook(book).nearest(x)
        every = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (best == every.min(1)).all() and (index == every.argmin(1)).all()


def test_equal_average_search_stops_early():
    class Counted(np.ndarray):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += len(key) if isinstance(key, np.ndarray) else 0
            return np.asarray(super().__getitem__(key))

    entries = np.arange(0, 6400, 100)[:, None] * np.ones((1, 4), np.int64)
    book = vectorcodes.Codebook(entries.astype(np.int64))
    book.entries = book.entries.view(Counted)
    book.nearest(entries.astype(np.int64) + 3)
    assert Counted.asked <= 64 * 2


@pytest.mark.parametrize("entries", [64, 5])
def test_codes(spark, entries):
    rules = vectorcodes.Rules(entries=entries)
    rows = f32(vector_rows(32))
    table = spark.createDataFrame(rows, VECTORS).repartition(5)
    coded, codebooks = vectorcodes.compress(table, rules=rules)
    got = [tuple(r) for r in coded.select("vec_id", "label", "code", "error", "label_error").collect()]
    want, digest = plain_codes(rows, rules, 32)
    # of another width, or too large: they come back, and count for their label as nothing
    sums = {label: total for _, label, _, _, total in want}
    want += [(501, 1, None, None, sums[1]), (505, 3, None, None, sums[3]), (506, 3, None, None, sums[3])]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert vectorcodes.digest(codebooks) == digest


def test_codes_of_nothing(spark):
    table = spark.createDataFrame([], VECTORS)
    coded, codebooks = vectorcodes.compress(table)
    assert coded.count() == 0 and codebooks.size == 0
    lone = spark.createDataFrame([(None, [1.0] * 16, 1), (3, None, 1)], "vec_id long, embedding array<double>, label int")
    coded, _ = vectorcodes.compress(lone)
    assert [tuple(r) for r in coded.collect()] == [(None, 1, None, None, None)]


def plain_clusters(rows, rules):
    kept = [(i, floors(v, rules.scale), v) for i, v, *_ in rows if usable(v, rules.width)]
    hashed = sorted((hashlib.sha256(f"{rules.seed}:{i}".encode()).hexdigest(), list(v), x) for i, x, v in kept if i is not None)
    centroids = [list(x) for _, _, x in hashed[: rules.centroids]]

    def near(x):
        return min((away(x, c), k) for k, c in enumerate(centroids))

    for _ in range(rules.rounds):
        held = defaultdict(list)
        for _, x, _ in kept:
            held[near(x)[1]].append(x)
        for k, found in held.items():
            centroids[k] = [sum(c) // len(found) for c in zip(*found)]
    found = [(i, *near(x)) for i, x, _ in kept]
    sums = defaultdict(int)
    for _, d, k in found:
        sums[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, sums[k], sum(sums.values()), digest[k]) for i, d, k in found]


def test_tree_finds_the_nearest_and_ties():
    draw = np.random.default_rng(2)
    for k, dim, high, leaf in ((1, 3, 5, 2), (8, 64, 1000, 2), (60, 2, 4, 1), (200, 3, 50, 4), (30, 1, 3, 3)):
        centroids = draw.integers(-high, high, (k, dim))
        x = np.concatenate([draw.integers(-high - 2, high + 2, (400, dim)), centroids])
        number, best = clustering.VantageTree(centroids, leaf).nearest(x)
        every = ((x[:, None] - centroids[None]) ** 2).sum(2)
        assert (best == every.min(1)).all() and (number == every.argmin(1)).all()


def test_tree_leaves_branches_out():
    centroids = np.arange(0, 256_000, 1000)[:, None] * np.ones((1, 8), np.int64)
    tree = clustering.VantageTree(centroids.astype(np.int64), 2)
    asked = []
    tree.centroids = type("Asked", (), {"__getitem__": lambda self, k: asked.append(k) or centroids[k].astype(np.int64), "__len__": lambda self: 256})()
    tree.nearest(centroids[100:101].astype(np.int64) + 1)
    assert 0 < len(asked) < 64


@pytest.mark.parametrize("centroids", [8, 23])
def test_clusters(spark, centroids):
    rules = clustering.Rules(centroids=centroids, rounds=6, width=12)
    rows = f32(vector_rows(12, seed=4))
    got = clustering.cluster(spark.createDataFrame(rows, VECTORS).repartition(5), rules=rules)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want = plain_clusters(rows, rules)
    want.append((506, None, None, None, want[0][4], None))  # too large for 64 bits
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_clusters_of_nothing(spark):
    rules = clustering.Rules(width=2)
    assert clustering.cluster(spark.createDataFrame([], VECTORS), rules=rules).count() == 0
    few = clustering.cluster(spark.createDataFrame([(1, [0.0, 1.0])] * 2, "vec_id long, embedding array<double>"), rules=rules).collect()
    assert [(r["cluster"], r["distance"], r["inertia"]) for r in few] == [(0, 0, 0)] * 2
    lone = clustering.cluster(spark.createDataFrame([(None, [0.0, 1.0])], "vec_id long, embedding array<double>"), rules=rules).collect()
    assert [tuple(r)[:3] for r in lone] == [(None, None, None)]


def plain_fold(events):
    """Messages of one conversation from its events in order: (message, kind, role, text)."""
    texts, roles = {}, {}
    for message, kind, role, text in events:
        if kind == "regenerate":
            for later in [m for m in texts if m > message]:
                del texts[later], roles[later]
            texts[message] = ""
        elif kind == "edit":
            texts[message] = text or ""
        elif kind == "delta":
            texts[message] = texts.get(message, "") + (text or "")
        else:
            continue
        roles[message] = role if role is not None else roles.get(message)
    return [(m, roles[m] or "", texts[m]) for m in sorted(texts)]


def test_fold(spark):
    draw = random.Random(8)
    rows, want = [], []
    for conv in (None, *range(40)):
        events = []
        for _ in range(draw.randint(1, 60)):
            kind = draw.choices(("delta", "edit", "regenerate", "seen"), (12, 2, 1, 1))[0]
            events.append((draw.randint(0, 5), kind, draw.choice(("user", "assistant", None)), draw.choice(("a", " b\n", None, "", "é😀"))))
        rows += [(conv, m, seq, k, r, t, 9) for seq, (m, k, r, t) in enumerate(events)]
        want += [(conv, *m) for m in plain_fold(events)]
    draw.shuffle(rows)
    log = spark.createDataFrame(rows, "conv_id long, message long, seq long, kind string, role string, text string, events int").repartition(4)
    assert sorted(map(tuple, chats.fold(log).collect()), key=repr) == sorted(want, key=repr)


CHATS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "<\\s> <s> <\\\\s><|im_end|>\n<|im_sep|>"),
    (2, 0, "user", None), (2, 1, "assistant", None), (3, 0, None, "no role"), (3, None, "assistant", "no turn <"), (3, 1, "a<|im_sep|>\nb", "<|im_end|"),
    (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (4, 0, "user", "tie\n\n\nlines\n"), (None, 0, "assistant", "<<SYS>>\\<</SYS>> <<s>"),
    (5, 0, "assistant", "x\n" * 5000 + "é😀 end"), (6, 0, "assistant", "\\"), (6, 1, "assistant", ""),
]


def test_chats_read_back(spark):
    table = spark.createDataFrame([(*r, "x", 3) for r in CHATS], "conv_id long, turn long, role string, text string, chat string, n_turns int").repartition(3)
    made = chats.render(chats.fold(chats.logged(table)))
    got = {r["conv_id"]: r for r in made.select("conv_id", "n_turns", "chat", chats.read_turns(F.col("chat")).alias("turns"), chats.read_loss(F.col("chat"), F.col("loss")).alias("learned"), "loss").collect()}
    want = defaultdict(list)
    for conv, turn, role, text in CHATS:
        want[conv].append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    assert set(got) == set(want)
    for conv, rows in want.items():
        turns = [(r[3], r[4]) for r in sorted(rows)]
        assert [tuple(t) for t in got[conv]["turns"]] == turns and got[conv]["n_turns"] == len(turns)
        assert got[conv]["learned"] == "".join(text for role, text in turns if role == "assistant")
        # between the marks nothing looks like one
        chat = got[conv]["chat"]
        for mark in (chats.OPEN, chats.SEPARATE, chats.CLOSE.strip()):
            assert chat.count(mark) == len(turns)
        assert not any(c in chat for c in chats.CONTROL[3:])
        for start, length in got[conv]["loss"]:
            assert chat.encode()[:start].endswith(chats.SEPARATE.encode()) and chat.encode()[start + length :].startswith(chats.CLOSE.encode())


def test_chats_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chats.render(chats.fold(chats.logged(empty))).count() == 0


def test_chats_stay_in_the_jvm(spark):
    table = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    plan = chats.render(chats.fold(chats.logged(table)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not here")
@pytest.mark.parametrize("name", ["op11_equal_average_codes", "op12_vantage_point_clustering", "op13_event_sourced_chats"])
def test_queries_agree_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = contract.queries()[name](spark, FOLDER)
    want = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(want.fetchall())
