"""The Jaccard join against all pairs, and connected components against a plain search."""

import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from geosync.llm import components, jaccard
from geosync.llm.staging import stage
from geosync.session import shared_folder


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def plain_components(nodes, links):
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        above[b] = a
    return {n: top(n) for n in nodes}


def plain_groups(rows, percent=90):
    sets = [(d, plain_set(t)) for d, t in rows]
    links = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
    tops = plain_components([d for d, _ in rows], links)
    return sorted((d, len(x), tops[d]) for d, x in sets)


def edited(draw, words, edits):
    out = list(words)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"e{draw.randrange(10**6)}"
    return out


def corpus(seed, clusters, most):
    draw = random.Random(seed)
    pool = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(clusters):
        base = [draw.choice(pool) for _ in range(draw.choice([1, 2, 3, 5, 20, 60, 150]))]
        for _ in range(draw.randint(1, most)):
            texts.append(" ".join(edited(draw, base, draw.choice([0, 0, 1, 1, 2, 3]))))
    line = " ".join(draw.choice(pool) for _ in range(25))
    texts += [f"{line} {draw.choice(pool)}x{k}" for k in range(most)] + [f"{k} {line} and {k}" for k in range(most)]
    texts += ["", None, "  ", "One", "one", "ONE two", "one Two"]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,rules", [(1, jaccard.Rules()), (1, jaccard.Rules(long_list=64)), (2, jaccard.Rules(long_list=3, star=4)), (3, jaccard.Rules(seeds=0, orders=1)), (4, jaccard.Rules(seeds=1, orders=2, long_list=2))])
def test_components_are_exact(spark, seed, rules):
    rows = corpus(seed, 25, 12)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_groups(df, rules).collect())
    assert got == plain_groups(rows)


def test_odd_input(spark, messy, nothing):
    keyed = messy.where("doc_id IS NOT NULL")
    rows = [(r["doc_id"], r["text"]) for r in keyed.collect()]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_groups(messy).collect() if r["doc_id"] is not None)
    assert got == plain_groups(rows)
    assert jaccard.near_groups(messy).count() == messy.count()
    assert jaccard.near_groups(nothing).count() == 0
    assert jaccard.near_groups(nothing).columns == ["doc_id", "n_shingles", "n_links", "component_id"]


def test_connected_components(spark):
    draw = random.Random(7)
    links = [(k, k + 1) for k in range(0, 120) if k % 40] + [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(120)]
    links += [(500, 500 + k) for k in range(60)] + [(9, 9), (None, 4), (3, None)]
    got = {r["id"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    plain = [x for x in links if None not in x and x[0] != x[1]]
    assert got == plain_components({n for x in plain for n in x}, plain)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_an_id_links_the_copies_of_its_texts(spark):
    a, b, c = ("one two three four five six", "red green blue black white grey", "up down left right near far")
    rows = [(5, a), (5, b), (2, a), (4, b), (7, b), (7, c), (7, c), (3, c), (9, "some other words that stand alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard.near_groups(docs).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(d, 9 if d == 9 else 2) for d, _ in rows} and len(found) == len(rows)
    assert {r["n_links"] for r in found} == {0}
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(docs).collect()) == [2, 9]


def test_only_what_the_result_reads_stays_on_disk(spark):
    shared = Path(shared_folder(spark))
    before = set(shared.iterdir())
    docs = spark.createDataFrame(corpus(3, 12, 4), "doc_id long, text string")
    kept = jaccard.one_of_each(docs)
    assert {p.name.partition("-")[0] for p in set(shared.iterdir()) - before} <= {"gone"}
    assert 0 < kept.count() < docs.count()


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while files.hasNext():
            names.add(files.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    made = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    assert made.count() == 7
    for _ in range(50):  # they go in the background
        left = {n for n in shuffled() - before if n.endswith(".data")}
        if not left:
            break
        time.sleep(0.1)
    assert len(left) <= 1  # that of the count itself


def test_what_pairs_share_is_counted_and_no_prefix_joined(spark):
    draw, rules = random.Random(4), jaccard.Rules(words=1, percent=80)
    base = [sorted(draw.sample(range(60), 30)) for _ in range(6)]
    sets = {k: sorted({*draw.sample(base[k % 6], 28), *draw.sample(range(60), 2)}) for k in range(60)}
    first = {k: s[: len(s) + (-80 * len(s) // 100) + 1] for k, s in sets.items()}
    members = spark.createDataFrame([(k, len(sets[k]), k % 7, at, t) for k, p in first.items() for at, t in enumerate(p)], "id long, n long, label long, at int, token long")
    apart = [(a, b) for a in sets for b in sets if a % 7 < b % 7]
    near = {(a, b) for a, b in apart if 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})}
    found = {(r["a"], r["b"]) for r in jaccard.crossing(members, rules).collect()}
    assert near and near <= found
    for a, b in found:
        asked = -(-80 * (len(sets[a]) + len(sets[b])) // 180)
        assert len({*first[a]} & {*first[b]}) >= asked - max(len(sets[k]) - len(first[k]) for k in (a, b))
    nodes = spark.createDataFrame([(k, len(sets[k]), first[k], [[1], [1]]) for k in sets], "id long, n long, prefix array<long>, others array<array<short>>")
    pairs = spark.createDataFrame(sorted(found), "a long, b long")
    plan = jaccard.sharing(pairs, nodes, rules, counted=True)
    assert {(r["a"], r["b"]) for r in plan.collect()} == found
    assert "array_intersect" not in plan._jdf.queryExecution().optimizedPlan().toString()
