"""Exact join of near-equal texts by the Jaccard similarity of their word shingles, filtered under several global orders.

A global order puts all shingles in one line. If two sets have similarity t or more, each shares a shingle among the
other's first n - ceil(t n) + 1 (its prefix), whatever the order. So a pair must share prefix shingles under *every*
order. The first order finds candidates through lists of documents by prefix shingle, with the length and positional
filters; the prefixes under the other orders are intersected before any pair is verified on its whole texts.

Orders go by a coarse count of the shingles, rarest first, then by a hash of their own. The counts come from a sketch of
fixed size over all documents; an order is right whatever they say, good counts only make lists short.

Only what connects documents matters, so work on groups of copies is kept linear:

- documents with equal sets are one node;
- *seeds*: nodes that share a smallest shingle under some hash are compared with the first of them. That links most
  groups already, in stars;
- then only lists with nodes of different components are left. Long ones are compared with their node of least position
  as long as that links anything; at last all pairs across components that pass the filters are verified.

Copies cost no pairs, and no link between different components goes unverified, so components are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.llm.bitmaps import bits_for, marked, thinned, without
from geosync.llm.components import components
from geosync.llm.staging import discard, documents, few_rows, stage, tidy
from geosync.llm.textbytes import BASE, LOWER, SPACE, Hashes, Slice, mix, shingle_hashes, text_slices
from geosync.session import shuffles_go

#: Counters of the sketch, and the parts it travels in.
SKETCH_BITS, SKETCH_PARTS = 20, 64


@dataclass(frozen=True)
class Rules:
    """Words of a shingle, similarity in percent, orders, seeds, and when a list is long."""

    words: int = 3
    percent: int = 90
    orders: int = 3
    seeds: int = 4
    long_list: int = 1_000
    #: Members of a star that are verified in one place.
    star: int = 256


def shingle_sets(part: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their texts, by text and shingle. A text of fewer words is one shingle, one without none."""
    data = LOWER[part.data]
    starts, ends, text = part.runs(~SPACE[data])
    words = Hashes(data).of(starts, ends)
    shingles, owner = shingle_hashes(words, text, size)
    counts = np.bincount(text, minlength=len(part))
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            firsts = np.searchsorted(text, short)
            whole = np.zeros(len(short), np.uint64)
            for k in range(n):
                whole = whole * BASE + words[firsts + k]
            shingles = np.concatenate([shingles, mix(whole + np.uint64(n))])
            owner = np.concatenate([owner, short])
    if (counts < size).any():
        order = np.argsort(owner, kind="stable")
        shingles, owner = shingles[order], owner[order]
    bounds = bounds_of(owner, len(part)).tolist()
    for lo, hi in zip(bounds, bounds[1:]):
        shingles[lo:hi].sort()
    new = np.ones(len(owner), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], owner[new]


def bounds_of(owner: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)


def group_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n + (-percent * n // 100) + 1


def profiles(docs: DataFrame, rules: Rules) -> tuple[DataFrame, np.ndarray]:
    """Per row its set's size and two digests; and the sketch: the coarse count class of each counter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "n", "f1", "f2", "part", "task", "counts"]
        for batch in batches:
            for piece in text_slices(batch.column(1)):
                shingles, owner = shingle_sets(piece, rules.words)
                counters += np.bincount((shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counters))
                bounds = bounds_of(owner, len(piece))
                digests = [group_sums(mix(shingles ^ np.uint64(salt)), bounds).view(np.int64) for salt in (0x5BD1E995, 0x1B873593)]
                empty = pa.nulls(len(piece), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.lo, len(piece)), pa.array(np.diff(bounds)), *map(pa.array, digests), empty, empty, pa.nulls(len(piece), pa.binary())],
                    names=names,
                )
        parts = counters.reshape(SKETCH_PARTS, -1)
        task = TaskContext.get().partitionId()
        held = np.flatnonzero(parts.any(axis=1))
        none = pa.nulls(len(held), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(held.astype(np.int32)), pa.array([task] * len(held), pa.int32()), pa.array([parts[k].astype("<i8").tobytes() for k in held], pa.binary())],
            names=names,
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), "<i8") for x in table.column("counts"))
        first = table.slice(0, 1)
        return pa.table([first.column("part"), first.column("task"), pa.array([total.tobytes()], pa.binary())], names=["part", "task", "counts"])

    shape = "doc_id long, n long, f1 long, f2 long, part int, task int, counts binary"
    rows = stage(docs.mapInArrow(tidy(run), shape), "profiles")
    sketch = rows.where("part IS NOT NULL").select("part", (F.col("task") / 64).cast("int").alias("task"), "counts")
    sketch = sketch.groupBy("part", "task").applyInArrow(add, "part int, task int, counts binary")
    sketch = sketch.groupBy("part").applyInArrow(add, "part int, task int, counts binary")
    classes = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint8)
    with shuffles_go(docs.sparkSession):
        found = sketch.select("part", "counts").collect()
    for row in found:
        classes[row["part"]] = np.log2(np.maximum(np.frombuffer(row["counts"], "<i8"), 1)).astype(np.uint8)
    return rows.where("part IS NULL").select("doc_id", "n", "f1", "f2"), classes.ravel()


def prefixes(docs: DataFrame, classes: np.ndarray, rules: Rules) -> DataFrame:
    """Per row with a set: its size, prefix under the first order, prefixes under the others as 16-bit sets, and seeds."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch.column(1)):
                shingles, owner = shingle_sets(piece, rules.words)
                bounds = bounds_of(owner, len(piece))
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                if not len(some):
                    continue
                count = shared.value[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
                bits = len(piece).bit_length()
                high = (owner.astype(np.uint64) << np.uint64(64 - bits)) | (count << np.uint64(58 - bits))
                within = np.arange(len(owner)) - bounds[owner]
                kept = within < prefix_length(n, rules.percent)[owner]
                ends = np.concatenate([[0], np.cumsum(prefix_length(n[some], rules.percent))]).astype(np.int32)
                columns = []
                for k in range(rules.orders):
                    own = mix(shingles + np.array([k], np.uint64) * BASE)
                    order = np.argsort(high | own >> np.uint64(6 + bits))
                    chosen = shingles[order][kept]
                    if k:
                        chosen = (chosen >> np.uint64(48)).astype(np.uint16).view(np.int16)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(chosen.view(np.int64) if not k else chosen)))
                others = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1, dtype=np.int32) * (rules.orders - 1)),
                    pa.concat_arrays(columns[1:]).take(pa.array(np.arange(len(some) * (rules.orders - 1)).reshape(rules.orders - 1, -1).T.ravel())),
                ) if rules.orders > 1 else pa.array([[]] * len(some), pa.list_(pa.list_(pa.int16())))
                seeds = []
                for k in range(rules.seeds):
                    own = mix(shingles ^ mix(np.array([k + 1], np.uint64) * BASE))
                    seeds.append(np.minimum.reduceat(own, bounds[some]).view(np.int64))
                flat = np.stack(seeds, axis=1).ravel() if seeds else np.zeros(0, np.int64)
                seeds = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * rules.seeds), pa.array(flat))
                doc_id = batch.column(0).take(pa.array(some + piece.lo))
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(n[some]), columns[0], others, seeds], names=["id", "n", "prefix", "others", "seeds"])

    return docs.mapInArrow(tidy(run), "id long, n long, prefix array<long>, others array<array<short>>, seeds array<long>")


def similar_size(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def asked_of(n_a: Column, n_b: Column, percent: int) -> Column:
    """What two sets of these sizes must share."""
    return F.ceil(percent * (n_a + n_b) / (100 + percent) - 1e-6)


def sharing(pairs: DataFrame, nodes: DataFrame, rules: Rules, counted: bool = False) -> DataFrame:
    """The pairs (a, b) whose prefixes share enough under the first order, and meet under every other.

    What two sets share lies in both prefixes or beyond the one that ends first. So the prefixes must share what the
    similarity asks for, less the longer of the two rests. Where that was ``counted`` before, the prefixes under the
    first order, which are most of a node's bytes, are not joined.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    known = thinned(nodes.select("id", "n", "prefix", "others"), "id", ends)
    left = known.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("prefix").alias("p_a"), F.col("others").alias("x"))
    right = known.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("prefix").alias("p_b"), F.col("others").alias("y"))
    rest = F.greatest(F.col("n_a") - F.size("p_a"), F.col("n_b") - F.size("p_b"))
    asked = asked_of(F.col("n_a"), F.col("n_b"), rules.percent)
    meet = F.lit(True) if counted else F.size(F.array_intersect("p_a", "p_b")) >= asked - rest
    for k in range(rules.orders - 1):
        meet &= F.arrays_overlap(F.col("x")[k], F.col("y")[k])
    return pairs.join(left, "a").join(right, "b").where(meet).select("a", "b").distinct()


def crossing(members: DataFrame, rules: Rules) -> DataFrame:
    """The pairs (a, b) of nodes of different components whose prefixes share enough under the first order.

    ``members`` has all shingles that the prefixes of two components share, so what a pair shares is counted over its
    rows here, and no prefix is joined to a pair. A node with several sets may count more, and never less.
    """
    x, y = members.alias("x"), members.alias("y")
    n_a, n_b = F.col("x.n"), F.col("y.n")
    # what two sets share is what precedes the shared token in both, the token, and what follows it in both, at most
    after = 1 + F.least(n_a - F.col("x.at") - 1, n_b - F.col("y.at") - 1)
    most = F.least(F.col("x.at"), F.col("y.at")) + after
    apart = (F.col("x.token") == F.col("y.token")) & (F.col("x.label") < F.col("y.label"))
    may = apart & similar_size(n_a, n_b, rules.percent) & (most >= asked_of(n_a, n_b, rules.percent))
    # nothing precedes the first
    first = (100 + rules.percent) * after >= rules.percent * (n_a + n_b)
    met = x.join(y, may).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), n_a.alias("n_a"), n_b.alias("n_b"), first.alias("first"))
    counted = met.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"), F.max("first").alias("first"))
    # the size less the prefix's length
    rest = F.expr(f"({rules.percent} * greatest(n_a, n_b) + 99) DIV 100 - 1")
    return counted.where(F.col("first") & (F.col("shared") >= asked_of(F.col("n_a"), F.col("n_b"), rules.percent) - rest)).select("a", "b").distinct()


def checked(pairs: DataFrame, nodes: DataFrame, rules: Rules, counted: bool = False) -> DataFrame:
    """Candidate pairs, written, and those of them that also meet under the other orders, written."""
    candidates = stage(pairs, "candidates")
    found = stage(sharing(candidates, nodes, rules, counted), "pairs")
    discard(candidates)
    return found


def linked(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, rules: Rules, counted: bool = False) -> DataFrame:
    """Those of the candidate pairs that are near copies, written."""
    near = checked(pairs, nodes, rules, counted)
    found = stage(verified(docs, near, rules).distinct(), "linked")
    discard(near)
    return found


def labelled(links: DataFrame) -> DataFrame:
    """The ``components`` of the links, written."""
    found = components(links)
    labels = stage(found, "labels")
    discard(found)
    return labels


def verified(docs: DataFrame, pairs: DataFrame, rules: Rules) -> DataFrame:
    """The pairs (a, b) whose whole texts' sets reach the similarity.

    Texts of the documents concerned go to the stars around each ``a``, in parts of bounded size; a part is read as a
    stream with the centre first.
    """
    if pairs.isEmpty():
        return pairs.select("a", "b")
    wanted = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    texts = thinned(docs.select(F.col("doc_id").alias("id"), "text"), "id", wanted)
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / rules.star).cast("int").alias("parts"))
    members = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("id"), F.lit(1).alias("later"))
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("id"), F.lit(0).alias("later"))
    asked = members.unionAll(centres).join(texts, "id")
    dealt = asked.repartition("a", "part").sortWithinPartitions("a", "part", "later", "id").select("a", "part", "id", "later", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, centre = None, []
        for batch in batches:
            a, parts, ids, later = (batch.column(k).to_pylist() for k in range(4))
            found: list[tuple[int, int]] = []
            for piece in text_slices(batch.column(4)):
                shingles, owner = shingle_sets(piece, rules.words)
                bounds = bounds_of(owner, len(piece))
                for k in range(len(piece)):
                    row = piece.lo + k
                    own = shingles[bounds[k] : bounds[k + 1]]
                    if (a[row], parts[row]) != star:
                        star, centre = (a[row], parts[row]), []
                    if not later[row]:
                        centre.append(own.copy())
                        continue
                    for other in centre:
                        if 100 * min(len(own), len(other)) < rules.percent * max(len(own), len(other)):
                            continue
                        shared = len(np.intersect1d(own, other, assume_unique=True))
                        if 100 * shared >= rules.percent * (len(own) + len(other) - shared):
                            found.append((a[row], ids[row]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(tidy(run), "a long, b long")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (id and more) with the label of their component, their own id where they have no link. Few are shuffled."""
    rows = marked(rows, "id", labels.select("id"), "left")
    linked = rows.where("_met").drop("_met").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    return rows.where("NOT _met").drop("_met").withColumn("label", F.col("id")).unionByName(linked)


def same_document(rows: DataFrame, sets: DataFrame, several: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    """Links (a, b) between the heads of the sets that rows of one id fall in; ``several`` has the ids with several sets."""
    met = rows.join(several.select("doc_id"), "doc_id").join(sets.where("id IS NOT NULL"), ["n", "f1", "f2"]).select("doc_id", "id").distinct()
    met = stage(met, "several")
    scratch.append(met)
    return met.join(met.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").where("id <> a").select("a", F.col("id").alias("b")).distinct()


def near_groups(docs: DataFrame, rules: Rules = Rules(), scratch: list[DataFrame] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, n_links and component_id, the smallest id reachable.

    ``n_links`` counts the verified links of the row's node that built the component; copies are no links. A null or
    empty text has no shingles and is its own component. Rows that share an id are one document with the links of all
    its texts. A row without an id joins the component of its copies, else its component is null. Equal texts, ties and
    repeated rows change nothing; other columns are not read. ``scratch`` gets the staged tables that the result reads,
    which a caller may discard once it is written; all others are discarded here.
    """
    scratch = [] if scratch is None else scratch
    few_rows(docs.sparkSession)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows, classes = profiles(docs, rules)
    sets = rows.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("id"))
    heads = stage(sets.where("id IS NOT NULL").select("id").distinct(), "heads")
    own = F.struct("n", "f1", "f2")
    named = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.min(own) < F.max(own)).alias("several"))
    copies = named.join(heads, named["doc_id"] == heads["id"], "left_anti").select("doc_id")
    nodes = stage(prefixes(without(docs.where("doc_id IS NOT NULL"), "doc_id", copies), classes, rules), "nodes")
    near = similar_size(F.col("n"), F.col("pivot.n"), rules.percent)

    seeds = nodes.select("id", "n", F.posexplode("seeds").alias("k", "seed"))
    pivots = seeds.groupBy("k", "seed").agg(F.min(F.struct("id", "n")).alias("pivot"), F.count("*").alias("m")).where("m > 1")
    pairs = seeds.join(pivots, ["k", "seed"]).where(near).where("id <> pivot.id").select(F.col("pivot.id").alias("a"), F.col("id").alias("b")).distinct()
    links = linked(docs, pairs, nodes, rules)

    labels = labelled(links)
    lists = with_labels(nodes.select("id", "n", "prefix"), labels).select("id", "n", "label", F.posexplode("prefix").alias("at", "token"))
    tokens = lists.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
    tokens = stage(tokens, "tokens")
    # an inner join: a semi join would be moved below the bitmap, and all lists shuffled
    members = stage(thinned(lists, "token", tokens, bits_for(tokens.count())).join(tokens, "token"), "members")
    for table in (tokens, labels):
        discard(table)
    while True:
        # stars in the long lists, around the node with the fewest rare shingles
        pivot = F.min(F.struct("at", "id", "n", "label")).alias("pivot")
        long = members.groupBy("token").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high"), pivot)
        stars = members.join(long.where((F.col("m") > rules.long_list) & (F.col("low") < F.col("high"))), "token").where("label <> pivot.label").where(near)
        pairs = stage(stars.select(F.col("pivot.id").alias("a"), F.col("id").alias("b")).distinct(), "stars")
        more = pairs if pairs.isEmpty() else linked(docs, pairs, nodes, rules)
        if more.isEmpty():
            for table in (pairs, more):
                discard(table)
            break
        every = stage(links.unionAll(more), "linked")
        for table in (pairs, links, more):
            discard(table)
        links, labels = every, labelled(every)
        again = stage(with_labels(members.drop("label"), labels), "members")
        for table in (members, labels):
            discard(table)
        members = again

    last = linked(docs, crossing(members, rules), nodes, rules, counted=True)
    every = stage(links.unionAll(last), "linked")
    for table in (members, nodes, links, last):
        discard(table)
    links = every
    found = components(links.unionAll(same_document(rows, sets, named.where("several"), scratch)))
    scratch += [rows, heads, links, found]
    labels = heads.join(found, "id", "left").select("id", F.coalesce("label", "id").alias("label"))
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    known = sets.join(labels.join(ends, "id", "left"), "id", "left")
    out = rows.join(known.select(*(F.col(c).alias(f"_{c}") for c in ("n", "f1", "f2", "label", "n_links"))), (rows["n"] == F.col("_n")) & (rows["f1"] == F.col("_f1")) & (rows["f2"] == F.col("_f2")), "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("_n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("_label", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id")
    )


def one_of_each(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any more) less all but one of each group: the one with the smallest id stays.

    Of rows that share an id one stays. Rows without an id stay, as nothing names them.
    """
    scratch: list[DataFrame] = []
    groups = stage(near_groups(docs, rules, scratch).where("doc_id IS NOT NULL").select("doc_id", "component_id"), "groups")
    for table in scratch:
        discard(table)
    heads = groups.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("times"))
    gone = stage(heads.where("doc_id <> component_id OR times > 1").select("doc_id", "component_id"), "gone")
    discard(groups)
    again = gone.where("doc_id = component_id").select("doc_id")
    rest = without(docs, "doc_id", gone.select("doc_id"))
    if again.isEmpty():
        return rest
    kept = thinned(docs, "doc_id", again).join(again, "doc_id").dropDuplicates(["doc_id"])
    return rest.unionByName(kept.select(*docs.columns))


def op10_multi_order_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(documents(spark, folder))
