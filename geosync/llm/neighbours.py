"""Approximate nearest neighbours by cosine with an inverted multi-index.

A unit vector is cut into two halves, each assigned to the nearest of k centroids, so k * k cells share 2 k centroids. A
query sorts the centroids of each half by distance and walks the pairs by their summed distance, with a heap, until the
cells it has met hold enough entries. The entries of those cells are ranked by their exact cosine.

Equal vectors are one entry that carries the smallest of their ids, so copies cost nothing; equal queries are searched
once. Cells are dealt out over buckets, and a full cell over several, so no task gets more than a bounded part of one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geosync.llm.staging import stage
from geosync.llm.textbytes import mix


#: Queries ranked at once against a bucket.
QUERIES = 256


@dataclass(frozen=True)
class Index:
    """Production parameters. At most ``centroids`` for each half, learned from about ``sample`` entries chosen by hash."""

    nearest: int = 5
    centroids: int = 256
    sample: int = 20_000
    rounds: int = 12
    #: Entries a cell holds on average; a half gets the root of entries / per_cell centroids, if that is fewer.
    per_cell: float = 8.0
    #: A query ranks the share of all entries that is learned for this recall, and ``ranked`` entries at least.
    ranked: int = 0
    recall: float = 0.96
    probes: int = 100
    #: Entries of a cell that go to one bucket, and of a bucket on average.
    cell_part: int = 2_000
    bucket: int = 4_000
    #: Queries that meet a bucket in one task, on average.
    asked: int = 20_000


def entries(vectors: DataFrame, keep: int) -> DataFrame:
    """Distinct usable vectors with their ``keep`` smallest ids: ``key``, ``vector``, ``ids``.

    Of many equal vectors a task passes on ``keep`` ids at most (the limit is known to the window's first step).
    """
    usable = F.expr("size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)")
    rows = vectors.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull()).where(usable)
    first = rows.withColumn("k", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("k") <= keep)
    return first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("key", F.col("ids")[0])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)


def centroids_of(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Lloyd's rounds from evenly drawn rows; a centroid that loses all its rows stays."""
    out = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = squared(x, out).argmin(1)
        counts = np.bincount(near, minlength=len(out))
        sums = np.zeros_like(out)
        np.add.at(sums, near, x)
        out[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return out


@dataclass
class Quantiser:
    """Centroids of both halves; sizes and parts of the cells. Its size is bounded by ``Index.centroids``."""

    halves: tuple[np.ndarray, np.ndarray]
    width: int
    sizes: np.ndarray | None = None

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (squared(part, c).argmin(1) for part, c in zip(np.split(x, [self.width // 2], axis=1), self.halves))
        return a * len(self.halves[1]) + b

    def walk(self, query: np.ndarray, enough: int) -> list[int]:
        """Cells that hold entries, by summed distance of their two centroids, until they hold ``enough`` together."""
        left, right = (squared(part[None], c)[0] for part, c in zip(np.split(query, [self.width // 2]), self.halves))
        by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
        left, right = left[by_left].tolist(), right[by_right].tolist()
        by_left, by_right = by_left.tolist(), by_right.tolist()
        wide = len(right)
        reached = [-1] * len(left)  # per row the last column taken
        heap = [(left[0] + right[0], 0, 0)]
        out, held = [], 0
        sizes = self.sizes
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            reached[i] = j
            cell = by_left[i] * wide + by_right[j]
            if sizes[cell]:
                out.append(cell)
                held += sizes[cell]
            if i + 1 < len(left) and reached[i + 1] == j - 1:
                heapq.heappush(heap, (left[i + 1] + right[j], i + 1, j))
            if j + 1 < wide and (i == 0 or reached[i - 1] > j):
                heapq.heappush(heap, (left[i] + right[j + 1], i, j + 1))
        return out

    def share(self, x: np.ndarray, probes: int, nearest: int, recall: float) -> float:
        """The share of entries that queries must rank to meet their nearest ones among ``x`` with this recall.

        Vectors in clusters need little, vectors without structure much: so it is measured, on the centroids' sample.
        With more entries the share only falls.
        """
        cells = self.cells(x)
        self.sizes = np.bincount(cells, minlength=len(self.halves[0]) * len(self.halves[1]))
        shares = []
        for at in np.linspace(0, len(x) - 1, min(probes, len(x))).astype(int):
            near = x @ x[at]
            near[at] = -2
            best = np.argsort(-near, kind="stable")[: min(nearest, len(x) - 1)]
            walked = np.array(self.walk(x[at], len(x)))
            place = np.zeros(len(self.sizes))
            place[walked] = np.cumsum(self.sizes[walked]) / len(x)
            shares.append(place[cells[best]])
        return float(np.quantile(np.concatenate(shares), recall)) if shares and len(shares[0]) else 1.0

    def bucket(self, cell: np.ndarray, part: np.ndarray, buckets: int) -> np.ndarray:
        return (mix(cell.astype(np.uint64) << np.uint64(32) | part.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def search(vectors: DataFrame, is_query: str, index: Index = Index()) -> DataFrame:
    """The nearest rows of each query row: query_id, rank from 1, vec_id, score (cosine in double precision).

    ``vectors`` has ``vec_id`` and ``vector``; ``is_query`` is an SQL condition on ``vec_id``. A query's own row is not
    among its results; ties go to the smaller id. Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do those of another length than most have. Rows repeated with id and vector count
    once. With no usable row the result is empty. The index holds every usable vector; learning its centroids from a
    sample bounds the driver's share.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).distinct()
    widths = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").first()
    width = widths["w"] if widths else 0
    kept = stage(entries(rows.where(F.size("vector") == width), index.nearest + 1), "entries")
    n = kept.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], empty)
    draw = F.shiftrightunsigned(F.xxhash64("key"), 33) < int(2.0**31 * min(1.0, index.sample / n))
    drawn = kept.where(draw | (F.col("key") == kept.agg(F.min("key")).first()[0])).select("key", "vector").orderBy("key").toArrow()
    x = unit(matrix(drawn.column("vector"), width))
    k = max(1, min(index.centroids, round(math.sqrt(n / index.per_cell))))
    halves = tuple(centroids_of(part, k, index.rounds) for part in np.split(x, [width // 2], axis=1))
    quantiser = Quantiser(halves, width)
    enough = max(index.ranked, index.nearest + 1, math.ceil(n * quantiser.share(x, index.probes, index.nearest, index.recall)))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = quantiser.cells(unit(matrix(batch.column(1), width))) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], names=["key", "vector", "ids", "cell"])

    assigned = stage(kept.select("key", "vector", "ids").mapInArrow(assign, "key long, vector array<double>, ids array<long>, cell long"), "cells")
    sizes = np.zeros(len(halves[0]) * len(halves[1]), np.int64)
    for cell, count in assigned.groupBy("cell").count().collect():
        sizes[cell] = count
    sized = Quantiser(halves, width, sizes)
    buckets = max(1, math.ceil(n / index.bucket))
    most = index.cell_part

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sized
        for batch in batches:
            keys, cells = np.asarray(batch.column(0)), np.asarray(batch.column(3))
            part = mix(keys.astype(np.uint64)) % (1 + own.sizes[cells] // most).astype(np.uint64)
            bucket = own.bucket(cells, part, buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *batch.columns], names=["bucket", "key", "vector", "ids", "cell"])

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sized
        for batch in batches:
            if not len(batch):
                continue
            raw = matrix(batch.column(1), width)
            directions = unit(raw)
            asked_part = mix(np.asarray(batch.column(0)).astype(np.uint64)) % np.uint64(parts_asked)
            for at in range(len(batch)):
                cells = np.array(own.walk(directions[at], enough), np.int64)
                parts = 1 + own.sizes[cells] // most
                spread = np.repeat(cells, parts)
                part = np.arange(len(spread)) - np.repeat(np.cumsum(parts) - parts, parts)
                bucket = own.bucket(spread, part, buckets)
                order = np.argsort(bucket, kind="stable")
                bucket, spread = bucket[order] * parts_asked + int(asked_part[at]), spread[order]
                names, starts = np.unique(bucket, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(bucket)), pa.int32()), pa.array(spread))
                key = batch.column(0).take(pa.array([at] * len(names)))
                vector = batch.column(1).take(pa.array([at] * len(names)))
                yield pa.RecordBatch.from_arrays([pa.array(names), key, vector, lists], names=["bucket", "query", "vector", "cells"])

    def rank(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(asked) and len(held):
            names, cells = np.unique(np.asarray(held.column("cell")), return_inverse=True)
            own = matrix(held.column("vector"), width)
            length = np.sqrt((own * own).sum(1))
            directions = unit(own)
            ids = held.column("ids").to_pylist()
            queries = matrix(asked.column("vector"), width)
            keys = asked.column("query").to_pylist()
            wanted = asked.column("cells").combine_chunks()
            for lo in range(0, len(keys), QUERIES):
                part = wanted.slice(lo, QUERIES)
                visited = np.asarray(part.flatten())
                at = np.searchsorted(names, visited)
                here = names[np.minimum(at, len(names) - 1)] == visited
                mask = np.zeros((len(part), len(names)), bool)
                mask[np.repeat(np.arange(len(part)), np.asarray(part.value_lengths()))[here], at[here]] = True
                near = np.where(mask[:, cells], unit(queries[lo : lo + QUERIES]) @ directions.T, -np.inf)
                for row, q, key in zip(near, queries[lo : lo + QUERIES], keys[lo : lo + QUERIES]):
                    # the product only chooses; the score is the cosine of the vectors as they are
                    least = np.partition(row, -index.nearest - 1)[-index.nearest - 1] if len(row) > index.nearest + 1 else -2
                    some = np.flatnonzero((row > -2) & (row >= least - 1e-12))
                    score = (own[some] * q).sum(1) / (length[some] * np.sqrt((q * q).sum()))
                    found = ((-s, i) for s, k in zip(score.tolist(), some.tolist()) for i in ids[k])
                    out.extend((key, i, -s) for s, i in heapq.nsmallest(index.nearest + 1, found))
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query", "vec_id", "score"])

    asking = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    # a distinct query vector is searched once, under its entry's key
    asking = stage(asking.join(kept.select("key", "vector"), "vector").select("query_id", "key"), "asking")
    # queries beyond a number go in parts, each of which meets a copy of the bucket
    parts_asked = max(1, math.ceil(asking.count() / index.asked))
    held = assigned.mapInArrow(deal, "bucket long, key long, vector array<double>, ids array<long>, cell long")
    copies = F.explode(F.sequence(F.lit(0), F.lit(parts_asked - 1)))
    held = held.withColumn("copy", copies).withColumn("bucket", F.col("bucket") * parts_asked + F.col("copy")).drop("copy")
    asked = kept.join(asking.select("key").distinct(), "key", "left_semi").select("key", "vector")
    asked = asked.repartition(buckets, "key").mapInArrow(visit, "bucket long, query long, vector array<double>, cells array<long>")
    ranked = asked.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(rank, "query long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = ranked.withColumn("k", F.row_number().over(order)).where(F.col("k") <= index.nearest + 1)
    lists = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("away"), "vec_id"))).alias("found"))
    own = asking.join(lists, asking["key"] == lists["query"])
    others = own.select("query_id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, index.nearest).alias("found"))
    return others.select("query_id", F.posexplode("found").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.away")).alias("score")
    )


def op1_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    return search(vectors, "vec_id % 50 = 0")
