"""Centroid clustering of integer vectors by Lloyd's rounds, with a vantage-point tree over the centroids.

The tree is built anew on the driver for each round and broadcast; its size is that of the centroids, a parameter. An
inner node holds one centroid, its vantage point, and splits the others at the median of their distance from it; a child
knows the nearest and the farthest of these distances. A leaf holds a few centroids. Each vector searches best-first: of
all nodes it may still visit the one with the least possible distance comes next, and the search ends when that exceeds
the best distance found. A node at just the best distance is visited, as it may hold an equally near centroid of a
smaller number. Distances to centroids are exact integers; the bounds are floating point, made smaller by more than
their rounding, so that no node is left out for it. The vectors of a batch search in step, each with its own queue.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.llm.staging import stage, tidy
from geosync.llm.vectorcodes import TOTALS, finite, means, scaled, totals

#: Entries of the queues of the vectors that search in step.
QUEUES = 1 << 18
#: More than the rounding of a bound, as a share of the distances it is made of.
SLACK = 2.0**-40


@dataclass(frozen=True)
class Rules:
    """Centroids, rounds, components of a vector, the integers' scale, what ids are hashed with, and centroids of a leaf."""

    centroids: int = 8
    rounds: int = 10
    width: int = 64
    scale: int = 1024
    seed: str = "3"
    leaf: int = 2

    def largest(self) -> int:
        """Integers below this have squared distances below 2 ** 60."""
        return int(((1 << 58) / self.width) ** 0.5)


class VantageTree:
    def __init__(self, centroids: np.ndarray, leaf: int):
        self.centroids = centroids
        self.members: list[np.ndarray] = []
        #: Per inner node two children as (node, least and greatest distance of its centroids from the vantage point).
        self.children: list[list[tuple[int, float, float]]] = []
        todo = [(self._node(), np.arange(len(centroids)))]
        while todo:
            node, numbers = todo.pop()
            if len(numbers) <= max(1, leaf):
                self.members[node] = numbers
                continue
            vantage, others = numbers[0], numbers[1:]
            away = centroids[others] - centroids[vantage]
            distance = np.sqrt((away * away).sum(1).astype(np.float64))
            order = np.argsort(distance, kind="stable")
            self.members[node] = numbers[:1]
            for half in np.array_split(order, 2):
                if len(half):
                    child = self._node()
                    self.children[node].append((child, distance[half[0]], distance[half[-1]]))
                    todo.append((child, np.sort(others[half])))

    def _node(self) -> int:
        self.members.append(np.zeros(0, np.int64))
        self.children.append([])
        return len(self.members) - 1

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest centroid; of equally near ones the smallest number."""
        step = max(1, QUEUES // len(self.members))
        found = [self._search(x[lo : lo + step]) for lo in range(0, len(x), step)]
        return tuple(np.concatenate(f) if found else np.zeros(0, np.int64) for f in (zip(*found) if found else ((), ())))

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        queue = np.full((len(x), len(self.members)), np.inf)
        queue[:, 0] = 0
        best = np.full(len(x), 1 << 60, np.int64)
        number = np.full(len(x), len(self.centroids), np.int64)
        rows = np.arange(len(x))
        while len(rows):
            node = queue[rows].argmin(1)
            bound = queue[rows, node]
            inside = bound <= np.sqrt(best[rows].astype(np.float64))
            rows, node, bound = rows[inside], node[inside], bound[inside]
            queue[rows, node] = np.inf
            for v in np.unique(node):
                here = node == v
                at = rows[here]
                distance = np.zeros(0)
                for name in self.members[v]:
                    away = x[at] - self.centroids[name]
                    distance = (away * away).sum(1)
                    better = (distance < best[at]) | ((distance == best[at]) & (name < number[at]))
                    best[at[better]], number[at[better]] = distance[better], name
                for child, least, greatest in self.children[v]:  # the node's only member is its vantage point
                    root = np.sqrt(distance.astype(np.float64))
                    own = np.maximum(least - root, root - greatest) - SLACK * (root + greatest)
                    queue[at, child] = np.maximum(bound[here], own)
        return number, best


def first_centroids(kept: DataFrame, rules: Rules) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in their order; of equal ids the least vector first."""
    hashed = kept.where(F.col("_id").isNotNull()).select(F.sha2(F.concat(F.lit(f"{rules.seed}:"), F.col("_id").cast("string")), 256).alias("_hash"), "_vector")
    found = hashed.orderBy("_hash", "_vector").limit(rules.centroids).collect()
    return np.floor(np.array([r["_vector"] for r in found], np.float64).reshape(-1, rules.width) * rules.scale).astype(np.int64)


def moved(kept: DataFrame, centroids: np.ndarray, rules: Rules) -> np.ndarray:
    """One round: each centroid with vectors becomes the floor of their mean."""
    shared = kept.sparkSession.sparkContext.broadcast(VantageTree(centroids, rules.leaf))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            x = scaled(batch.column(0), rules.width, rules.scale)
            number = shared.value.nearest(x)[0]
            counts += np.bincount(number, minlength=len(counts))
            np.add.at(sums, number, x)
        yield totals(counts, sums)

    out = means(kept.select("_vector").mapInArrow(tidy(run), TOTALS), centroids)
    shared.unpersist()
    return out


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", rules: Rules = Rules()) -> DataFrame:
    """Per vector: vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256.

    Vectors of another width than ``rules.width``, and those that are null or hold null or non-finite components, are
    dropped. Those with components so large that squares would leave 64 bits come back with nulls, but for inertia, and
    move nothing. A vector that comes again counts each time. A null id starts no centroid, but its vector is
    assigned. With fewer vectors there are fewer centroids; without any, the result is empty. Rounds end early
    where no centroid moves, as all others would give the same. Sums beyond 64 bits are null. Other columns are not read.
    """
    source = vectors.select(vectors[id_column].cast("long").alias("_id"), vectors[vector_column].cast("array<double>").alias("_vector"))
    usable = source.where(finite(F.col("_vector")) & (F.size("_vector") == rules.width))
    fits = F.forall("_vector", lambda x: F.abs(x) * rules.scale < rules.largest())
    kept = usable.where(fits)
    centroids = first_centroids(kept, rules)
    for _ in range(rules.rounds if len(centroids) else 0):
        before, centroids = centroids, moved(kept, centroids, rules)
        if (before == centroids).all():
            break
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(VantageTree(centroids, rules.leaf))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.asarray(batch.column(1).is_valid()) & (len(shared.value.centroids) > 0)
            number, distance = np.zeros(len(known), np.int32), np.zeros(len(known), np.int64)
            number[known], distance[known] = shared.value.nearest(scaled(batch.column(1).filter(pa.array(known)), rules.width, rules.scale))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, mask=~known), pa.array(distance, mask=~known)], names=["vec_id", "cluster", "distance"])

    found = usable.select("_id", F.when(fits, F.col("_vector")).alias("_vector")).mapInArrow(tidy(run), "vec_id long, cluster int, distance long")
    found = stage(found, "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(total.alias("total")).collect() if r["total"] is not None}
    bounded = lambda n: int(n) if n < 1 << 63 else None
    rows = [(k, bounded(sums[k]), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist()) if k in sums]
    described = spark.createDataFrame(rows, "cluster int, cluster_inertia long, centroid_sha256 string")
    inertia = F.lit(bounded(sum(sums.values()))).cast("long").alias("inertia")
    return found.join(F.broadcast(described), "cluster", "left").select("vec_id", "cluster", "distance", "cluster_inertia", inertia, "centroid_sha256")


def op12_vantage_point_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op12_sql(rules: Rules = Rules()) -> str:
    """The same by comparing each vector with every centroid."""
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = {rules.width} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""pieces AS MATERIALIZED (
    SELECT vec_id, i, CAST(floor({rules.scale} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT vec_id, embedding, unnest(range({rules.width})) AS i FROM kept))""",
        f"""middle0 AS MATERIALIZED (
    SELECT k, i, x FROM pieces JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY sha256('{rules.seed}:' || vec_id)) - 1 AS k FROM kept QUALIFY k < {rules.centroids}) USING (vec_id))""",
    ]
    for n in range(rules.rounds + 1):
        steps.append(
            f"""near{n} AS MATERIALIZED (
    SELECT vec_id, min(d * {rules.centroids} + k) AS found FROM (
        SELECT vec_id, k, sum((p.x - m.x) * (p.x - m.x)) AS d FROM pieces p JOIN middle{n} m USING (i) GROUP BY vec_id, k) GROUP BY vec_id)"""
        )
        if n < rules.rounds:
            steps.append(
                f"""middle{n + 1} AS MATERIALIZED (
    SELECT m.k, m.i, CAST(coalesce((s - ((s % n) + n) % n) // n, m.x) AS BIGINT) AS x FROM middle{n} m LEFT JOIN (
        SELECT found % {rules.centroids} AS k, i, sum(x) AS s, count(*) AS n FROM near{n} JOIN pieces USING (vec_id) GROUP BY ALL) t ON m.k = t.k AND m.i = t.i)"""
            )
    last = rules.rounds
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM (SELECT vec_id, found % {rules.centroids} AS k, found // {rules.centroids} AS d FROM near{last})
JOIN (SELECT k, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM middle{last} GROUP BY k) USING (k)"""
    )
