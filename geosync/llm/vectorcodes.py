"""Vector code compression: equal parts of integer vectors become indices into trained codebooks.

The nearest entry of a part is found by equal-average search. Entries are sorted by the sum of their components. By
Cauchy's inequality the squared gap of two sums, over the dimension, is no more than the squared distance, so the search
walks outward from the part's own sum, the nearer side first, and stops as soon as the squared gap over the dimension
strictly exceeds the best distance: an entry at just that gap may still tie with a smaller index. All is integer
arithmetic, so results do not depend on how the rows are dealt.

Spark reads the vectors once a round. A task sums its rows for each entry, and only these sums are shuffled; the
driver holds the codebooks, whose size is fixed by ``Rules`` and the width of a vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.llm.staging import stage, tidy

#: Parts searched at once.
BLOCK = 1 << 14
#: Columns of ``totals``.
TOTALS = "entry long, place int, total long"
#: A label with more than this share of the rows gets its total by broadcast, so there are no more such labels than this.
COMMON = 200


@dataclass(frozen=True)
class Rules:
    """Parts of a vector, entries of a codebook (at most 256, as an index is a byte), rounds and the integers' scale."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def finite(vector: Column) -> Column:
    """Not null, and no component is null, NaN or infinite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def scaled(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of integers floor(scale * x) from an array of lists that are not null."""
    return np.floor(np.asarray(column.flatten(), np.float64).reshape(-1, width) * scale).astype(np.int64)


class Codebook:
    """Entries of one part position, ready for equal-average search."""

    def __init__(self, entries: np.ndarray):
        self.order = np.argsort(entries.sum(1), kind="stable")
        self.entries = entries[self.order]
        self.dim = entries.shape[1]
        # no sum comes near these ends, whose gap ends every search
        self.sums = np.concatenate([[-(1 << 30)], self.entries.sum(1), [1 << 30]])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry; of equally near ones the smallest index."""
        own = x.sum(1)
        right = np.searchsorted(self.sums, own)
        left = right - 1
        best = np.full(len(x), (1 << 59) // self.dim, np.int64)
        index = np.full(len(x), len(self.order), np.int64)
        rows = np.arange(len(x))
        while len(rows):
            below, above = own[rows] - self.sums[left[rows]], self.sums[right[rows]] - own[rows]
            gap = np.minimum(below, above)
            inside = gap * gap <= best[rows] * self.dim
            rows, lower = rows[inside], (below <= above)[inside]
            at = np.where(lower, left[rows], right[rows])
            left[rows] -= lower
            right[rows] += ~lower
            away = x[rows] - self.entries[at - 1]
            distance = (away * away).sum(1)
            name = self.order[at - 1]
            better = (distance < best[rows]) | ((distance == best[rows]) & (name < index[rows]))
            best[rows[better]], index[rows[better]] = distance[better], name[better]
        return index, best


def assign(x: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """Code of each row, and the squared distances summed over its parts."""
    codes = np.zeros((len(x), len(books)), np.int64)
    errors = np.zeros(len(x), np.int64)
    dim = x.shape[1] // len(books)
    for lo in range(0, len(x), BLOCK):
        for k, book in enumerate(books):
            codes[lo : lo + BLOCK, k], distance = book.nearest(x[lo : lo + BLOCK, k * dim : (k + 1) * dim])
            errors[lo : lo + BLOCK] += distance
    return codes, errors


def first_codebooks(fitting: DataFrame, rules: Rules, width: int) -> np.ndarray:
    """Parts of the vectors with the smallest ids, as (part, entry, component); an id's least vector counts."""
    ids = [r[0] for r in fitting.where(F.col("_id").isNotNull()).select("_id").distinct().orderBy("_id").limit(rules.entries).collect()]
    found = fitting.where(F.col("_id").isin(ids)).groupBy("_id").agg(F.min("_vector").alias("_vector")).orderBy("_id").collect()
    whole = np.floor(np.array([r["_vector"] for r in found], np.float64).reshape(-1, width) * rules.scale).astype(np.int64)
    return whole.reshape(len(found), rules.parts, width // rules.parts).transpose(1, 0, 2).copy()


def totals(counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """What a task found, as rows of (entry, place, total): the number of its vectors at place -1, then their sums by component."""
    used = np.flatnonzero(counts)
    every = np.concatenate([counts[used, None], sums[used]], axis=1)
    places = np.tile(np.arange(-1, sums.shape[1], dtype=np.int32), len(used))
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(used, every.shape[1])), pa.array(places), pa.array(every.ravel())], names=["entry", "place", "total"])


def means(found: DataFrame, before: np.ndarray) -> np.ndarray:
    """``before`` (entry, component) with the floor of the mean of the vectors found for an entry, if there are any."""
    out = before.copy()
    rows = {(r["entry"], r["place"]): r["total"] for r in found.groupBy("entry", "place").agg(F.sum("total").alias("total")).collect()}
    for (entry, place), total in rows.items():
        if place >= 0:
            out[entry, place] = total // rows[entry, -1]
    return out


def retrained(fitting: DataFrame, codebooks: np.ndarray, rules: Rules) -> np.ndarray:
    """One round: every part goes to its nearest entry, and entries become the floor of their parts' means."""
    parts, entries, dim = codebooks.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, dim), np.int64)
        for batch in batches:
            x = scaled(batch.column(0), parts * dim, rules.scale)
            slots = (assign(x, books)[0] + np.arange(parts) * entries).ravel()
            counts += np.bincount(slots, minlength=len(counts))
            np.add.at(sums, slots, x.reshape(-1, dim))
        yield totals(counts, sums)

    return means(fitting.select("_vector").mapInArrow(tidy(run), TOTALS), codebooks.reshape(parts * entries, dim)).reshape(codebooks.shape)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` (label, error, and others) with ``label_error``, the errors summed over equal labels, nulls together.

    Totals of labels with many rows are broadcast, so that none of these is shuffled; the others are joined.
    """
    totals = stage(rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"), F.count("*").alias("_n")), "label-errors")
    every = totals.agg(F.sum("_n")).first()[0] or 0
    common = F.broadcast(totals.where(F.col("_n") * COMMON > every).select(F.col("label").alias("_label"), "label_error"))
    rare = totals.where(F.col("_n") * COMMON <= every).select(F.col("label").alias("_label"), "label_error")
    same = F.col("label").eqNullSafe(F.col("_label"))
    return rows.join(common, same).unionAll(rows.join(common, same, "left_anti").join(rare, same)).drop("_label")


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", rules: Rules = Rules()
) -> tuple[DataFrame, np.ndarray]:
    """Per vector: vec_id, label, code (two hex digits a part), error, label_error; and the codebooks (part, entry, component).

    Vectors that are null or hold null or non-finite components are dropped. All others come back. The width is that of
    the smallest id's vector that can be cut into equal parts; vectors of another width, and those with components so
    large that squares would leave 64 bits, have a null code and error and train nothing. Codebooks start from the
    smallest ids: an id that comes again counts once there, with its least vector, and a null id not at all, but every
    row is coded. With fewer ids there are fewer entries; without any, codebooks are empty and codes null. Sums
    beyond 64 bits are null. Columns beyond the three are not read.
    """
    if not 0 < rules.entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    source = vectors.select(
        vectors[id_column].cast("long").alias("_id"), vectors[vector_column].cast("array<double>").alias("_vector"), vectors[label_column].alias("_label")
    )
    kept = source.where(finite(F.col("_vector")))
    cuttable = kept.where(F.col("_id").isNotNull() & (F.size("_vector") > 0) & (F.size("_vector") % rules.parts == 0))
    head = cuttable.select("_id", F.size("_vector")).orderBy("_id", F.size("_vector")).first()
    width = head[1] if head else rules.parts
    largest = (1 << 28) // (width // rules.parts)
    fits = (F.size("_vector") == width) & F.forall("_vector", lambda x: F.abs(x) * rules.scale < largest)
    fitting = kept.where(fits)
    codebooks = first_codebooks(fitting, rules, width)
    for _ in range(rules.rounds if codebooks.size else 0):
        codebooks = retrained(fitting, codebooks, rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(b) for b in codebooks]
        offsets = rules.parts
        for batch in batches:
            known = np.asarray(batch.column(1).is_valid()) & (codebooks.shape[1] > 0)
            codes, errors = assign(scaled(batch.column(1).filter(pa.array(known)), width, rules.scale), books)
            place = np.concatenate([[0], np.cumsum(known) * offsets]).astype(np.int32)
            code = pa.BinaryArray.from_buffers(pa.binary(), len(known), [None, pa.py_buffer(place), pa.py_buffer(codes.astype(np.uint8))])
            error = np.zeros(len(known), np.int64)
            error[known] = errors
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), code, pa.array(error, mask=~known)], names=["vec_id", "label", "_code", "error"])

    shape = f"vec_id long, label {source.schema['_label'].dataType.simpleString()}, _code binary, error long"
    coded = kept.select("_id", F.when(fits, F.col("_vector")).alias("_vector"), "_label").mapInArrow(tidy(run), shape)
    code = F.when(F.length("_code") > 0, F.lower(F.hex("_code"))).alias("code")
    return with_label_error(stage(coded.select("vec_id", "label", code, "error"), "codes")), codebooks


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def op11_equal_average_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, codebooks = compress(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def op11_sql(rules: Rules = Rules()) -> str:
    """The same by comparing each part with every entry."""
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT vec_id, label, embedding, len(embedding) // {rules.parts} AS dim FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        f"""pieces AS MATERIALIZED (
    SELECT vec_id, k // dim AS part, k % dim AS i, CAST(floor({rules.scale} * CAST(embedding[k + 1] AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT vec_id, embedding, dim, unnest(range(len(embedding))) AS k FROM kept))""",
        f"""book0 AS MATERIALIZED (
    SELECT entry, part, i, x FROM pieces
    JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {rules.entries}) USING (vec_id))""",
    ]
    for k in range(rules.rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (
    SELECT vec_id, part, min(d * 256 + entry) AS found FROM (
        SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d
        FROM pieces p JOIN book{k} b ON p.part = b.part AND p.i = b.i GROUP BY p.vec_id, p.part, b.entry) GROUP BY vec_id, part)"""
        )
        if k < rules.rounds:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (
    SELECT b.entry, b.part, b.i, CAST(coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.x) AS BIGINT) AS x FROM book{k} b LEFT JOIN (
        SELECT found % 256 AS entry, part, i, sum(x) AS s, count(*) AS n FROM near{k} JOIN pieces USING (vec_id, part) GROUP BY ALL) m
    ON b.entry = m.entry AND b.part = m.part AND b.i = m.i)"""
            )
    last = rules.rounds
    steps.append(
        f"""coded AS (
    SELECT vec_id, string_agg(printf('%02x', CAST(found % 256 AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(found // 256) AS BIGINT) AS error
    FROM near{last} GROUP BY vec_id)"""
    )
    return (
        "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(x, ',' ORDER BY part, entry, i)) FROM book{last}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""
    )
