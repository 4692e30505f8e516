"""Quality classifier by co-training of two views.

One classifier sees a document's text (hashed byte n-grams and the shares of repeated, upper-case and symbol characters),
the other its metadata (source, language, length class). Both learn from the labelled documents. Then, in rounds, each
scores a pool of unlabelled ones, and the ones it is surest of join the other's training rows with its label. At the end
both views are calibrated on labelled documents that neither has learned from, and a third fit there weighs them against
each other; a view that tells nothing gets no weight. All documents are scored.

Learning uses bounded samples, chosen by a hash of the id; scoring is one pass over all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosync.llm.fertility import base_counts
from geosync.llm.staging import documents, tidy
from geosync.llm.textbytes import Slice, mix, text_slices

#: Buckets of the hashed n-grams and of the hashed metadata.
GRAM_BITS, META_BITS, GRAM = 11, 10, 4
SHARES = 6
RESULT = "doc_id long, text_score double, meta_score double, score double, kept boolean"
#: Texts turned into features at once.
TEXTS = 256


@dataclass(frozen=True)
class Rules:
    """Bounds of the samples, rounds, and what counts as sure."""

    labelled: int = 6_000
    pool: int = 6_000
    rounds: int = 4
    sure: float = 0.97
    #: Most rows that a view hands to the other in a round, for each class.
    handed: int = 500
    calibration: float = 0.25
    steps: int = 150
    ridge: float = 1e-4
    #: Documents below this score are not kept.
    least: float = 0.5


def text_features(part: Slice) -> np.ndarray:
    """A row per text: normalised n-gram weights, then the shares."""
    n, size = len(part), 1 << GRAM_BITS
    data = part.data.astype(np.uint64)
    out = np.zeros((n, size + SHARES), np.float32)
    if len(data) >= GRAM:
        code = np.zeros(len(data) - GRAM + 1, np.uint64)
        for k in range(GRAM):
            code = code << np.uint64(8) | data[k : len(data) - GRAM + 1 + k]
        text = np.repeat(np.arange(n), np.diff(part.offsets))
        whole = text[: len(code)] == text[GRAM - 1 :]
        key = text[: len(code)][whole] << GRAM_BITS | (mix(code[whole]) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
        grams = np.log1p(np.bincount(key, minlength=n * size).reshape(n, size).astype(np.float32))
        out[:, :size] = grams / np.maximum(np.sqrt((grams * grams).sum(1, keepdims=True)), 1e-9)
    counts = base_counts(part)
    words = np.maximum(counts["n_words"], 1)
    chars = np.maximum(np.diff(part.offsets), 1)
    upper = part.per_text((part.data >= 0x41) & (part.data <= 0x5A))
    other = part.per_text((part.data < 0x80) & ~(((part.data | 0x20) >= 0x61) & ((part.data | 0x20) <= 0x7A)))
    shares = (counts["n_repeat_words"] / words, counts["n_dup_lines"] / words, upper / chars, counts["n_symbols"] / words, other / chars, np.minimum(words, 200) / 200)
    out[:, size:] = np.stack(shares, axis=1)
    return out


def meta_features(sources: list, languages: list, lengths: list) -> np.ndarray:
    """A row per document: three hashed marks, for source, language and length class; null is a mark of its own."""
    out = np.zeros((len(sources), 1 << META_BITS), np.float32)
    for name, values in (("source", sources), ("lang", languages), ("length", [None if x is None else int(x).bit_length() for x in lengths])):
        marks = np.array([int.from_bytes(f"{name}={x}".encode()[-64:], "little") % (2**61 - 1) for x in values], np.uint64)
        if len(marks):
            out[np.arange(len(marks)), (mix(marks) >> np.uint64(64 - META_BITS)).astype(np.int64)] += 1
    return out


@dataclass
class Linear:
    """Logistic regression."""

    weights: np.ndarray
    bias: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, steps: int, ridge: float) -> Linear:
    """Weights by Adam on all rows, both classes weighing the same."""
    w = np.zeros(x.shape[1] + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    share = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    for step in range(1, steps + 1):
        away = (sigmoid(x @ w[:-1].astype(x.dtype) + w[-1]) - y) * share
        slope = np.append(away.astype(x.dtype) @ x, away.sum()) + ridge * np.append(w[:-1], 0)
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        w -= 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Linear(w[:-1].astype(np.float32), float(w[-1]))


@dataclass
class Model:
    """Both views, the calibration of each, and how they are combined."""

    text: Linear
    meta: Linear
    calibrated: tuple[Linear, Linear]
    combined: Linear

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        margins = [c.margin(v.margin(x)[:, None]) for v, x, c in zip((self.text, self.meta), (text, meta), self.calibrated)]
        return sigmoid(margins[0]), sigmoid(margins[1]), sigmoid(self.combined.margin(np.stack(margins, axis=1)))


def co_train(text: np.ndarray, meta: np.ndarray, labels: np.ndarray, rules: Rules) -> Model | None:
    """A model from rows with a label (0 or 1) and rows without (-1); None if a class has too few labels."""
    known = np.flatnonzero(labels >= 0)
    if min((labels[known] == 0).sum(), (labels[known] == 1).sum()) < 8:
        return None
    step = max(2, round(1 / rules.calibration))
    # every so many of each class, so that both parts hold both
    held = np.concatenate([known[labels[known] == c][::step] for c in (0, 1)])
    learned = np.setdiff1d(known, held)
    pool = np.flatnonzero(labels < 0)
    views = (text, meta)
    rows, given = [learned, learned], [labels[learned].astype(float)] * 2
    models = [fit(x[r], y, rules.steps, rules.ridge) for x, r, y in zip(views, rows, given)]
    for _ in range(rules.rounds):
        if not len(pool):
            break
        sure = []
        for x, model in zip(views, models):
            p = sigmoid(model.margin(x[pool]))
            order = np.argsort(p, kind="stable")
            low = order[: rules.handed][p[order[: rules.handed]] <= 1 - rules.sure]
            high = order[::-1][: rules.handed][p[order[::-1][: rules.handed]] >= rules.sure]
            sure.append((np.concatenate([low, high]), np.concatenate([np.zeros(len(low)), np.ones(len(high))])))
        for own, (taken, values) in zip((0, 1), (sure[1], sure[0])):
            rows[own] = np.concatenate([rows[own], pool[taken]])
            given[own] = np.concatenate([given[own], values])
        taken = np.union1d(sure[0][0], sure[1][0]).astype(np.int64)
        if not len(taken):
            break
        pool = np.delete(pool, taken)
        models = [fit(x[r], y, rules.steps, rules.ridge) for x, r, y in zip(views, rows, given)]
    y = labels[held].astype(float)
    margins = [m.margin(x[held])[:, None].astype(float) for m, x in zip(models, views)]
    calibrated = tuple(fit(m, y, rules.steps, 1e-3) for m in margins)
    both = np.stack([c.margin(m) for c, m in zip(calibrated, margins)], axis=1)
    return Model(models[0], models[1], calibrated, fit(both, y, rules.steps, 1e-3))


def features(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row and both views of a few rows at a time; columns: text, source, lang, n_chars."""
    texts, sources, languages, lengths = batch.columns
    for lo in range(0, len(texts), TEXTS):
        for part in text_slices(texts.slice(lo, TEXTS)):
            at, n = lo + part.lo, len(part)
            columns = [c.slice(at, n).to_pylist() for c in (sources, languages, lengths)]
            yield at, text_features(part), meta_features(*columns)


def score(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Scores from 0 to 1 for every row of ``docs`` (doc_id, text, source, lang, n_chars) by ``labels`` (doc_id, quality).

    A null text has no n-grams, null metadata is a value of its own, repeated rows each give a row. An id labelled twice
    counts once, with its larger label; labels other than 0 and 1 and null are left out. With too few labels of a class,
    all scores are 0.5 and all rows kept. Other columns are not read.
    """
    wanted = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["source"].cast("string").alias("source"),
        docs["lang"].cast("string").alias("lang"), docs["n_chars"].cast("long").alias("n_chars"),
    )
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("label"))
    known = known.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    everyone = wanted.select("doc_id").distinct().join(known, "doc_id", "left").select("doc_id", F.coalesce("label", F.lit(-1)).alias("label"))
    counts = {r["known"]: r["n"] for r in everyone.groupBy((F.col("label") >= 0).alias("known")).agg(F.count("*").alias("n")).collect()}

    def drawn(known: bool, most: int):
        limit = int(2.0**31 * min(1.0, most / max(1, counts.get(known, 0))))
        return ((F.col("label") >= 0) == F.lit(known)) & (F.shiftrightunsigned(F.xxhash64("doc_id"), 33) < limit)

    chosen = everyone.where(drawn(True, rules.labelled) | drawn(False, rules.pool))
    sample = wanted.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, text, meta in features(pa.RecordBatch.from_arrays(batch.columns[2:], names=["t", "s", "l", "n"])):
                row, column = np.nonzero(text)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(text)))]).astype(np.int32)
                mark_row, marks = np.nonzero(meta)
                mark_bounds = np.concatenate([[0], np.cumsum(np.bincount(mark_row, minlength=len(meta)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(text)), batch.column(1).slice(at, len(text)),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(column.astype(np.int16))),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(text[row, column])),
                        pa.ListArray.from_arrays(pa.array(mark_bounds), pa.array(marks.astype(np.int16))),
                        pa.ListArray.from_arrays(pa.array(mark_bounds), pa.array(meta[mark_row, marks])),
                    ],
                    names=["doc_id", "label", "place", "weight", "mark", "times"],
                )

    shape = "doc_id long, label int, place array<short>, weight array<float>, mark array<short>, times array<float>"
    table = sample.select("doc_id", "label", "text", "source", "lang", "n_chars").mapInArrow(tidy(collect), shape).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()

    def dense(places: str, values: str, width: int) -> np.ndarray:
        out = np.zeros((len(table), width), np.float32)
        column = table.column(places).combine_chunks()
        row = np.repeat(np.arange(len(table)), np.asarray(column.value_lengths()))
        out[row, np.asarray(column.flatten())] = np.asarray(table.column(values).combine_chunks().flatten())
        return out

    model = None
    if len(table):
        text, meta = dense("place", "weight", (1 << GRAM_BITS) + SHARES), dense("mark", "times", 1 << META_BITS)
        model = co_train(text, meta, np.asarray(table.column("label")), rules)
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model
        for batch in batches:
            parts = [np.zeros((3, 0))]
            for _, text, meta in features(pa.RecordBatch.from_arrays(batch.columns[1:], names=["t", "s", "l", "n"])):
                parts.append(np.stack(own.scores(text, meta)) if own else np.full((3, len(text)), 0.5))
            scores = np.concatenate(parts, axis=1)
            kept = scores[2] >= (rules.least if own else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(s) for s in scores), pa.array(kept)], names=[x.split()[0] for x in RESULT.split(", ")])

    return wanted.mapInArrow(tidy(run), RESULT)


def op4_co_training_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
