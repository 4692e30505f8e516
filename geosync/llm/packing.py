"""Packs documents into windows of a fixed number of tokens, in order, with cuts chosen by dynamic programming.

The tokens of a partition's documents form one line. Windows may end where a document or a sentence ends, or, in a
sentence longer than ``Rules.longest``, at every so many tokens. With c the place of an end and p the penalty of a cut
there, the best cost up to end j is ::

    f(j) = p(j) + min over i with c(j) - c(i) <= window of f(i) + padding(c(j) - c(i))

Padding is window - (c(j) - c(i)), so the minimum is that of f(i) + c(i) over a sliding range, which a monotone queue
gives in constant time. A window as long as a power of two is not padded; those few i are looked up beside the queue.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from geosync.llm.bpe import default_path, library_encoder
from geosync.llm.staging import documents, few_rows, tidy

RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Rows of a result batch.
ROWS = 20_000


@dataclass(frozen=True)
class Rules:
    """The window, the penalties in tokens of padding, and the tokens that are planned at once."""

    window: int = 4096
    sentence_cut: float = 6.0
    hard_cut: float = 48.0
    longest: int = 512
    shortest_power: int = 64
    planned: int = 96 * 4096


def choose_cuts(ends: np.ndarray, penalties: np.ndarray, rules: Rules, final: bool) -> list[int]:
    """The ends that close a window, in order. ``ends`` rise by ``window`` at most.

    If not ``final``, more tokens follow: the last cut is then the cheapest one within a window of the last end.
    """
    places = [0, *ends.tolist()]
    cost = [0.0] * len(places)
    origin = [0] * len(places)
    spans = []
    power = rules.shortest_power
    while power < rules.window:
        spans.append(power)
        power *= 2
    line = np.array(places)
    partner: list[list[int]] = [[] for _ in places]
    for span in spans:
        found = np.searchsorted(line, line - span)
        for j in np.flatnonzero((line >= span) & (line[np.minimum(found, len(line) - 1)] == line - span)).tolist():
            partner[j].append(int(found[j]))
    queue: deque[int] = deque([0])
    window = rules.window
    penalty = [0.0, *penalties.tolist()]
    for j in range(1, len(places)):
        here = places[j]
        while here - places[queue[0]] > window:
            queue.popleft()
        best = queue[0]
        least = cost[best] + places[best] - here + window
        for i in partner[j]:
            if cost[i] < least:
                least, best = cost[i], i
        value = cost[j] = least + penalty[j]
        origin[j] = best
        value += here
        while queue and cost[queue[-1]] + places[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    last = len(places) - 1
    if not final:
        first = int(np.searchsorted(line, line[-1] - window, side="right"))
        last = min(range(max(1, first), len(places)), key=cost.__getitem__)
    cuts = []
    while last:
        cuts.append(places[last])
        last = origin[last]
    return cuts[::-1]


class Packer:
    """Packs the documents of one partition; ``rows`` holds the pieces that are ready."""

    def __init__(self, rules: Rules, sentence_ends: np.ndarray, first_sequence: int):
        self.rules = rules
        self.sentence_ends = sentence_ends
        self.sequence = first_sequence
        self.pending: list[tuple[object, int, np.ndarray, int]] = []
        self.tokens = 0
        self.rows: list[list] = []

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        self.pending.append((doc_id, 0, ids, len(ids)))
        self.tokens += len(ids)
        if self.tokens >= self.rules.planned:
            self.plan(False)

    def plan(self, final: bool) -> None:
        if not self.tokens:
            return
        line = np.concatenate([ids for _, _, ids, _ in self.pending])
        doc_ends = np.cumsum([len(ids) for _, _, ids, _ in self.pending])
        soft = np.flatnonzero(np.isin(line, self.sentence_ends)) + 1
        ends = np.union1d(doc_ends, soft)
        gaps = np.diff(ends, prepend=0)
        wide = np.flatnonzero(gaps > self.rules.longest)
        hard = [np.arange(ends[k] - gaps[k] + self.rules.longest, ends[k], self.rules.longest) for k in wide]
        penalties = np.full(len(ends), self.rules.sentence_cut)
        penalties[np.isin(ends, doc_ends)] = 0
        if hard:
            extra = np.concatenate(hard)
            order = np.argsort(np.concatenate([ends, extra]), kind="stable")
            ends = np.concatenate([ends, extra])[order]
            penalties = np.concatenate([penalties, np.full(len(extra), self.rules.hard_cut)])[order]
        cuts = choose_cuts(ends, penalties, self.rules, final)
        begin, k, left = 0, 0, []
        doc_begin = 0
        for doc_id, start, ids, total in self.pending:
            at, stop = doc_begin, doc_begin + len(ids)
            while at < stop and k < len(cuts):
                to = min(stop, cuts[k])
                piece = line[at:to]
                self.rows.append([doc_id, start + at - doc_begin, to - at, zlib.crc32(piece.tobytes()), total, self.sequence, at - begin])
                at = to
                if to == cuts[k]:
                    k += 1
                    begin = to
                    self.sequence += 1
            if at < stop:
                left.append((doc_id, start + at - doc_begin, ids[at - doc_begin :], total))
            doc_begin = stop
        self.pending = left
        self.tokens = sum(len(ids) for _, _, ids, _ in left)

    def take(self, rows: int = 0) -> Iterator[pa.RecordBatch]:
        """The ready pieces, if there are more than ``rows``."""
        if len(self.rows) > rows:
            columns = [pa.array(x, pa.int64()) for x in zip(*self.rows)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in RESULT.split(", ")])


def pack(docs: DataFrame, path: str, end_id: int = 2, rules: Rules = Rules(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece of a document: its place in the document, its ids' CRC-32, its sequence and place there.

    Documents keep the order of their partition and no token is lost or doubled; a null or empty text is ``end_id``
    alone, repeated rows are packed each for itself, other columns are not read. A sequence never reaches from one
    partition into the next, so only the last one of each partition can be short. No shuffle; a task holds the tokens of
    ``rules.planned`` and of one document. ``sequence_id`` is the partition's number times 2^33 plus a running number,
    so it depends on how the input is split.
    """
    few_rows(docs.sparkSession)
    marks = (".</w>", "!</w>", "?</w>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library_encoder(path)
        names = (bytes(x) for x in np.split(own.vocabulary.blob, own.vocabulary.places[1:]))
        ends = np.array([i for i, name in enumerate(names) if name.decode().rstrip() in marks], "<u4")
        closing = np.array([end_id], "<u4").tobytes()
        packer = Packer(rules, ends, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, np.frombuffer(own.encode(text.as_py() or "") + closing, "<u4"))
                yield from packer.take(ROWS)
        packer.plan(True)
        yield from packer.take()
        own.clear()  # the worker's next task may be of another stage

    return docs.select(docs[id_column].cast("long"), docs[text_column].cast("string")).mapInArrow(tidy(run), RESULT)


def op9_order_preserving_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder), default_path())
