"""Removal of every byte that lies in a long string which the corpus holds more than once, exactly.

1. *Anchors.* Of all grams in a window of ``least`` bytes, the one with the smallest hash is its anchor. It depends on
   the window's bytes alone, so equal windows have equal anchors at equal distances.
2. *Cells.* The starts of windows with one anchor are dealt into cells by their distance from it. All windows of a cell
   share its core, most of ``least`` bytes, and the core's hash is the cell's key. Equal windows meet under one key, so
   keys are compared each for itself, over the whole cluster. A passage that a third of all documents hold is spread
   over its cells, and what surrounds it makes other keys.
3. Under a key, copies of the same bytes are one segment, and all their starts repeat. Keys with one segment are done.
   Copies that one task meets travel as one row.
4. *Blocks.* The different segments of a key are compared by interval expansion on the Burrows-Wheeler transform
   (``bwt.repeated``), which stops at ``least``. A block holds whole keys, up to a bounded number of bytes.
5. A key with more segments than a block may hold is not given to one task: its segments are dealt again, into cells of
   a quarter of the width. Their windows share a longer core, so keys are rarer; copies and blocks are found as before,
   and keys that still are too large are dealt again. A cell of width one is a single window, whose copies are alike.

Starts found come back to their documents, where the bytes they cover are cut out.

Passages of so many words go the same way: each word of the lower-cased text is written as ``CODE`` bytes of its hash, so
equal runs of words are equal strings of one length, whatever the words' own lengths and the white space between them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geosync.llm.bitmaps import marked, thinned
from geosync.llm.bwt import MOST, repeated, spans
from geosync.llm.language import lowered
from geosync.llm.staging import carried, carried_arrays, discard, documents, stage, tidy
from geosync.llm.textbytes import SPACE, Hashes, Slice, group_starts, mix, text_slices

#: Starts of one long text that are handled at once.
CHUNK = 1 << 20
#: Segments of a text whose anchors are looked for at once.
CUTS = 1 << 11
#: Bytes that stand for a word, with 7 bits of its hash each, so that they are a string too.
CODE = 8


@dataclass(frozen=True)
class Rules:
    """Bytes of a repeated string, of an anchor's gram and of a cell; bytes of a block; segments of a key in one block."""

    least: int = 400
    gram: int = 64
    cell: int = 96
    block: int = 1 << 18
    segments: int = 250

    def most_segments(self) -> int:
        return max(1, min(self.segments, (MOST - self.block) // (self.least + self.cell) - 1))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from running minima of blocks in both directions."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(rows, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def cells_of(part: Slice, rules: Rules) -> tuple[np.ndarray, ...]:
    """Key, segment, text, first start and number of starts of each cell of some texts."""
    least, gram, cell = rules.least, rules.gram, rules.cell
    n = len(part.data)
    if n < least:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    hashes = Hashes(part.data)
    at = np.arange(n - gram + 1)
    grams = hashes.of(at, at + gram)
    # ties among the upper bits go to the first gram
    anchors = (sliding_least((grams >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64), least - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(part)), np.diff(part.offsets))
    starts = np.flatnonzero(text[: n - least + 1] == text[least - 1 :])
    key, segment, first, count = dealt(hashes, starts, anchors[starts], least, cell)
    owner = text[first]
    return key, segment, owner, first - part.offsets[owner], count


def dealt(hashes: Hashes, starts: np.ndarray, anchors: np.ndarray, least: int, cell: int) -> tuple[np.ndarray, ...]:
    """Key, segment, first start and number of starts of the cells that ascending starts with these anchors fall into."""
    place = (starts - anchors) // cell
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(starts)))
    first, anchor, place = starts[heads], anchors[heads], place[heads]
    core = anchor + place * cell
    key = mix(hashes.of(core + cell - 1, core + least) + place.astype(np.uint64))
    segment = mix(hashes.of(first, first + count - 1 + least) + (first - anchor).astype(np.uint64))
    return key, segment, first, count


def dealt_again(data: np.ndarray, first: np.ndarray, n: np.ndarray, rules: Rules, cell: int) -> tuple[np.ndarray, ...]:
    """``dealt`` for segments of one text, given by first start and number of starts, with cells of another width."""
    hashes = Hashes(data)
    order = np.argsort(first, kind="stable")
    first, n = first[order], n[order]
    anchors = np.empty(len(first), np.int64)
    for lo in range(0, len(first), CUTS):  # the windows of a segment have one anchor
        at = first[lo : lo + CUTS, None] + np.arange(rules.least - rules.gram + 1)
        anchors[lo : lo + CUTS] = first[lo : lo + CUTS] + (hashes.of(at, at + rules.gram) >> np.uint64(32)).argmin(axis=1)
    return dealt(hashes, spans(first, first + n), np.repeat(anchors, n), rules.least, cell)


def pieces(part: Slice, rules: Rules) -> Iterator[tuple[Slice, int]]:
    """A slice as it is, or a long text in chunks that overlap by a window, with each chunk's place."""
    if len(part) > 1 or len(part.data) <= 2 * CHUNK:
        yield part, 0
        return
    for lo in range(0, len(part.data) - rules.least + 1, CHUNK):
        data = part.data[lo : lo + CHUNK + rules.least - 1]
        yield Slice(part.lo, part.hi, data, np.array([0, len(data)])), lo


def cells(docs: DataFrame, rules: Rules) -> DataFrame:
    """All cells of the texts of ``docs`` (_key, _text). ``more`` has the other places of a segment met more than once."""
    place = pa.list_(pa.struct([("key", pa.int64()), ("start", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for part in text_slices(batch.column(1)):
                for piece, shift in pieces(part, rules):
                    cell, segment, owner, start, count = cells_of(piece, rules)
                    order = np.argsort(mix(segment ^ mix(cell)), kind="stable")
                    cell, segment, owner, start, count = (x[order] for x in (cell, segment, owner, start + shift, count))
                    new = np.ones(len(cell), bool)
                    new[1:] = (cell[1:] != cell[:-1]) | (segment[1:] != segment[:-1])
                    first = np.flatnonzero(new)
                    key = keys[owner + part.lo]
                    others = np.concatenate([[0], np.cumsum(np.diff(np.append(first, len(cell))) - 1)]).astype(np.int32)
                    values = pa.StructArray.from_arrays([pa.array(key[~new]), pa.array(start[~new])], fields=list(place.value_type))
                    more = pa.ListArray.from_arrays(pa.array(others), values, mask=pa.array(np.diff(others) == 0)).cast(place)
                    columns = [cell[first].view(np.int64), segment[first].view(np.int64), key[first], start[first], count[first].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), more], names=["cell", "segment", "key", "start", "n", "more"])

    shape = "cell long, segment long, key long, start long, n int, more array<struct<key:long,start:long>>"
    return docs.select("_key", "_text").mapInArrow(tidy(run), shape)


def compared(segments: DataFrame, rules: Rules) -> DataFrame:
    """Repeated starts among segments (cell, key, start, n, bytes), each cell for itself: key, start, n."""

    def search(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        keys, starts, data = table.column("key").to_pylist(), table.column("start").to_pylist(), table.column("bytes").to_pylist()
        line = np.frombuffer(b"".join(x + b"\0" for x in data), np.uint8).astype(np.uint16) + 1
        ends = np.cumsum([len(x) + 1 for x in data])
        line[ends - 1] = 0
        hit = repeated(line, rules.least)
        # runs of found starts, none beyond its segment
        first = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
        last = np.flatnonzero(hit & ~np.concatenate([hit[1:], [False]]))
        row = np.searchsorted(ends, first, side="right")
        begins = ends[row] - np.array([len(x) + 1 for x in data])[row]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([keys[k] for k in row.tolist()], pa.int64()), pa.array(np.array(starts)[row] + first - begins, pa.int64()),
                pa.array((last - first + 1).astype(np.int32)),
            ],
            names=["key", "start", "n"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            cell = np.asarray(batch.column(0))
            ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)) if len(cell) else []
            sizes = np.cumsum(np.asarray(pc.binary_length(batch.column(4)), np.int64) + 1) if len(cell) else []
            lo = 0
            for hi in ends:
                if held and size >= rules.block and cell[lo] != last:
                    yield search(held)
                    held, size = [], 0
                held.append(batch.slice(lo, hi - lo))
                size += int(sizes[hi - 1] - (sizes[lo - 1] if lo else 0))
                last, lo = cell[hi - 1], hi
        if held:
            yield search(held)

    size = segments.agg(F.sum(F.length("bytes") + 1)).first()[0] or 0
    dealt = segments.repartition(max(1, math.ceil(size / (2 * rules.block))), "cell").sortWithinPartitions("cell")
    return dealt.select("cell", "key", "start", "n", "bytes").mapInArrow(tidy(run), "key long, start long, n int")


def several_under_a_key(rows: DataFrame) -> DataFrame:
    """Those of the cells that share their key with another, and how their segments compare with those beside them."""
    by = Window.partitionBy("cell").orderBy("segment", "key", "start")
    same_before = F.coalesce(F.lag("segment").over(by) == F.col("segment"), F.lit(False))
    rows = rows.select(
        "*", same_before.alias("before"), F.lead("segment").over(by).alias("next"), F.dense_rank().over(Window.partitionBy("cell").orderBy("segment")).alias("rank"), F.row_number().over(by).alias("row"),
        F.first(F.struct("key", "start", "n")).over(by).alias("head"),
    )
    after = F.coalesce(F.col("next") == F.col("segment"), F.lit(False)).alias("after")
    head = F.when(F.expr("rank = 2 AND NOT before"), F.col("head")).alias("head")  # the first segment, once there is a second
    return rows.where("row > 1 OR next IS NOT NULL OR more IS NOT NULL").select("cell", "key", "start", "n", "more", "before", after, "rank", head)


def cut_out(asked: DataFrame, rules: Rules, cell: int) -> DataFrame:
    """The bytes of the segments that ``asked`` (key, cuts, text) names; crowded ones as cells of the width ``cell`` instead."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                data = (batch.column(2)[at].as_py() or "").encode()
                key = batch.column(0)[at].as_py()
                cuts = batch.column(1)[at].as_py()
                whole = [c for c in cuts if not c["crowded"]]
                columns = [[c["cell"] for c in whole], [key] * len(whole), [c["start"] for c in whole], [c["n"] for c in whole]]
                columns += [[data[c["start"] : c["start"] + c["n"] - 1 + rules.least] for c in whole], [None] * len(whole)]
                many = [c for c in cuts if c["crowded"]]
                if many:
                    first, n = (np.array([c[name] for c in many], np.int64) for name in ("start", "n"))
                    keys, segments, starts, counts = dealt_again(np.frombuffer(data, np.uint8), first, n, rules, cell)
                    new = [keys.view(np.int64).tolist(), [key] * len(keys), starts.tolist(), counts.tolist(), [None] * len(keys), segments.view(np.int64).tolist()]
                    columns = [a + b for a, b in zip(columns, new)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["cell", "key", "start", "n", "bytes", "segment"])

    return asked.mapInArrow(tidy(cut), "cell long, key long, start long, n int, bytes binary, segment long")


def repeated_starts(docs: DataFrame, rules: Rules, scratch: list[DataFrame]) -> DataFrame:
    """Where strings of ``least`` bytes start that start elsewhere too: key, and runs as start and n. ``docs``: _key, _text.

    ``scratch`` gets the tables it stages, to be discarded when the result is written.
    """

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(stage(df, name))
        return scratch[-1]

    rows, width = cells(docs, rules), rules.cell
    found: list[DataFrame] = []
    while True:
        several = kept(several_under_a_key(rows), "cells")
        found.append(several.where("before OR after OR more IS NOT NULL").select("key", "start", "n"))
        found.append(several.where("more IS NOT NULL").select("n", F.explode("more").alias("m")).select("m.key", "m.start", "n"))
        if width == 1:
            break
        width = max(1, width // 4)
        different = several.where("rank > 1 AND NOT before").select("cell", "key", "start", "n")
        different = different.unionAll(several.where("head IS NOT NULL").select("cell", "head.key", "head.start", "head.n"))
        crowded = different.groupBy("cell").count().where(F.col("count") > rules.most_segments()).select("cell", F.lit(True).alias("crowded"))
        place = F.struct("cell", "start", "n", F.coalesce("crowded", F.lit(False)).alias("crowded"))
        asked = kept(different.join(crowded, "cell", "left").groupBy("key").agg(F.collect_list(place).alias("cuts")), "cuts")
        texts = thinned(docs.select(F.col("_key").alias("key"), F.col("_text").alias("text")), "key", asked.select("key")).dropDuplicates(["key"])
        segments = kept(cut_out(asked.join(texts, "key").select("key", "cuts", "text"), rules, width), "segments")
        discard(asked)
        found.append(compared(segments.where("bytes IS NOT NULL"), rules))
        again = segments.where("bytes IS NULL")
        if again.isEmpty():
            break
        rows = again.select("cell", "segment", "key", "start", "n", F.lit(None).cast("array<struct<key:long,start:long>>").alias("more"))
    return reduce(DataFrame.unionAll, found)


def coded(docs: DataFrame) -> DataFrame:
    """``docs`` (_key, _text) with each word of the lower-cased text as ``CODE`` bytes, and nothing between them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(lowered(batch.column(1))):
                starts, ends, text = part.runs(~SPACE[part.data])
                codes = Hashes(part.data).of(starts, ends).view(np.uint8) & 0x7F
                offsets = (group_starts(text, len(part)) * CODE).astype(np.int32)
                texts = pa.StringArray.from_buffers(len(part), pa.py_buffer(offsets), pa.py_buffer(codes))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.lo, len(part)), texts], names=["_key", "_text"])

    return docs.select("_key", "_text").mapInArrow(tidy(run), "_key long, _text string")


def word_spans(data: np.ndarray, starts: np.ndarray, words: int) -> np.ndarray:
    """First byte and end in a text of the words that starts (first, last) in its coded form cover.

    Only starts of words count; others repeat where words beside the same ones agree in a part of their codes.
    """
    inside = np.concatenate([[False], ~SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    first, last = -(-starts[:, 0] // CODE), starts[:, 1] // CODE
    some = first <= last
    return np.stack([edges[first[some], 0], edges[last[some] + words - 1, 1]], axis=1)


def strip(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (), rules: Rules = Rules(), words: int = 0, characters: bool = False,
    scratch: list[DataFrame] | None = None,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, the removed runs as ``spans`` (start, length) and ``kept``, the rest.

    A byte goes if it lies in a string of ``rules.least`` bytes that starts anywhere else too, in the same text or
    another; strings are judged on the input. A null text is empty, and shorter texts stay whole. Repeated rows are each
    other's copies, so all of a long one goes. With ``words``, runs of so many words go instead, from
    their first word to their last, however few bytes they have; case and white space make no difference, and words are
    compared by 56 bits of their hashes. With ``characters``, those that a run cuts in half go too. ``keep`` are columns carried along
    (the text with null as empty); others are not read. Equality of
    strings outside blocks, and of rows, goes by 64-bit hashes under a key. ``scratch`` gets the tables staged on the
    way, which a caller may discard once the result is written.
    """
    scratch = [] if scratch is None else scratch
    rows = carried(docs, id_column, text_column, keep).withColumn("_text", F.coalesce("_text", F.lit(""))).withColumn("_key", F.xxhash64("_id", "_text"))
    # each row is counted, also where id and text come again
    found = repeated_starts(coded(rows), replace(rules, least=words * CODE), scratch) if words else repeated_starts(rows, rules, scratch)
    starts = stage(found.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("_runs")), "starts")
    scratch.append(starts)
    columns = ["_id", "_text", "_runs", *(f"_keep_{c}" for c in keep if c != text_column)]
    # texts that nothing was found in stay where they are
    met = marked(rows, "_key", starts.select("key"), "left")
    joined = met.where("_met").join(starts, F.col("_key") == F.col("key"), "left").select(*columns)
    joined = joined.unionAll(met.where("NOT _met").withColumn("_runs", F.lit(None).cast(starts.schema["_runs"].dataType)).select(*columns))
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, cuts, rest = [], [], [], []
            runs = batch.column(2)
            for at, text in enumerate(batch.column(1)):
                data = text.as_py().encode()
                lists: list[dict] = []
                found = np.array([(r["start"], r["start"] + r["n"] - 1) for r in runs[at].as_py() or []], np.int64).reshape(-1, 2)
                if len(found):
                    found = word_spans(np.frombuffer(data, np.uint8), found, words) if words else found + [0, rules.least]
                if len(found) and characters:
                    inner = np.append((np.frombuffer(data, np.uint8) & 0xC0) == 0x80, False).astype(np.int64)
                    for _ in range(3):
                        found += inner[found] * [-1, 1]
                if len(found):
                    found = found[np.argsort(found[:, 0])]
                    reach = np.maximum.accumulate(found[:, 1])
                    heads = np.flatnonzero(np.concatenate([[True], found[1:, 0] > reach[:-1]]))
                    lo, hi = found[heads, 0].tolist(), reach[np.append(heads[1:], len(found)) - 1].tolist()
                    lists = [{"start": a, "length": b - a} for a, b in zip(lo, hi)]
                    data_kept = b"".join(data[a:b] for a, b in zip([0, *hi], [*lo, len(data)]))
                else:
                    data_kept = data
                sizes.append(len(data))
                removed.append(len(data) - len(data_kept))
                cuts.append(lists)
                rest.append(data_kept)
            own = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(cuts, spans_type), pa.array(rest, pa.binary())]
            others = carried_arrays(keep, text_column, batch.column(1), batch.columns[3:])
            yield pa.RecordBatch.from_arrays([*own, *others], names=[*names, *keep])

    shape = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,length:long>>, kept binary"
    shape += "".join(f", {c} {t}" for c, t in docs.select(*keep).dtypes) if keep else ""
    return joined.mapInArrow(tidy(run), shape)


def op6_bwt_interval_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = strip(documents(spark, folder))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
