"""Features of large GeoJSON collections, each file read by many tasks.

A task gets a range of bytes and cannot know whether it begins inside a string or how deep. So one pass sums up each
range for both cases: the parity of its quotes, the brackets it closes and leaves open, and how many objects begin at
each depth. From these sums, a row for each range, the driver follows the state from range to range. The second pass
knows its state, emits the features that begin in its range and reads on to the end of the last one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

RANGE = 64 << 20
#: Bytes read at once behind a range, at most and at least, and looked at before an opening bracket for its key.
MORE, LITTLE, KEY = 1 << 20, 1 << 12, 256
#: Tasks for each core that ranges are dealt to, if a task has no more than ``RANGE`` bytes then.
WAVES = 4
LIST = "features"
_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*$')


class _File:
    def __init__(self, path: str):
        system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
        self.file = system.open_input_file(name)

    def read(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)


def _escaped_start(file: _File, start: int) -> bool:
    """Whether an odd number of backslashes stands before a byte."""
    count, size = 0, 64
    while start - count > 0:
        low = max(0, start - size)
        before = file.read(low, start - low)
        count = len(before) - len(before.rstrip(b"\\"))
        if count < len(before):
            break
        size *= 4
    return count % 2 == 1


@dataclass
class _Brackets:
    """Brackets outside strings: places, whether they open, depth after them (from that at the start), and the bytes."""

    at: np.ndarray
    opens: np.ndarray
    depth: np.ndarray
    data: np.ndarray

    def key(self, k: int, before: bytes) -> str | None:
        """The name of the member that bracket ``k`` opens."""
        place = int(self.at[k])
        text = self.data[max(0, place - KEY) : place].tobytes()
        found = _KEY.search(before[-KEY:] + text if place < KEY else text)
        return found.group(1).decode("utf-8", "replace") if found else None


def _quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Whether each byte is a quote that opens or closes a string."""
    slash = data == ord("\\")
    place = np.arange(len(data))
    last_other = np.maximum.accumulate(np.where(slash, -1, place))
    run = place - last_other  # backslashes up to here; before the first other byte, those of the range's start count too
    odd = np.where(slash, (run + (escaped & (last_other < 0))) % 2 == 1, False)
    after = np.concatenate([[escaped], odd[:-1]]) if len(data) else odd
    return (data == ord('"')) & ~after


def _brackets(data: np.ndarray, quotes: np.ndarray, inside: bool) -> _Brackets:
    held = (np.cumsum(quotes) + inside) % 2 == 1
    opens = (data == ord("{")) | (data == ord("["))
    closes = (data == ord("}")) | (data == ord("]"))
    at = np.flatnonzero((opens | closes) & ~held)
    return _Brackets(at, opens[at], np.cumsum(np.where(opens[at], 1, -1)), data)


def _parents(b: _Brackets, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Objects that open to ``depth``, and for each the place in ``b`` of the bracket it lies in, -1 if that is before the range."""
    objects = np.flatnonzero(b.opens & (b.depth == depth) & (b.data[b.at] == ord("{")))
    above = np.flatnonzero(b.opens & (b.depth == depth - 1))
    place = np.searchsorted(above, objects) - 1
    return objects, np.where(place >= 0, above[place] if len(above) else -1, -1)


def _listed(b: _Brackets, depth: int, before: bytes) -> tuple[int, int]:
    """Objects at a depth that lie in the list of features, and those whose parent is before the range."""
    _, parents = _parents(b, depth)
    known = 0
    for parent, n in zip(*np.unique(parents[parents >= 0], return_counts=True)):
        if b.data[b.at[parent]] == ord("[") and b.key(int(parent), before) == LIST:
            known += int(n)
    return known, int((parents < 0).sum())


def _summed(file: _File, start: int, size: int) -> dict:
    raw = file.read(start, size)
    before = file.read(max(0, start - KEY), min(start, KEY))
    data = np.frombuffer(raw, np.uint8)
    quotes = _quotes(data, _escaped_start(file, start))
    cases = []
    for inside in (False, True):
        b = _brackets(data, quotes, inside)
        pops = max(0, -int(b.depth.min())) if len(b.depth) else 0
        low = np.minimum.accumulate(b.depth[::-1])[::-1] if len(b.depth) else b.depth
        left = np.flatnonzero(b.opens & (low >= b.depth))
        opened = [[chr(data[b.at[k]]), b.key(int(k), before)] for k in left.tolist()]
        counts, systems = {}, {}
        for depth in np.unique(b.depth[b.opens]).tolist():
            counts[depth] = _listed(b, depth, before)
            # a list's elements are many and have no key, a member is one
            for k in np.flatnonzero(b.opens & (b.depth == depth) & (b.data[b.at] == ord("{")))[:50].tolist():
                if b.key(k, before) == "crs":
                    text = file.read(start + int(b.at[k]), MORE).decode("utf-8", "replace")
                    try:
                        systems.setdefault(depth, text[: json.JSONDecoder().raw_decode(text)[1]])
                    except ValueError:  # within a string, if the other case holds
                        continue
        cases.append({"pops": pops, "opened": opened, "counts": counts, "systems": systems})
    return {"parity": int(quotes.sum()) % 2, "cases": cases}


def _followed(sums: list[dict]) -> tuple[list[tuple[bool, int, bool, int]], str | None]:
    """Per range of a file whether it begins in a string, how deep, whether in the list of features, and the number of
    features before; and the text of the collection's system."""
    states, inside, stack, number, system = [], False, [], 0, None
    for s in sums:
        case = s["cases"][inside]
        listed = len(stack) >= 2 and stack[1] == ["[", LIST]
        states.append((inside, len(stack), listed, number))
        known, unknown = case["counts"].get(str(3 - len(stack)), (0, 0))
        number += known + (unknown if listed else 0)
        system = system or case["systems"].get(str(2 - len(stack)))
        stack = stack[: max(0, len(stack) - case["pops"])] + case["opened"]
        inside ^= bool(s["parity"])
    return states, system


def _features(file: _File, start: int, size: int, inside: bool, depth: int, listed: bool) -> Iterator[str]:
    """Features that begin in a range, in order."""
    before = file.read(max(0, start - KEY), min(start, KEY))
    escaped = _escaped_start(file, start)
    raw = file.read(start, size)
    while True:
        data = np.frombuffer(raw, np.uint8)
        b = _brackets(data, _quotes(data, escaped), inside)
        b.depth = b.depth + depth
        objects, parents = _parents(b, 3)
        lists = {int(p) for p in np.unique(parents[parents >= 0]) if data[b.at[p]] == ord("[") and b.key(int(p), before) == LIST}
        keep = np.array([int(p) in lists if p >= 0 else listed for p in parents], bool) & (b.at[objects] < size)
        objects = objects[keep]
        ends = np.flatnonzero(~b.opens & (b.depth == 2))
        place = np.searchsorted(ends, objects)
        if not len(objects) or place[-1] < len(ends):
            break
        more = file.read(start + len(raw), max(min(MORE, max(LITTLE, size // 16)), len(raw) - size))
        if not more:
            raise ValueError("a collection ends within a feature")
        raw += more
    for k, end in zip(objects.tolist(), place.tolist()):
        yield raw[b.at[k] : b.at[ends[end]] + 1].decode("utf-8")


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files at a path, below its folders too, with their sizes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(conf)
    out = []
    for top in system.globStatus(root) or []:
        listed = system.listFiles(top.getPath(), True)
        while listed.hasNext():
            f = listed.next()
            if f.getPath().getName()[0] not in "._":
                out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def split_features(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """``file_name``, ``crs`` (the text of the collection's member), ``ord`` and ``feature`` of the collections at a path.

    Files must be in a system that ``pyarrow.fs`` opens by its address.
    """
    ranges = [(name, k, start, min(size, length - start)) for name, length in _files(spark, path) for k, start in enumerate(range(0, length, size))]
    if not ranges:
        raise FileNotFoundError(path)
    # small ranges share tasks
    whole = -(-sum(r[3] for r in ranges) // RANGE)
    number = min(len(ranges), max(whole, WAVES * spark.sparkContext.defaultParallelism))
    tasks = spark.createDataFrame(ranges, "path string, k int, start long, size long").repartition(number, "path", "k")

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [json.dumps(_summed(_File(r["path"]), r["start"], r["size"])) for r in rows]
            yield pa.RecordBatch.from_pydict({"path": [r["path"] for r in rows], "k": pa.array([r["k"] for r in rows], pa.int32()), "sums": found})

    summed: dict[str, dict[int, dict]] = {}
    for r in tasks.mapInArrow(sums, "path string, k int, sums string").collect():
        summed.setdefault(r["path"], {})[r["k"]] = json.loads(r["sums"])
    states = {name: _followed([s[k] for k in sorted(s)]) for name, s in summed.items()}
    known = [(*r, *states[r[0]][0][r[1]], states[r[0]][1]) for r in ranges]
    tasks = spark.createDataFrame(known, "path string, k int, start long, size long, inside boolean, depth int, listed boolean, number long, crs string")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                out: list[str] = []
                held, first = 0, r["number"]
                name = r["path"].rpartition("/")[2]

                def made(out: list[str], first: int) -> pa.RecordBatch:
                    n = len(out)
                    return pa.RecordBatch.from_pydict(
                        {"file_name": [name] * n, "crs": pa.array([r["crs"]] * n, pa.string()), "ord": pa.array(range(first, first + n), pa.int64()), "feature": out}
                    )

                for feature in _features(_File(r["path"]), r["start"], r["size"], r["inside"], r["depth"], r["listed"]):
                    out.append(feature)
                    held += len(feature)
                    if held > MORE:
                        yield made(out, first)
                        first, out, held = first + len(out), [], 0
                if out:
                    yield made(out, first)

    return tasks.repartition(number, "path", "k").mapInArrow(read, "file_name string, crs string, ord long, feature string")
