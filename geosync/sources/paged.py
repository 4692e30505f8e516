"""Paged feature services as a Spark data source, and pages stored as files."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from geosync.functions.jsonx import unwrap_envelope

# Rows per page, first row number a service accepts, answers worth a retry, tries.
PAGE_SIZE = 500
FIRST_ROW = 1
RETRY_STATUS = (429, 500, 502, 503, 504)
RETRIES = 5

# Where a page holds its elements.
LISTS = ("features", "data", "Items")
#: Tasks that the whole pages of a batch are dealt to, at most.
SPANS = 256

SCHEMA = "page bigint, body string"


class _Stripe(InputPartition):
    """Pages ``first``, ``first + step``, … of one source."""

    def __init__(self, first: int, step: int):
        self.first = first
        self.step = step


def _size(body: str) -> int:
    """How many elements ``unwrap_envelope`` will find in a page."""
    page = json.loads(body)
    lists = [page] if isinstance(page, list) else [page.get(name) for name in LISTS] if isinstance(page, dict) else []
    return next((len(x) for x in lists if isinstance(x, list)), 0)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.page_size = int(options.get("pagesize", PAGE_SIZE))
        self.start = int(options.get("start", FIRST_ROW))
        self.stripes = int(options.get("stripes", 8))

    def partitions(self) -> list[InputPartition]:
        return [_Stripe(n, self.stripes) for n in range(self.stripes)]

    def read(self, partition: _Stripe) -> Iterator[tuple]:
        # A stripe ends at its first short page, so pages that other stripes hold are still read,
        # and a page that cannot be had fails the task instead of going missing.
        page = partition.first
        while True:
            body = self._load(page)
            yield page, body
            if _size(body) < self.page_size:
                return
            page += partition.step

    def _load(self, page: int) -> str:
        query = urllib.parse.urlencode({"$skip": self.start + page * self.page_size, "$top": self.page_size})
        url = f"{self.path}{'&' if '?' in self.path else '?'}{query}"
        for attempt in range(RETRIES):
            try:
                with urllib.request.urlopen(url, timeout=120) as answer:
                    return answer.read().decode("utf-8")
            except urllib.error.HTTPError as error:
                if error.code not in RETRY_STATUS or attempt == RETRIES - 1:
                    raise
            except (urllib.error.URLError, OSError):  # no connection, or lost while reading
                if attempt == RETRIES - 1:
                    raise
            time.sleep(1.5 * 2**attempt)
        raise RuntimeError(f"no answer for page {page}")


class PagedFeatures(DataSource):
    """Pages of the service at ``path`` as text; ``stripes`` sets the parallel readers."""

    @classmethod
    def name(cls) -> str:
        return "paged_features"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Span(InputPartition):
    """Rows ``first`` up to ``last`` (None: all) of a page, and all of the pages that follow, ``pages`` with it."""

    def __init__(self, page: int, first: int, last: int | None, pages: int = 1):
        self.page, self.first, self.last, self.pages = page, first, last, pages


class _Pages:
    """Stored pages: a folder ``page=<n>`` each, in any number of files, that do not change once they are there."""

    def __init__(self, path: str):
        self.files, self.path = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))

    def _listed(self, path: str) -> list[fs.FileInfo]:
        return self.files.get_file_info(fs.FileSelector(path, allow_not_found=True))

    def end(self, page: int) -> tuple[int, int]:
        """The first page from ``page`` on that is not there yet."""
        there = {f.base_name for f in self._listed(self.path) if f.type == fs.FileType.Directory}
        while f"page={page}" in there:
            page += 1
        return page, 0

    def bodies(self, page: int) -> Iterator[str]:
        for f in sorted(self._listed(f"{self.path}/page={page}"), key=lambda f: f.base_name):
            if f.type == fs.FileType.File and f.base_name[0] not in "._":
                yield self.files.open_input_stream(f.path).read().decode("utf-8")


class _Service:
    """Pages of a service: all are full but the last, which may still grow."""

    def __init__(self, reader: _Reader):
        self.reader = reader

    def _rows(self, page: int) -> int:
        return _size(self.reader._load(page))

    def end(self, page: int) -> tuple[int, int]:
        """The first page from ``page`` on that is not full, and its rows: by doubled steps, then by halves."""
        step, low = 1, page
        rows = self._rows(page)
        if rows < self.reader.page_size:
            return page, rows
        while self._rows(low + step) >= self.reader.page_size:
            low += step
            step *= 2
        high = low + step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self._rows(middle) >= self.reader.page_size else (low, middle)
        return high, self._rows(high)

    def bodies(self, page: int) -> Iterator[str]:
        yield self.reader._load(page)


class _StreamReader(DataSourceStreamReader):
    """Offsets are a page and the rows of it that were read; all pages before are done."""

    def __init__(self, options: dict):
        path = options["path"]
        self.source = _Service(_Reader(options)) if path.startswith(("http://", "https://")) else _Pages(path)
        self.known = 0

    def initialOffset(self) -> dict:
        return {"page": 0, "row": 0}

    def latestOffset(self) -> dict:
        page, row = self.source.end(self.known)
        self.known = page
        return {"page": page, "row": row}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.known = max(self.known, start["page"])
        per = max(1, -(-(end["page"] - start["page"]) // SPANS))
        spans = [
            _Span(p, start["row"] if p == start["page"] else 0, None, min(per, end["page"] - p)) for p in range(start["page"], end["page"], per)
        ]
        first = start["row"] if start["page"] == end["page"] else 0
        return [*spans, *([_Span(end["page"], first, end["row"])] if end["row"] > first else [])]

    def read(self, partition: _Span) -> Iterator[tuple]:
        for page in range(partition.page, partition.page + partition.pages):
            first, before = partition.first if page == partition.page else 0, 0
            for body in self.source.bodies(page):
                size = _size(body)
                last = before + size if partition.last is None else partition.last
                if before < last and before + size > first:
                    yield page, before, first, last, body
                before += size

    def commit(self, end: dict) -> None:
        """Pages stay where they are, so there is nothing to let go."""


class PagedFeatureStream(DataSource):
    """Pages as a stream: the rows ``first`` up to ``last`` of each page are new; ``before`` stand in its other files."""

    @classmethod
    def name(cls) -> str:
        return "paged_feature_stream"

    def schema(self) -> str:
        return "page bigint, before int, first int, last int, body string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def paged_feature_stream(spark: SparkSession, path: str, page_size: int = PAGE_SIZE, start: int = FIRST_ROW) -> DataFrame:
    """``page``, ``idx`` and ``feature`` of a service or of stored pages, as they arrive. Batches are read again alike."""
    spark.dataSource.register(PagedFeatureStream)
    pages = spark.readStream.format("paged_feature_stream").options(path=path, pagesize=page_size, start=start).load()
    listed = pages.select("page", "before", "first", "last", F.posexplode(unwrap_envelope(F.col("body"))).alias("_at", "feature"))
    idx = F.col("before") + F.col("_at")
    return listed.filter((idx >= F.col("first")) & (idx < F.col("last"))).select("page", idx.alias("idx"), "feature")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """Features of pages stored below ``page=<n>``, each in any number of files, in any folder that Spark can read."""
    pages = spark.read.text(path, wholetext=True)
    if "page" not in pages.columns or pages.filter("page = 0").isEmpty():
        raise FileNotFoundError(f"{path} has no page 0")
    listed = pages.select(
        F.col("page").cast("long").alias("page"), F.input_file_name().alias("_file"), F.posexplode(unwrap_envelope(F.col("value"))).alias("_at", "feature")
    )
    # A window over one page, which the service bounds.
    place = F.row_number().over(Window.partitionBy("page").orderBy("_file", "_at")) - 1
    return listed.select("page", place.cast("int").alias("idx"), "feature")


def paged_features(spark: SparkSession, path: str, page_size: int = PAGE_SIZE, start: int = FIRST_ROW,
                   stripes: int = 8) -> DataFrame:
    """Every feature of a paged service or of stored pages: ``page``, ``idx`` within the page, ``feature`` as JSON text."""
    if not path.startswith(("http://", "https://")):
        return _stored(spark, path)
    spark.dataSource.register(PagedFeatures)
    pages = (
        spark.read.format("paged_features")
        .options(path=path, pagesize=page_size, start=start, stripes=stripes)
        .load()
    )
    return pages.select("page", F.posexplode(unwrap_envelope(F.col("body"))).alias("idx", "feature"))
