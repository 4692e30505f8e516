"""Tables written once to the shared folder, and objects kept once per Python worker."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from geosync.session import shared_folder, shuffles_go

#: Rows of an Arrow batch that holds texts.
TEXT_ROWS = 500


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder of the shared folder and read back.

    Later passes read the rows instead of computing them again, and a lost executor costs no more than a read. The
    shuffle files of the query that made them go at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_go(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the folder of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def per_worker(key: object, make: Callable[[], object]) -> object:
    """``make()`` once per Python worker process; the worker's later tasks get the same object."""
    name = "_geosync_llm_worker"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})
    if key not in store:
        store[key] = make()
    return store[key]


def tidy(run: Callable) -> Callable:
    """``run`` over a partition's batches; afterwards the worker gives freed memory back, as the next task may be another's."""

    def whole(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in the GNU C library
        if trim is not None:
            trim(0)

    return whole


def few_rows(spark: SparkSession) -> None:
    """Arrow batches of few rows from now on, in the whole session, as a batch of the usual 10,000 may hold long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, to be handled in batches of few rows."""
    few_rows(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def carried(docs: DataFrame, id_column: str, text_column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Id and text, and the columns to carry along, under names that can't clash; the text is there once. Sets ``few_rows``."""
    few_rows(docs.sparkSession)
    return docs.select(
        docs[id_column].cast("long").alias("_id"),
        docs[text_column].cast("string").alias("_text"),
        *(docs[c].alias(f"_keep_{c}") for c in keep if c != text_column),
    )


def carried_arrays(keep: tuple[str, ...], text_column: str, text: pa.Array, others: list[pa.Array]) -> list[pa.Array]:
    """The arrays of ``keep`` in a batch of what ``carried`` gave: the text, and the others in their order."""
    rest = iter(others)
    return [text if c == text_column else next(rest) for c in keep]
