"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "geosync", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a fixed time zone; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # A checkpoint goes when nothing refers to it any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder on this machine, one for an application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="geosync-")
    return _LOCAL[application]


#: Spark's setting by which a query's shuffle files go when it ends, and not when the driver happens to collect its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside are removed at each one's end. What they gave must be written by then."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so that later passes read it back unchanged."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What ``stage`` writes inside belongs to this block, in this thread, and is removed at its end.

    Results that read staged tables must be written before; an inner block removes its own tables only.
    """
    own: list[str] = []
    token = _STAGED.set(own)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for folder in own:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder of the shared folder and read back, so that later passes read few columns.

    Inside ``staging`` the folder is removed at the end of the block, else it is the caller's to remove.
    """
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    own = _STAGED.get()
    if own is not None:
        own.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores when its input comes in fewer pieces, as one small file does.

    A large input has more pieces than cores and passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
