"""Session helpers: a local session for tests and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, app: str = "keystrata", **conf: str) -> SparkSession:
    """Session for tests and the bench. On a cluster the submitted session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KEYSTRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one the cluster names in ``spark.checkpoint.dir``.

    Written intermediates go there so that any executor can read them after another one is lost. Only a
    local session may do without the setting; it gets a temporary folder.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/keystrata/{name}-{uuid.uuid4().hex}"


#: Spark setting: shuffle files go at the end of the query that made them, not when the driver collects its garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark setting: bytes of an Arrow batch that goes to a Python worker. By default 64 MB, so that 10,000 rows of texts go at once.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder once and read from there.

    For rows that several branches of a plan use. Unlike a cache it outlives its executors, and its size is
    known when joins are planned. The shuffles that led to it are of no more use then and leave the disks. `released`
    removes the folder again.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    with _setting(spark, _SHUFFLE_CLEANUP, "true"):
        df.write.parquet(folder)
    rows = spark.read.schema(df.schema).parquet(folder)
    _folders[rows] = folder
    return rows


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on Python workers get texts in Arrow batches of at most this size, unless the session has a size of its own.

    A batch is held by the executor and by the worker, outside the heap, and what a worker once took it keeps for later stages.
    """
    if _BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(_BATCH_BYTES, size)


def released(*written_rows: DataFrame) -> None:
    """Remove what `written` wrote, once all that is made of it has been written itself."""
    for rows in written_rows:
        folder = _folders.pop(rows, None)
        if folder:
            path = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


_base: str | None = None


def _local_base() -> str:
    global _base
    if _base is None:
        _base = tempfile.mkdtemp(prefix="keystrata-")
    return _base
