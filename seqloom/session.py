"""Session settings and the shared scratch space for cut lineages."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "seqloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` wins over the defaults.

    Keyword names use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="2000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a split hot join key is worth one more exchange further down
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch() -> str:
    root = tempfile.mkdtemp(prefix="seqloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; there a temporary folder stands in, because
    driver and executors are one process.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one intermediate or streaming result."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/seqloom/{app}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system for ``path``, and the path as its object."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def committed(spark: SparkSession, pattern: str) -> list[str]:
    """Directories that match the pattern and that a finished write left, in order of their names."""
    fs, glob = _file_system(spark, f"{pattern}/_SUCCESS")
    return sorted(s.getPath().getParent().toString() for s in fs.globStatus(glob) or [])


def delete_path(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def release(spark: SparkSession) -> None:
    """Delete all scratch files of this application."""
    delete_path(spark, f"{scratch_root(spark)}/seqloom/{spark.sparkContext.applicationId}")


@contextlib.contextmanager
def known_source(spark: SparkSession, source: type[DataSource]) -> Iterator[None]:
    """Inside, a format of Python code can be named by readers and writers of ``spark``, its frames and streams.

    Spark registers a format in one session, but looks its name up in the thread's active one, which may be another session,
    left by a query before, or none in a thread of its own.
    """
    spark.dataSource.register(source)
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    before = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        yield
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())
        else:
            sessions.clearActiveSession()


@contextlib.contextmanager
def scratch_files(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch files that a job writes: they go when the job, which has to have written its results, is over."""
    held: list[str] = []
    _OWNERS.append(held)
    try:
        yield
    finally:
        _OWNERS.remove(held)
        for path in held:
            delete_path(spark, path)


_OWNERS: list[list[str]] = []


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where a frame with a non-repeatable partitioning is consumed more than once. The files outlive a lost
    executor and, unlike an RDD checkpoint, later readers still prune columns. Inside ``scratch_files`` they go at the end of
    the job, else with ``release``.
    """
    path = scratch_path(df.sparkSession, label)
    if _OWNERS:
        _OWNERS[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
