"""Intermediates as tables in the cluster's shared folder.

A mart reads its first-attempt rows several times, each time other columns. Written once as Parquet they are computed
once, the later plans are short, column pruning works, and a lost executor costs a re-read instead of the whole chain.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
AT_ONCE = 6

_lock, _writing, _held = threading.RLock(), {}, []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the session's spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is named a temporary folder is set, but only under a local master, where all tasks share the machine.
    """
    base = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="quizlens-")
        spark.conf.set(SHARED_DIR, base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, removed by the file system client when the application ends."""
    path = f"{shared_dir(spark)}/quizlens/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(jpath)
    return path


def stage(df: DataFrame, name: str = "stage", compression: str | None = None, keep: bool = False) -> DataFrame:
    """Writes df to the shared folder and returns a DataFrame that reads it. `compression` is the session's where none is named. With `keep` the table
    outlives the run that it is staged in (see temporary)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _held and not keep:
        _held[-1].append(path)
    with freed_shuffles(spark):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end, instead of whenever the driver's memory is next cleaned. Nothing reads these files again:
    a write is planned for itself. The session's own setting is put back after the last of several writes at once."""
    key = id(spark._jsparkSession)
    with _lock:
        n, before = _writing.get(key, (0, None))
        if not n:
            before = spark.conf.get(FREED, None)
            spark.conf.set(FREED, "true")
        _writing[key] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _writing[key]
            _writing[key] = n - 1, before
            if n == 1:
                del _writing[key]
                if before is None:
                    spark.conf.unset(FREED)
                else:
                    spark.conf.set(FREED, before)


def remove(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(jpath, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end: for runs that write all their results inside. Runs of one process must not overlap."""
    _held.append([])
    try:
        yield
    finally:
        for path in _held.pop():
            remove(spark, path)


def at_once(spark: SparkSession, jobs: Sequence[Callable]) -> list:
    """Results of independent small jobs, in their order; their tasks share the cluster."""
    with ThreadPoolExecutor(min(AT_ONCE, max(1, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]

