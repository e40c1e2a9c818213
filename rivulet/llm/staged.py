"""Staged tables that are deleted again.

An operator that writes intermediate tables under ``spark.checkpoint.dir``
drops those that its result does not read. What the result reads can only go
when the result itself has been written, which the caller knows: a stage of the
corpus pipeline drops what the one before it staged, if its own input is newer.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rivulet.session import scratch_path

_state = threading.local()


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as a Parquet table in the shared folder and read back,
    and the table's path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    for paths in getattr(_state, "open", []):
        paths.append(path)
    return spark.read.parquet(path), path


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Deletes staged tables (one that has gone already is no error)."""
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        for noted_paths in getattr(_state, "open", []):
            noted_paths[:] = [x for x in noted_paths if x != path]


def written_after(docs: DataFrame, paths: list[str]) -> list[str]:
    """Those staged tables of ``paths`` that ``docs`` does not read and that
    are older than the files it reads."""
    files = docs.inputFiles()
    if not files:
        return []
    spark = docs.sparkSession
    conf, to_path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path

    def written(path: str) -> int:
        p = to_path(path)
        fs = p.getFileSystem(conf)
        return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else 0

    def plain(path: str) -> str:
        return to_path(path).toUri().getPath()

    names, newest = {plain(f) for f in files}, written(files[0])
    return [p for p in paths if not any(n.startswith(plain(p) + "/") for n in names) and written(p) < newest]


@contextmanager
def noted():
    """The list of the paths that this thread stages inside."""
    if not hasattr(_state, "open"):
        _state.open = []
    paths: list[str] = []
    _state.open.append(paths)
    try:
        yield paths
    finally:
        _state.open = [x for x in _state.open if x is not paths]
