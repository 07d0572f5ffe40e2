"""Session-level helpers: frames written once, checked broadcasts, functions for the executors."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What each session wrote below the shared folder.
_WRITTEN: WeakKeyDictionary[SparkSession, list[str]] = WeakKeyDictionary()

# Whether Spark deletes what an action shuffled as soon as it is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` or ``setCheckpointDir`` names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding a folder already chosen."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted with the other scratch frames of the session."""
    path = f"{shared_folder(spark).rstrip('/')}/recflow-{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Later stages then start from the files, so a lost executor repeats no more than its own tasks,
    and a frame with several consumers is computed once. What was shuffled for it is deleted once it is written.
    """
    return materialize_at(df, name)[0]


def materialize_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialize`` with the path written, for ``drop_paths``."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete some of what this session wrote, once nothing reads it any more."""
    written = _WRITTEN.get(spark, [])
    for name in paths:
        written.remove(name)
        _delete(spark, name)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_materialized(spark: SparkSession, keep: int = 0) -> None:
    """Delete what this session wrote, but for the first ``keep`` paths.

    Frames built on the deleted ones can no longer be read.
    """
    written = _WRITTEN.get(spark, [])
    while len(written) > keep:
        _delete(spark, written.pop())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was written inside."""
    before = len(_WRITTEN.get(spark, []))
    try:
        yield
    finally:
        drop_materialized(spark, before)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when a count shows at most ``max_rows``; else the frame as it is.

    Costs one bounded count, so use it on frames that are cheap to evaluate.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def ship_functions(module_name: str) -> None:
    """Send the Python functions of a module along with the tasks that use them.

    Executors then need no copy of this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
