"""Which of several written versions of a folder counts.

A version is written to a fresh folder ``run=<id>`` beside the others. Only when it is complete, an empty file
``_published/<number>.<id>`` names it, and readers follow the highest number. A write that fails leaves nothing that
is read, and a frame may read the version that it replaces.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

MARKS = "_published"


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if there is none."""
    files, folder = _files(spark, path)
    if not files.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(folder))


def published(spark: SparkSession, path: str) -> list[str]:
    """The ids of the versions published so far, the one that counts last."""
    return [name.partition(".")[2] for name in names(spark, f"{path}/{MARKS}")]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts."""
    runs = published(spark, path)
    return f"{path}/run={runs[-1]}" if runs else None


def write_version(df: DataFrame, path: str) -> None:
    """Write a version and publish it. The one before stays for those who still read it, older ones go."""
    spark = df.sparkSession
    run = uuid.uuid4().hex
    df.write.parquet(f"{path}/run={run}")
    earlier = names(spark, f"{path}/{MARKS}")
    number = int(earlier[-1].partition(".")[0]) + 1 if earlier else 1
    files, mark = _files(spark, f"{path}/{MARKS}/{number:08d}.{run}")
    files.create(mark, False).close()
    for name in earlier[:-1]:
        for old in (f"{path}/run={name.partition('.')[2]}", f"{path}/{MARKS}/{name}"):
            files.delete(_files(spark, old)[1], True)
