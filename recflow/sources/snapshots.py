"""Daily snapshots: read a source table, stamp it with its date, read it back by date."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recflow import manifest


def jdbc_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table, read in ``partitions`` ranges of ``partition_column``.

    ``bounds`` only place the range limits; rows outside them are still read. ``options`` carry the
    caller's url and credentials.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def snapshot(
    source: DataFrame, schema: str | T.StructType, run_date: str, drop: Iterable[str] = ()
) -> DataFrame:
    """The source cast to ``schema`` plus its ``date``; a column the source lacks is null.

    Columns outside the schema (a password, say) and those in ``drop`` never leave the source.
    """
    dropped = set(drop)
    columns = [
        (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in _struct(schema).fields
        if f.name not in dropped
    ]
    return source.select(*columns, F.lit(run_date).alias("date"))


def read_snapshot(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """One day of a stored snapshot; only its folder is scanned. A day never stored has no rows."""
    days = stored_days(spark, path)
    if run_date in days:
        return _days(spark, path, [run_date])
    return _days(spark, path, days[:1]).where(F.lit(False))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table without days as last stored."""
    return spark.read.parquet(manifest.current(spark, path.rstrip("/")) or path)


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """The days of a stored snapshot, from the names of its folders; no file is opened."""
    path = path.rstrip("/")
    days = [n for n in manifest.names(spark, path) if n.startswith("date=")]
    return [d.removeprefix("date=") for d in days if manifest.current(spark, f"{path}/{d}")]


def read_or_empty(
    spark: SparkSession, path: str, schema: str | T.StructType, run_date: str | None = None
) -> DataFrame:
    """A stored table, or no rows of ``schema`` when nothing was stored yet."""
    days = stored_days(spark, path)
    if not days:
        fields = [*_struct(schema).fields, T.StructField("date", T.StringType())]
        return spark.createDataFrame([], T.StructType(fields))
    return _days(spark, path, days) if run_date is None else read_snapshot(spark, path, run_date)


def _days(spark: SparkSession, path: str, days: list[str]) -> DataFrame:
    """Some days, each from the folder that counts now."""
    path = path.rstrip("/")
    folders = [manifest.current(spark, f"{path}/date={day}") for day in days]
    stored = spark.read.option("basePath", path).parquet(*(folders or [path])).drop("run")
    # the date folder name may be read back as a date
    return stored.withColumn("date", F.col("date").cast("string"))
