"""What the operators share: bounded batches of texts, scratch tables, the text rules."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import recflow.llm

# Executors get the functions of this package with the task and need no copy of it.
cloudpickle.register_pickle_by_value(recflow.llm)

# Text a task works on at a time; one longer text is a batch of its own.
BATCH_BYTES = 4 << 20
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as the Python worker and is shared by the tasks it runs.

    Functions are sent by value, so their module's own variables are new for every task.
    """
    holder = sys.modules.setdefault("recflow_worker", types.ModuleType("recflow_worker"))
    return vars(holder).setdefault(name, {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other letters unchanged; null as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select("doc_id", *more, F.coalesce("text", F.lit("")).alias("text"))


def quoted(name: str) -> str:
    """A column name that may hold dots and backticks, as SQL takes it."""
    return "`" + name.replace("`", "``") + "`"


def others(df: DataFrame, *names: str) -> list[str]:
    """The quoted columns but those called as one of the names, in any case."""
    return [quoted(c) for c in df.columns if c.lower() not in names]


def apart(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """The frame with its own columns called as one of the names, in any case, renamed; the new name of each."""
    taken, moved = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.lower() in names:
            new = f"_own_{c}"
            while new.lower() in taken:
                new = "_" + new
            taken.add(new.lower())
            moved[c] = new
    return df.withColumnsRenamed(moved), moved


def put_back(df: DataFrame, columns: list[str], moved: dict[str, str]) -> DataFrame:
    """The columns under the names they had before ``apart``."""
    return df.select(*[F.col(quoted(moved.get(c, c))).alias(c) for c in columns])


def parts(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of one column at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        step = np.cumsum(size, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8."""
    kind = pa.large_binary() if batch.column(column).type == pa.large_string() else pa.binary()
    return batch.column(column).cast(kind).to_pylist()


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x.decode("utf-8", "replace") for x in raw(batch, column)]


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """An array column from all values in a row and the length of each list."""
    ends = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def keyed(batch: pa.RecordBatch, drop: str = "text") -> dict[str, pa.Array]:
    """The other columns of a batch, to be returned along with new ones."""
    return {n: batch.column(n) for n in batch.schema.names if n != drop}


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` over batches of bounded size.

    By default Spark bounds their rows alone, which for very long texts is no bound. The session's limit of
    bytes is set here unless it has one. Names with dots or backticks, which ``mapInArrow`` does not take, are
    replaced on the way.
    """
    spark = df.sparkSession
    if spark.conf.get(ARROW_LIMIT, None) is None:
        spark.conf.set(ARROW_LIMIT, f"{2 * BATCH_BYTES}b")
    odd = {c: f"_odd{k}_" for k, c in enumerate(df.columns) if "." in c or "`" in c}
    if not odd:
        return df.mapInArrow(work, schema)
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = StructType([StructField(odd.get(f.name, f.name), f.dataType) for f in fields])
    back = {new: c for c, new in odd.items() if new in plain.names}
    return df.withColumnsRenamed(odd).mapInArrow(work, plain).withColumnsRenamed(back)


def per_batch(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], added: str
) -> DataFrame:
    """``mapInArrow`` that returns all columns but ``text``, then those of ``added``."""
    kept = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema if f.name != "text")
    return map_batches(df, work, f"{kept}, {added}" if kept else added)
