"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint gets a vector of radius + 1 bits, none zero. For every vector v but zero, a table
keeps the bits whose vector has an odd product with v. Two fingerprints that differ in at most ``radius``
bits have a v that is orthogonal to all of those bits' vectors, so they agree on the whole key of that
table: no pair within the radius is missed.

Documents of one fingerprint are one node. A bucket of few fingerprints is compared in place. In a bucket
of many, each fingerprint is sent to the points within half the radius that the bucket allows; two that
share a point are within the radius, and any two within the radius share one, so linking the holders of a
point is exact and needs no pairs. A point has a bounded number of holders.

Null and empty texts have fingerprint zero and are linked like any other. Documents without an id are
clustered too; a cluster of those alone has a null ``component_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from recflow.llm.common import apart, keyed, others, parts, per_batch, put_back, raw
from recflow.llm.components import components
from recflow.operators.joins import lookup
from recflow.session import materialize

BITS = 64
SEED = 42
# Fingerprints of a bucket that are compared in place.
BUCKET = 48
# Shingles counted at a time, so that a very long text needs no more memory.
STEP = 1 << 18
LAST = (1 << 63) - 1


def fingerprint(text: bytes, words: int) -> int:
    """The SimHash of the word shingles of a text, as a signed 64-bit number."""
    found = text.lower().split()
    if not found:
        return 0
    grams = [found[i:] for i in range(min(words, len(found)))] if len(found) >= words else [[b" ".join(found)]]
    n = len(grams[-1])
    ones = np.zeros(BITS, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, STEP):
        some = [g[at : min(at + STEP, n)] for g in grams]
        hashes = np.array([digest(join(t), SEED) for t in zip(*some)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, words: int = 3, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` and ``fp``; the text only if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            values = pa.array([fingerprint(t or b"", words) for t in raw(batch)], pa.int64())
            columns = keyed(batch) | {"fp": values}
            yield pa.RecordBatch.from_pydict(columns | {"text": batch.column("text")} if keep_text else columns)

    return per_batch(docs.select(*others(docs, "text", "fp"), "text"), run, "fp bigint" + ", text string" * keep_text)


def masks(radius: int) -> list[int]:
    """The bit masks of the tables, one for each vector but zero."""
    vectors = (1 << (radius + 1)) - 1
    vector = [1 + i % vectors for i in range(BITS)]
    return [
        sum(1 << i for i in range(BITS) if (vector[i] & v).bit_count() % 2) for v in range(1, vectors + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints ``fp`` within the radius of each other."""
    if radius % 2:
        raise ValueError("the radius must be even")
    tables = masks(radius)
    fp = F.col("fp")
    keys = [F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(tables)]
    keyed = distinct.select("fp", F.inline(F.array(*keys)))
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shared = materialize(lookup(keyed, sizes, ["t", "key"]), "buckets")

    few = shared.where(F.col("n") <= BUCKET).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    partners = lambda a: F.filter("fps", lambda b: (b > a) & _near(a, b, radius))
    stars = F.transform("fps", lambda a: F.struct(a.alias("v"), partners(a).alias("others")))
    compared = few.select(F.inline(stars)).select(F.explode("others").alias("u"), "v")

    # what the points of a table can differ in: the bits outside its mask
    flips = [
        [
            _signed(sum(1 << i for i in some))
            for size in range(radius // 2 + 1)
            for some in combinations([i for i in range(BITS) if not m >> i & 1], size)
        ]
        for m in tables
    ]
    by_table = F.array(*[F.array(*[F.lit(x) for x in xs]) for xs in flips])
    points = F.transform(F.get(by_table, F.col("t")), lambda x: x.bitwiseXOR(fp))
    spread = shared.where(F.col("n") > BUCKET).select("t", "fp", F.explode(points).alias("point"))
    # a point has no more holders than points within half the radius
    held = spread.groupBy("t", "point").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    starred = held.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where(F.col("u") != F.col("v"))
    return compared.union(starred)


def _clusters(distinct: DataFrame, radius: int) -> DataFrame:
    """The table of one row per ``fp`` with ``root``, the same for all that links connect."""
    roots = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over fingerprints within the radius."""
    rows = materialize(fingerprints(docs.select("doc_id", "text"), words), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    linked = _clusters(distinct, radius)
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = lookup(linked.select("fp", "root"), least, ["root"]).select("fp", "component_id")
    return lookup(rows, named, ["fp"]).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` but one for each group of near duplicates: that of the smallest doc_id.

    Of several rows with that id, and of a group without ids, any one row stays.
    """
    row = F.monotonically_increasing_id().alias("_row")
    own, moved = apart(docs, "fp", "_row", "_place", "_hash")
    rows = materialize(fingerprints(own, words, keep_text=True).select("*", row), "fingerprinted")
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    else:
        place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    best = [F.min("_place").alias("_place"), F.min_by("_row", "_place").alias("_row")]
    distinct = rows.withColumn("_place", place).groupBy("fp").agg(*best)
    linked = _clusters(materialize(distinct, "distinct"), radius)
    stay = materialize(linked.groupBy("root").agg(*best).select("_row"), "kept-rows")
    kept = lookup(rows, stay, ["_row"], "left_semi").drop("fp", "_row")
    return put_back(kept, docs.columns, moved)


def hexadecimal(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
