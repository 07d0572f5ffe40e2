"""Factorization by alternating least squares in which no user or item has to fit in one task.

Each half step joins the cells with the fixed side, sums the products of their factors per row of the other
side, and solves one small system per row. A row of many cells is summed where its cells lie, so that only
its sums are shuffled: in a part for each core at most. ``factorize_split`` stores the cells of a row together and
sends factors to them where these are few, so that a row has about one part however many partitions there are;
a part's sums are larger than the few cells of the row that a partition has otherwise. A row of few cells has its
cells shuffled, as they are smaller than the sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.operators.cf import ITERATIONS, RANK, Factors
from recflow.operators.joins import lookup
from recflow.session import drop_paths, materialize_at, ship_functions

# A row with more cells than this is summed in parts; its sums are then far smaller than its cells.
HOT_CELLS = 4096
# Cells of a row that are stored in one place.
PLACE_CELLS = 4096
# Factors of up to so many users or items are sent to the cells.
MAX_BROADCAST_FACTORS = 100_000
REGULARIZATION = 0.1

ship_functions(__name__)


def _start(ids: DataFrame, key: str, rank: int, seed: int) -> DataFrame:
    """(key, features): a direction per id drawn from its hash, so the same in any layout of the data."""

    def uniform(i: Column, salt: int) -> Column:
        drawn = F.xxhash64(key, i, F.lit(seed), F.lit(salt)).bitwiseAND((1 << 53) - 1)
        return (drawn + 0.5) / float(1 << 53)

    def normal(i: Column) -> Column:
        return F.sqrt(-2 * F.log(uniform(i, 1))) * F.cos(2 * np.pi * uniform(i, 2))

    drawn = ids.select(key, F.transform(F.sequence(F.lit(0), F.lit(rank - 1)), normal).alias("features"))
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x * x))
    return drawn.select(key, F.transform("features", lambda x: x / length).alias("features"))


def _pairs(rank: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(rank) for j in range(i + 1)]


def _products(rank: int, weight: str = "1") -> list[str]:
    """The lower half of the summed products of ``features`` with themselves."""
    return [f"sum({weight} * features[{i}] * features[{j}])" for i, j in _pairs(rank)]


def _sums(met: DataFrame, key: str, rank: int, implicit: bool) -> DataFrame:
    """(key, n, gram, right): what the system of each row is made of.

    The sums are SQL text: as Column objects, building the plan took longer than running it.
    """
    number = "count_if(val > 0)" if implicit else "count(*)"
    wish = "if(val > 0, 1 + val, 0D)" if implicit else "val"
    gram = ", ".join(_products(rank, "abs(val)" if implicit else "1"))
    right = ", ".join(f"sum({wish} * features[{i}])" for i in range(rank))
    return met.groupBy(key).agg(
        F.expr(number).alias("n"), F.expr(f"array({gram})").alias("gram"), F.expr(f"array({right})").alias("right")
    )


def _solved(sums: DataFrame, key: str, rank: int, reg: float, common: np.ndarray) -> DataFrame:
    """(key, features): the solution of each row's system, ``common`` added to its matrix."""
    low = np.tril_indices(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n = batch.column("n").to_numpy().astype(float)
            system = np.zeros((rows, rank, rank))
            system[:, low[0], low[1]] = batch.column("gram").flatten().to_numpy().reshape(rows, -1)
            system[:, low[1], low[0]] = system[:, low[0], low[1]]
            # a row without liked cells has no weight of its own to hold it
            system += common + reg * np.maximum(n, 1.0)[:, None, None] * np.eye(rank)
            right = batch.column("right").flatten().to_numpy().reshape(rows, rank, 1)
            found = np.linalg.solve(system, right).reshape(-1)
            ends = pa.array(np.arange(0, rows * rank + 1, rank, dtype=np.int32))
            features = pa.ListArray.from_arrays(ends, pa.array(found))
            yield pa.RecordBatch.from_arrays([batch.column(key), features], names=[key, "features"])

    kind = sums.schema[key].dataType.simpleString()
    return sums.mapInArrow(run, f"`{key}` {kind}, features array<double>")


def half_step(
    cells: DataFrame,
    fixed: DataFrame,
    key: str,
    other: str,
    rank: int,
    reg: float = REGULARIZATION,
    implicit: bool = False,
) -> DataFrame:
    """(key, features): the least squares of every ``key`` of ``cells`` (key, other, val, ``_hot_<key>``)
    for the ``fixed`` factors of ``other``."""
    met = lookup(cells, fixed, [other])
    hot = F.col(f"_hot_{key}")
    few = _sums(met.where(~hot).repartition(key), key, rank, implicit)
    cores = cells.sparkSession.sparkContext.defaultParallelism
    many = _sums(met.where(hot).coalesce(cores), key, rank, implicit)
    common = np.zeros((rank, rank))
    if implicit:
        for (i, j), total in zip(_pairs(rank), fixed.selectExpr(*_products(rank)).first()):
            common[i, j] = common[j, i] = total or 0.0
    return _solved(few.unionByName(many), key, rank, reg, common)


def _laid_out(cells: DataFrame, key: str, other: str, hot_cells: int) -> tuple[DataFrame, str]:
    """(``cells`` with ``_hot_<key>``, stored with those of a row of ``key`` together, and their path).

    A row of more than ``PLACE_CELLS`` cells has several places. What reads the cells where they lie then sums
    a hot row in few parts, however many partitions there are.
    """
    sizes = cells.groupBy(key).agg(F.count("*").alias("_n"))
    place = F.pmod(F.xxhash64(other), F.ceil(F.col("_n") / PLACE_CELLS))
    found = lookup(cells, sizes, [key]).withColumn(f"_hot_{key}", F.col("_n") > hot_cells)
    return materialize_at(found.repartition(key, place).drop("_n"), "marked")


def factorize_split(
    matrix: DataFrame,
    rank: int = RANK,
    max_iter: int = ITERATIONS,
    reg: float = REGULARIZATION,
    seed: int = 42,
    implicit: bool = False,
    hot_cells: int = HOT_CELLS,
) -> Factors:
    """The factorization of ``cf.factorize`` for tables whose hot users or items exceed a task.

    ``matrix`` is (user_id, item_id, val) with ids of any type; cells that are 0, null or NaN or lack an id
    are left out, and several cells of a pair each count. As in Spark's ALS, the weight of the penalty is
    ``reg`` times the number of cells of a row, and ``implicit`` takes values as confidence. The start follows
    the ids and ``seed`` alone. Every half step is written to the shared folder; the one before is then deleted.
    """
    spark = matrix.sparkSession
    cells = matrix.select("user_id", "item_id", F.col("val").cast("double").alias("val"))
    cells = cells.where("val <> 0 and not isnan(val)").dropna(subset=["user_id", "item_id"])
    cells, stored = materialize_at(cells, "cells")
    by_user, by_item = (_laid_out(cells, *keys, hot_cells) for keys in (("user_id", "item_id"), ("item_id", "user_id")))
    drop_paths(spark, [stored])
    users, last = materialize_at(_start(by_user[0].select("user_id").distinct(), "user_id", rank, seed), "start")
    few_users = users.count() <= MAX_BROADCAST_FACTORS
    items, items_at, few_items = None, None, None
    for _ in range(max_iter):
        sent = F.broadcast(users) if few_users else users
        new, at = materialize_at(half_step(by_item[0], sent, "item_id", "user_id", rank, reg, implicit), "items")
        drop_paths(spark, [items_at] if items_at else [])
        items, items_at = new, at
        if few_items is None:
            few_items = items.count() <= MAX_BROADCAST_FACTORS
        sent = F.broadcast(items) if few_items else items
        new, at = materialize_at(half_step(by_user[0], sent, "user_id", "item_id", rank, reg, implicit), "users")
        drop_paths(spark, [last])
        users, last = new, at
    drop_paths(spark, [by_user[1], by_item[1]])
    return Factors(users, items, rank)
