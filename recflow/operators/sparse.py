"""Exact nearest rows of a sparse matrix by cosine, without a row per pair of the matrix.

Items are alike by the users who acted on both. Users are ordered from the one with fewest items. First the
users of few items give each item a floor: what its k-th neighbour reaches at least. An item can then
leave out its most popular users, as long as their part of its unit vector is shorter than the floor:
another item that shares those users alone cannot be among the best k. Only the other users, the
prefix, look up their items, and the pairs found are dropped unless what the prefix gave and the length
of the rest can reach the floor. What is left is scored in full.

Where columns are few and each has very many rows, floors are low and the prefixes meet most other rows. Their
number is known before they are met; when products of blocks of rows cost less, the same lists come from these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.operators.blocks import as_neighbours, best_matches, cheaper, packed_cells
from recflow.operators.joins import lookup
from recflow.operators.ranking import top_list_rows
from recflow.operators.similarity import pair_cosine
from recflow.session import materialize

# Users of at most so many items set the floors; an item meets so many others for each of them at most.
FEW = 64
# Bounds are taken this much wider, so that rounding drops no tie.
SLACK = 1e-9


def unit_cells(matrix: DataFrame, entity: str, across: str) -> DataFrame:
    """(id, dim, x, n): cells of rows of length one, and how many rows have the column."""
    cells = matrix.select(
        F.col(entity).alias("id"), F.col(across).alias("dim"), F.col("val").cast("double").alias("val")
    )
    cells = materialize(cells, "cells")
    norms = cells.groupBy("id").agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias("norm"))
    counts = cells.groupBy("dim").agg(F.count("*").alias("n"))
    met = lookup(lookup(cells, norms, ["id"]), counts, ["dim"])
    return met.select("id", "dim", (F.col("val") / F.col("norm")).alias("x"), "n")


def _products(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, other_id, part): products of the cells of ``left`` with those of other rows of ``right``."""
    other = right.select(F.col("id").alias("other_id"), "dim", F.col("x").alias("_y"))
    return (
        lookup(left, other, ["dim"])
        .where(F.col("id") != F.col("other_id"))
        .groupBy("id", "other_id")
        .agg(F.sum(F.col("x") * F.col("_y")).alias("part"))
    )


def floors(cells: DataFrame, k: int, few: int = FEW) -> DataFrame:
    """(id, floor): a lower bound of the cosine of the ``k``-th nearest row, from columns of few rows.

    The part of a product over some columns is a lower bound only if no value is negative.
    """
    some = cells.where(F.col("n") <= few)
    parts = _products(some, some)
    best = top_list_rows(parts, "id", "other_id", "part", k).where(F.col("pos") == k)
    return best.select("id", F.col("part").alias("floor"))


def prefixes(cells: DataFrame, floor: DataFrame) -> DataFrame:
    """The cells that a row looks up, with ``floor`` and ``rest``, the length of those it leaves out.

    Columns are left out by size classes, powers of two, so that a row has few sums however many cells it has.
    """
    size = F.floor(F.log2("n")).cast("int").alias("size")
    sized = cells.select("*", size)
    sums = sized.groupBy("id", "size").agg(F.sum(F.col("x") * F.col("x")).alias("square"))
    sums = lookup(sums, floor, ["id"], "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    popular = Window.partitionBy("id").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    length = F.sqrt(F.sum("square").over(popular))
    out = F.col("length") * (1 + SLACK) < F.col("floor")
    cuts = (
        sums.withColumn("length", length)
        .groupBy("id", "floor")
        .agg(
            F.coalesce(F.max(F.when(out, F.col("length"))), F.lit(0.0)).alias("rest"),
            F.max(F.when(~out, F.col("size"))).alias("largest"),
        )
    )
    return lookup(sized, cuts, ["id"]).where(F.col("size") <= F.col("largest")).drop("size", "largest")


def looked_up(cells: DataFrame, k: int, few: int = FEW) -> DataFrame:
    """The cells that rows look up, written once: all of them where a value is negative."""
    negative = cells.where("x < 0").limit(1).count()
    none = cells.select("id").distinct().select("id", F.lit(0.0).alias("floor"))
    floor = none if negative else materialize(floors(cells, k, few), "floors")
    return materialize(prefixes(cells, floor).withColumn("negative", F.lit(bool(negative))), "prefixes")


def candidates(cells: DataFrame, k: int, few: int = FEW, found: DataFrame | None = None) -> DataFrame:
    """(id, other_id): pairs that can be among the ``k`` nearest of ``id``; ``found`` is what ``looked_up`` gave."""
    found = looked_up(cells, k, few) if found is None else found
    bounds = found.select("id", "floor", "rest", "negative").distinct()
    parts = lookup(_products(found, cells), bounds, ["id"])
    reached: Column = (F.col("part") + F.col("rest")) * (1 + SLACK) >= F.col("floor")
    return parts.where(reached | F.col("negative")).select("id", "other_id")


def _by_blocks(cells: DataFrame, k: int, rows: int) -> DataFrame:
    """(id, pos, neighbour_id, sim): the ``k`` nearest from products of blocks, rows of like largest cells together."""
    vectors = materialize(packed_cells(cells), "cell-vectors")
    found = best_matches(vectors, vectors, k, exclude_same_id=True, left_rows=rows, right_rows=rows)
    return as_neighbours(found.where(F.col("score") > 0))


def action_neighbours(
    matrix: DataFrame, k: int, entity: str = "item_id", across: str = "user_id", few: int = FEW
) -> DataFrame:
    """(id, pos, neighbour_id, sim): the ``k`` nearest other rows by cosine over raw cells (item_id, user_id, val).

    Exact: only rows with a cosine above zero count, ties go to the smaller id. With the two columns
    swapped, users by their items. Null and zero cells say nothing.
    """
    matrix = matrix.where((F.col("val") != 0) & ~F.isnan(F.col("val").cast("double")))
    cells = materialize(unit_cells(matrix, entity, across), "unit-cells")
    found = looked_up(cells, k, few)
    sizes = cells.agg(F.count_distinct("id").alias("rows"), F.count_distinct("dim").alias("columns")).first()
    met = found.agg(F.sum("n")).first()[0] or 0
    if cheaper(met, sizes.rows, sizes.rows, sizes.columns):
        return _by_blocks(cells, k, sizes.rows)
    pairs = materialize(candidates(cells, k, few, found), "candidates")
    scored = pair_cosine(pairs, matrix, entity, across).where(F.col("sim") > 0)
    return top_list_rows(scored, "id", "other_id", "sim", k).withColumnRenamed("other_id", "neighbour_id")
