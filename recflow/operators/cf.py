"""Collaborative filtering by matrix factorization.

The factors come from Spark's ALS, the lists and neighbours from block matching, which is exact, holds
two blocks in a task and writes no row per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.blocks import best_matches, nearest
from recflow.operators.joins import lookup
from recflow.operators.ranking import rank_within
from recflow.session import materialize, use_checkpoints

RANK = 15
ITERATIONS = 10
# Blocks that users and items are cut into; a fit is the same on any cluster.
BLOCKS = 32


def als_model(
    matrix: DataFrame,
    rank: int = RANK,
    max_iter: int = ITERATIONS,
    seed: int = 42,
    implicit: bool = False,
    blocks: int = BLOCKS,
) -> ALSModel:
    """ALS on the non-zero cells of (user_id, item_id, val).

    ``implicit`` treats the cells as confidence and every other pair as a weak no, which is the way
    to use unseen pairs without storing them as zeros. Ids must fit an int; ``factorize`` takes any.
    The start values depend on ``blocks``, so it does not follow the cluster: raise it with the data.
    """
    use_checkpoints(matrix.sparkSession)
    cells = matrix.where(F.col("val") != 0).select(
        F.col("user_id").cast("int"), F.col("item_id").cast("int"), F.col("val").cast("float")
    )
    als = ALS(
        rank=rank,
        maxIter=max_iter,
        seed=seed,
        implicitPrefs=implicit,
        coldStartStrategy="drop",
        userCol="user_id",
        itemCol="item_id",
        ratingCol="val",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
    )
    return als.fit(cells)


@dataclass(frozen=True)
class Factors:
    """(user_id, features) and (item_id, features) of a factorization of some rank."""

    users: DataFrame
    items: DataFrame
    rank: int


def _codes(cells: DataFrame, key: str) -> DataFrame:
    """(key, code): the distinct values numbered from 0."""
    numbered = rank_within(cells.select(key).distinct(), [], [key], "_code")
    return numbered.select(key, (F.col("_code") - 1).alias("_code"))


def factorize(matrix: DataFrame, rank: int = RANK, **options) -> Factors:
    """ALS on the non-zero cells of (user_id, item_id, val), for ids of any type.

    Spark's ALS takes int ids, so users and items are numbered first. ``options`` are those of
    ``als_model``.
    """
    cells = materialize(matrix.where(F.col("val") != 0).select("user_id", "item_id", "val"), "cells")
    users, items = (materialize(_codes(cells, key), "codes") for key in ("user_id", "item_id"))
    coded = lookup(cells, users.withColumnRenamed("_code", "_user"), ["user_id"])
    coded = lookup(coded, items.withColumnRenamed("_code", "_item"), ["item_id"])
    coded = coded.select(F.col("_user").alias("user_id"), F.col("_item").alias("item_id"), "val")
    model = als_model(coded, rank, **options)

    def named(factors: DataFrame, codes: DataFrame, key: str) -> DataFrame:
        found = factors.select(F.col("id").cast("long").alias("_code"), "features")
        return materialize(found.join(codes, "_code").select(key, "features"), "factors")

    return Factors(named(model.userFactors, users, "user_id"), named(model.itemFactors, items, "item_id"), rank)


def factor_table(factors: DataFrame, id_col: str, rank: int) -> DataFrame:
    """Factors with one column per dimension: id, fac_0, fac_1, ..."""
    wide = [F.col("features")[i].alias(f"fac_{i}") for i in range(rank)]
    return factors.select(id_col, *wide)


def als_factors(factors: Factors) -> tuple[DataFrame, DataFrame]:
    """The wide user and item factor tables."""
    return (
        factor_table(factors.users, "user_id", factors.rank),
        factor_table(factors.items, "item_id", factors.rank),
    )


def item_similarity(factors: Factors, k: int) -> DataFrame:
    """(id, pos, neighbour_id, sim): the ``k`` items most alike by cosine of their factors."""
    return nearest(factors.items, "item_id", "features", k)


def user_similarity(factors: Factors, k: int) -> DataFrame:
    """(id, pos, neighbour_id, sim): the ``k`` users most alike by cosine of their factors."""
    return nearest(factors.users, "user_id", "features", k)


def cf_recommend(factors: Factors, k: int) -> DataFrame:
    """(user_id, pos, item_id, score): the ``k`` best items per user, found block by block."""
    vector = F.col("features").cast("array<double>").alias("vec")
    users = factors.users.select(F.col("user_id").alias("id"), vector)
    items = factors.items.select(F.col("item_id").alias("id"), vector)
    found = best_matches(users, items, k)
    return found.select(
        F.col("left_id").alias("user_id"), "pos", F.col("right_id").alias("item_id"), "score"
    )


def cf_list(factors: Factors, k: int) -> DataFrame:
    """(user_id, rec_list): the ``k`` best items of each user as one array."""
    entries = F.array_sort(F.collect_list(F.struct("pos", "item_id")))
    return cf_recommend(factors, k).groupBy("user_id").agg(entries["item_id"].alias("rec_list"))


def training_error(factors: Factors, matrix: DataFrame) -> DataFrame:
    """(cells, rmse, rmse_of_mean): the error on the non-zero cells, and that of their mean as prediction."""
    dot = F.aggregate(
        F.zip_with("_u", "_i", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )
    cells = matrix.where(F.col("val") != 0).select("user_id", "item_id", F.col("val").cast("double").alias("val"))
    met = lookup(cells, factors.users.withColumnRenamed("features", "_u"), ["user_id"])
    met = lookup(met, factors.items.withColumnRenamed("features", "_i"), ["item_id"])
    missed = met.select("val", (F.col("val") - dot).alias("_miss"))
    return missed.agg(
        F.count("*").alias("cells"),
        F.sqrt(F.avg(F.col("_miss") * F.col("_miss"))).alias("rmse"),
        F.stddev_pop("val").alias("rmse_of_mean"),
    )


def check_lists(factors: Factors, lists: DataFrame, matrix: DataFrame) -> DataFrame:
    """What must hold of each user's list: (user_id, items, distinct_items, known, matching, ordered).

    ``known``: all items have cells; ``matching``: scores are the products of the factors to 1e-4;
    ``ordered``: places run from 1 and scores do not rise.
    """
    dot = F.aggregate(
        F.zip_with("_u", "_i", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )
    own = matrix.where(F.col("val") != 0).select("item_id", F.lit(True).alias("_known")).distinct()
    rows = lookup(lists, factors.users.withColumnRenamed("features", "_u"), ["user_id"], "left")
    rows = lookup(rows, factors.items.withColumnRenamed("features", "_i"), ["item_id"], "left")
    rows = lookup(rows, own, ["item_id"], "left")
    close = F.coalesce(F.abs(dot - F.col("score")) <= 1e-4, F.lit(False))
    places = F.array_sort(F.collect_list(F.struct("pos", "score")))
    falling = F.forall(
        F.sequence(F.lit(1), F.size("_places") - 1),
        lambda i: F.get("_places", i - 1)["score"] >= F.get("_places", i)["score"],
    )
    checked = rows.withColumn("_close", close).groupBy("user_id").agg(
        F.count("*").alias("items"),
        F.countDistinct("item_id").alias("distinct_items"),
        (F.count("_known") == F.count("*")).alias("known"),
        F.every("_close").alias("matching"),
        places.alias("_places"),
    )
    numbered = F.transform("_places", lambda p: p["pos"].cast("int")) == F.sequence(F.lit(1), F.size("_places"))
    ordered = ((F.size("_places") < 2) | falling) & numbered
    return checked.select("user_id", "items", "distinct_items", "known", "matching", ordered.alias("ordered"))
