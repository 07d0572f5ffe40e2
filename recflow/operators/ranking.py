"""Rankings: full ranks without one task per group, top rows per group, fixed-size lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions import comparable
from recflow.operators.joins import lookup
from recflow.session import broadcast_if_small, materialize

# Broadcast of one row per group, see rank_within.
MAX_BROADCAST_GROUPS = 100_000

# monotonically_increasing_id holds the partition above this bit and the row number below it
_ROW_BITS = 33


def rank_within(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], rn: str = "rn"
) -> DataFrame:
    """``row_number`` over ``groups``, for groups of any size.

    A window would put a whole group in one task. Here the frame is range-sorted over the cluster,
    so a large group spans many partitions, and each row's number is the size of the partitions
    before its own, plus its place inside, less the place of its group's first row. The sorted
    frame is written first: the numbers and the rows must come from the same sort. ``order`` should
    end in a unique key, then the ranks are the same in every run.
    """
    ordered = df.orderBy(*groups, *order).withColumn("_pos", F.monotonically_increasing_id())
    placed = materialize(ordered, "ranked")
    part = F.shiftright("_pos", _ROW_BITS)
    row = F.col("_pos").bitwiseAND((1 << _ROW_BITS) - 1)
    # one row per partition, so both the window and the broadcast stay small
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(
        sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    placed = (
        placed.withColumn("_part", part)
        .join(starts, "_part", "left")
        .withColumn("_place", F.col("_start") + row)
        .drop("_part", "_start", "_pos")
    )
    if not groups:
        return placed.select(*df.columns, (F.col("_place") + 1).cast("long").alias(rn))
    # a struct equals another with nulls in the same fields, so rows without a group are one group
    placed = placed.withColumn("_group", F.struct(*groups))
    firsts = placed.groupBy("_group").agg(F.min("_place").alias("_first"))
    firsts = broadcast_if_small(firsts, MAX_BROADCAST_GROUPS)
    return lookup(placed, firsts, ["_group"]).select(
        *df.columns, (F.col("_place") - F.col("_first") + 1).cast("long").alias(rn)
    )


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], k: int, rn: str = "rn"
) -> DataFrame:
    """The first ``k`` rows of each group, numbered.

    Rank and filter are one plan, so Spark keeps only ``k`` rows per group and task before the
    shuffle. It does so up to a limit; a larger ``k`` takes the distributed ranking.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        return rank_within(df, groups, order, rn).where(F.col(rn) <= k)
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(window).cast("long")).where(F.col(rn) <= k)


def _best_first(score: str, key: str) -> list[Column]:
    return [comparable(F.col(score)).desc(), F.col(key).asc()]


def with_category(scores: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, category, score) for every item; an item without a score row has 0."""
    kinds = items.select(F.col("id").alias("item_id"), "category")
    return kinds.join(scores.select("item_id", "score"), "item_id", "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )


def rank_items(scores: DataFrame, items: DataFrame, run_date: str) -> DataFrame:
    """All items numbered within their category by score, best first, ties by item_id."""
    scored = with_category(scores, items).withColumn("_order", comparable(F.col("score")))
    ranked = rank_within(scored, ["category"], [F.col("_order").desc(), "item_id"])
    return ranked.drop("_order").withColumn("date", F.lit(run_date))


def fresh_list(ranked: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Items that have not gathered much score yet."""
    return ranked.where(F.col("score") < threshold)


def hot_list(ranked: DataFrame, fresh: DataFrame, size: int = 30) -> DataFrame:
    """The first ``size`` items of each category that are not in the fresh list.

    From ranked rows, or from scored ones without ranking them all.
    """
    first = ranked.where(F.col("rn") <= size) if "rn" in ranked.columns else top_n(ranked, size)
    return first.join(fresh.select("item_id"), "item_id", "left_anti")


def top_n(items: DataFrame, n: int = 80) -> DataFrame:
    """The best ``n`` items of each category, from ranked rows or from scored ones."""
    if "rn" in items.columns:
        return items.where(F.col("rn") <= n)
    return top_per_group(items, ["category"], _best_first("score", "item_id"), n)


def bottom_m(items: DataFrame, m: int = 200) -> DataFrame:
    """The last ``m`` items of each category with their rank; all of a smaller category.

    Works on ranked rows, or on scored ones without ranking them all: the last items are picked
    from behind, and the category size turns their place into the rank.
    """
    if "rn" in items.columns:
        return top_per_group(items, ["category"], [F.col("rn").desc()], m, "_back").drop("_back")
    behind = [comparable(F.col("score")).asc(), F.col("item_id").desc()]
    last = top_per_group(items, ["category"], behind, m, "_back")
    sizes = items.groupBy("category").agg(F.count("*").alias("_n"))
    return last.join(sizes, "category").select(
        *items.columns, (F.col("_n") - F.col("_back") + 1).alias("rn")
    )


def top_list_rows(df: DataFrame, user: str, item: str, score: str, k: int) -> DataFrame:
    """The best ``k`` items of each user as rows (user, pos, item, score), pos from 1."""
    top = top_per_group(df, [user], _best_first(score, item), k, "pos")
    return top.select(user, "pos", item, score)


def ranked_list(df: DataFrame, user: str, item: str, score: str, k: int) -> DataFrame:
    """The best ``k`` items of each user as one ordered array ``item_list``."""
    rows = top_list_rows(df, user, item, score, k)
    entries = F.array_sort(F.collect_list(F.struct("pos", item)))
    return rows.groupBy(user).agg(entries[item].alias("item_list"))


def quantiles(
    df: DataFrame, value: str, key: str, probabilities: Sequence[float]
) -> DataFrame:
    """Exact quantiles (probability, value): the smallest value reaching that share of the rows."""
    values = df.where(F.col(value).isNotNull()).select(
        F.col(key).alias("_key"), comparable(F.col(value)).alias(value)
    )
    ranked = rank_within(values, [], [value, "_key"])
    size = ranked.agg(F.count("*").alias("n")).scalar()
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    place = F.greatest(F.ceil(F.col("probability") * size).cast("long"), F.lit(1).cast("long"))
    spots = df.sparkSession.range(1).select(wanted.alias("probability")).select(
        "probability", place.alias("rn")
    )
    return ranked.join(F.broadcast(spots), "rn").select("probability", value)
