"""Quality of what was shown, measured against what users did.

``feed`` rows are (user_id, item_id, rec_algo), ``actions`` are (user_id, item_id). Both are made
distinct first. Counts are summed per item before the items' category is looked up, so a popular
item is one row there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions import f1_score
from recflow.sources.dimensions import REC_ALGORITHMS, category_dimension

PAIR = ["user_id", "item_id"]


def _acted(actions: DataFrame) -> DataFrame:
    return actions.select(*PAIR).distinct()


def evaluate(
    feed: DataFrame,
    actions: DataFrame,
    items: DataFrame,
    run_date: str,
    algorithms: Sequence[str] = REC_ALGORITHMS,
) -> DataFrame:
    """(item_category, rec_algo, precision, recall, f1, date) for every category and algorithm.

    Hits are pairs both shown and acted on; precision is hits over shown, recall hits over acted on.
    A ratio over nothing is null.
    """
    kinds = items.select(F.col("id").alias("item_id"), F.col("category").alias("item_category"))
    acted = _acted(actions)
    # moved by pair first: made distinct before, a task's rows all stay in memory and few are equal
    shown = feed.where(F.col("rec_algo").isin(list(algorithms))).select(*PAIR, "rec_algo").repartition(*PAIR).distinct()
    hits = (
        shown.join(acted.withColumn("_hit", F.lit(1)), PAIR, "left")
        .groupBy("item_id", "rec_algo")
        .agg(F.count("*").alias("_shown"), F.count("_hit").alias("_hits"))
        .join(kinds, "item_id")
        .groupBy("item_category", "rec_algo")
        .agg(F.sum("_shown").alias("_shown"), F.sum("_hits").alias("_hits"))
    )
    done = (
        acted.groupBy("item_id")
        .agg(F.count("*").alias("_acted"))
        .join(kinds, "item_id")
        .groupBy("item_category")
        .agg(F.sum("_acted").alias("_acted"))
    )
    names = F.explode(F.array(*[F.lit(a) for a in algorithms])).alias("rec_algo")
    cells = category_dimension(items).select(F.col("category").alias("item_category"), names)
    shown_n, hits_n, acted_n = (F.coalesce(c, F.lit(0)) for c in ("_shown", "_hits", "_acted"))
    return (
        cells.join(hits, ["item_category", "rec_algo"], "left")
        .join(done, "item_category", "left")
        .select(
            "item_category",
            "rec_algo",
            F.try_divide(hits_n.cast("double"), shown_n.cast("double")).alias("precision"),
            F.try_divide(hits_n.cast("double"), acted_n.cast("double")).alias("recall"),
        )
        .withColumn("f1", f1_score(F.col("precision"), F.col("recall")))
        .withColumn("date", F.lit(run_date))
    )


def mean_average_precision(feed: DataFrame, actions: DataFrame, k: int) -> DataFrame:
    """(rec_algo, map_at_k, users): mean over the users who acted and were shown something.

    ``feed`` carries ``pos`` from 1, one item per place. The average precision of a user is the sum
    of the precision at each hit within ``k``, over the smaller of ``k`` and the items acted on.
    """
    acted = _acted(actions)
    relevant = acted.groupBy("user_id").agg(F.count("*").alias("_relevant"))
    head = feed.where(F.col("pos") <= k).select(*PAIR, "rec_algo", "pos")
    # at most k rows per user and algorithm
    so_far = Window.partitionBy("user_id", "rec_algo").orderBy("pos")
    hits = F.sum("_hit").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    flagged = head.join(acted.withColumn("_hit", F.lit(1)), PAIR, "left").fillna(0, ["_hit"])
    precision = F.col("_hit") * hits / F.col("pos")
    per_user = (
        flagged.select("user_id", "rec_algo", precision.alias("_p"))
        .groupBy("user_id", "rec_algo")
        .agg(F.sum("_p").alias("_p"))
        .join(relevant, "user_id")
        .select("rec_algo", (F.col("_p") / F.least("_relevant", F.lit(k))).alias("_ap"))
    )
    return per_user.groupBy("rec_algo").agg(
        F.avg("_ap").alias("map_at_k"), F.count("*").alias("users")
    )


def user_coverage(feed: DataFrame, users: DataFrame) -> DataFrame:
    """(rec_algo, users_covered, users_all, coverage): users who were shown at least one item."""
    everyone = users.select(F.col("uid").alias("user_id")).distinct()
    size = everyone.agg(F.count("*").alias("n")).scalar()
    reached = feed.select("user_id", "rec_algo").distinct().join(everyone, "user_id", "left_semi")
    return (
        reached.groupBy("rec_algo")
        .agg(F.count("*").alias("users_covered"))
        .withColumn("users_all", size)
        .withColumn(
            "coverage",
            F.try_divide(F.col("users_covered").cast("double"), F.col("users_all").cast("double")),
        )
    )
