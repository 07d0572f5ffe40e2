"""Scores and the action matrix from tracking events.

Events carry ``user_id, item_id, event_type`` and a date column ``day``. The daily rule is
``score today = gamma * score yesterday + weights of today``. Unrolled, the score at ``run_date`` is
the sum of ``weight * gamma ** age in days``, which one aggregation computes for any key.

Event types without a weight add nothing, so they are filtered at the scan. A key whose rows are a
large share of all events is summed before the shuffle, so one hot user or item costs no more than
any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.functions import comparable, decay, event_weight
from recflow.operators.joins import lookup
from recflow.operators.ranking import rank_within
from recflow.sources.dimensions import EVENT_WEIGHTS

GAMMA = 0.9

Weights = Mapping[str, float] | DataFrame


def weight_events(events: DataFrame, weights: Weights = EVENT_WEIGHTS) -> DataFrame:
    """Every event with its ``weight``, 0 for a type without one."""
    if not isinstance(weights, DataFrame):
        return events.withColumn("weight", event_weight(F.col("event_type"), weights))
    table = weights.select("event_type", F.col("score").cast("double").alias("weight"))
    return lookup(events, table, ["event_type"], "left").select(
        *events.columns, F.coalesce("weight", F.lit(0.0)).alias("weight")
    )


def _weighted(events: DataFrame, weights: Weights) -> DataFrame:
    if isinstance(weights, DataFrame):
        return weight_events(events, weights)
    return weight_events(events.where(F.col("event_type").isin(list(weights))), weights)


def decayed_score(
    events: DataFrame,
    keys: Sequence[str],
    run_date: str,
    gamma: float = GAMMA,
    weights: Weights = EVENT_WEIGHTS,
    value: str = "score",
) -> DataFrame:
    """Decayed event weight per key, from all events up to ``run_date``; absent keys have 0."""
    past = events.where(F.col("day") <= F.lit(run_date).cast("date"))
    worth = F.col("weight") * decay(gamma, run_date, F.col("day"))
    return _weighted(past, weights).groupBy(*keys).agg(F.sum(worth).alias(value))


def day_score(
    events: DataFrame,
    keys: Sequence[str],
    run_date: str,
    weights: Weights = EVENT_WEIGHTS,
    value: str = "score",
) -> DataFrame:
    """Event weight per key of ``run_date`` alone."""
    today = events.where(F.col("day") == F.lit(run_date).cast("date"))
    return _weighted(today, weights).groupBy(*keys).agg(F.sum("weight").alias(value))


def update_score(
    previous: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    days: int = 1,
    gamma: float = GAMMA,
    value: str = "score",
) -> DataFrame:
    """The next daily score from the stored one, ``days`` after it. Equals ``decayed_score``.

    Keys of either side are kept. Both sides are summed in one shuffle, without a join.
    """
    aged = previous.select(*keys, (F.col(value) * F.lit(float(gamma) ** days)).alias(value))
    return aged.unionByName(today.select(*keys, value)).groupBy(*keys).agg(F.sum(value).alias(value))


def catch_up(
    previous: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    watermark: str,
    run_date: str,
    gamma: float = GAMMA,
    weights: Weights = EVENT_WEIGHTS,
    value: str = "score",
    arrived: str = "arrived",
) -> DataFrame:
    """The score of ``run_date`` from the one stored for ``watermark`` and what arrived since, however late.

    The score is a sum, so an event counts on the day it arrives, at the age it then has; its day decides if that
    is later. Equals ``decayed_score`` of all events arrived by ``run_date``. Only events of the
    days since are read if the table is laid out by arrival. An event without an arrival date counts on its day.
    """
    day, since, until = F.col("day"), F.lit(watermark).cast("date"), F.lit(run_date).cast("date")
    known = F.greatest(F.to_date(arrived), day)
    # said twice, so that the filter on the arrival alone can prune a table laid out by it
    came = F.col(arrived).isNull() | (F.to_date(arrived) <= until)
    fresh = events.where(came & (known > since) & (known <= until))
    added = decayed_score(fresh, keys, run_date, gamma, weights, value)
    days = (date.fromisoformat(run_date) - date.fromisoformat(watermark)).days
    return update_score(previous, added, keys, days, gamma, value)


def item_score(
    items: DataFrame,
    events: DataFrame,
    run_date: str,
    gamma: float = GAMMA,
    weights: Weights = EVENT_WEIGHTS,
) -> DataFrame:
    """Score of every item (``items.id``); an item nobody touched has 0."""
    scores = decayed_score(events, ["item_id"], run_date, gamma, weights)
    everything = items.select(F.col("id").alias("item_id")).distinct()
    return _with_zero(everything, scores, "item_id", run_date)


def user_score(
    users: DataFrame,
    events: DataFrame,
    run_date: str,
    gamma: float = GAMMA,
    weights: Weights = EVENT_WEIGHTS,
) -> DataFrame:
    """Score of every user (``users.uid``); a user without events has 0."""
    scores = decayed_score(events, ["user_id"], run_date, gamma, weights)
    everyone = users.select(F.col("uid").alias("user_id")).distinct()
    return _with_zero(everyone, scores, "user_id", run_date)


def _with_zero(spine: DataFrame, scores: DataFrame, key: str, run_date: str) -> DataFrame:
    return spine.join(scores, key, "left").select(
        key, F.coalesce("score", F.lit(0.0)).alias("score"), F.lit(run_date).alias("date")
    )


def user_level(
    scores: DataFrame,
    thresholds: Sequence[float] | None = None,
    levels: int = 4,
) -> DataFrame:
    """A level per user, 1 for the lowest scores.

    With ``thresholds`` (ascending) the level is one more than the number of thresholds reached.
    Without, users are cut into ``levels`` groups of equal size by score and user_id, the first
    groups one larger when the sizes do not divide, which is what ``ntile`` gives. The cut uses the
    distributed ranking: a plain ``ntile`` would sort all users in one task.
    """
    if thresholds is not None:
        reached = sum(((F.col("score") >= F.lit(float(t))).cast("int") for t in thresholds), F.lit(0))
        return scores.withColumn("level", 1 + reached)
    ordered = scores.withColumn("_order", comparable(F.col("score")))
    ranked = rank_within(ordered, [], ["_order", "user_id"]).drop("_order")
    size = ranked.agg(F.count("*").alias("n")).scalar()
    small = F.floor(size / F.lit(levels))
    larger = size - small * levels
    place = F.col("rn") - 1
    in_larger = F.floor(place / (small + 1))
    in_small = larger + F.floor(F.try_divide(place - larger * (small + 1), small))
    level = F.when(place < larger * (small + 1), in_larger).otherwise(in_small) + 1
    return ranked.withColumn("level", level.cast("int")).drop("rn")


def action_matrix(
    events: DataFrame,
    items: DataFrame,
    run_date: str,
    category: str | None = None,
    users: DataFrame | None = None,
    gamma: float = GAMMA,
    weights: Weights = EVENT_WEIGHTS,
) -> DataFrame:
    """Decayed weight per (user, item), for the items of a category; absent cells are 0.

    Cells are summed before they meet the items, so a popular item brings at most one row per user
    into that join, which adaptive execution splits. The join is by the item and its hash, so what
    groups or joins the cells by item next exchanges them again and can be split too.
    """
    cells = decayed_score(events, ["user_id", "item_id"], run_date, gamma, weights, value="val")
    wanted = items if category is None else items.where(F.col("category") == category)
    cells = lookup(cells, wanted.select(F.col("id").alias("item_id")), ["item_id"], "left_semi")
    if users is not None:
        cells = lookup(cells, users.select(F.col("uid").alias("user_id")), ["user_id"], "left_semi")
    return cells.select("user_id", "item_id", "val", F.lit(run_date).alias("date"))


def matrix_cells(pairs: DataFrame, matrix: DataFrame, value: str = "val") -> DataFrame:
    """The matrix value of each given (user_id, item_id), 0 for cells the matrix does not hold."""
    cells = matrix.select("user_id", "item_id", value)
    return lookup(pairs, cells, ["user_id", "item_id"], "left").withColumn(
        value, F.coalesce(value, F.lit(0.0))
    )
