"""Activity of users and items: volume, active days, mix of event types, and score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.sources.dimensions import EVENT_WEIGHTS


def activity(
    events: DataFrame, key: str, scores: DataFrame, event_types: Sequence[str] = tuple(EVENT_WEIGHTS)
) -> DataFrame:
    """One row per entity of ``scores``: events, active days, first and last day, share per type.

    Events are first counted per entity, day and type, so a very active entity is a few rows per day
    when its days are counted. Shares of an entity without events are null.
    """
    counts = events.groupBy(key, "day", "event_type").agg(F.count("*").alias("_n"))
    days = counts.groupBy(key, "day").agg(
        F.sum("_n").alias("_n"),
        *[F.sum(F.when(F.col("event_type") == t, F.col("_n"))).alias(f"_{t}") for t in event_types],
    )
    totals = days.groupBy(key).agg(
        F.sum("_n").alias("events"),
        F.count("*").alias("active_days"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        *[F.sum(f"_{t}").alias(f"_{t}") for t in event_types],
    )
    shares = [
        F.when(
            F.col("events").isNotNull(), F.coalesce(f"_{t}", F.lit(0)) / F.col("events")
        ).alias(f"share_{t}")
        for t in event_types
    ]
    return scores.select(key, "score").join(totals, key, "left").select(
        key,
        "score",
        F.coalesce("events", F.lit(0)).alias("events"),
        F.coalesce("active_days", F.lit(0)).alias("active_days"),
        "first_day",
        "last_day",
        *shares,
    )


def analyze_users(users_scored: DataFrame, events: DataFrame, **options) -> DataFrame:
    """``activity`` per user; the scores are those of ``user_score``."""
    return activity(events, "user_id", users_scored, **options)


def analyze_items(items_scored: DataFrame, events: DataFrame, **options) -> DataFrame:
    """``activity`` per item; the scores are those of ``item_score``."""
    return activity(events, "item_id", items_scored, **options)
