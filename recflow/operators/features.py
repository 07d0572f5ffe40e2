"""Place and tag features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.joins import lookup

LEVELS = ("province", "city", "district")


def geo_feature(
    df: DataFrame, id_col: str, out_id: str, run_date: str, levels: Sequence[str] = LEVELS
) -> DataFrame:
    """(user_id or item_id, place levels, date)."""
    return df.select(F.col(id_col).alias(out_id), *levels, F.lit(run_date).alias("date"))


def tag_feature(
    entity_tags: DataFrame, id_col: str, run_date: str, tags: DataFrame | None = None
) -> DataFrame:
    """(entity, tag_id, has = 1, date), one row per tag an entity has; absent rows mean 0.

    With ``tags`` only the tags of that dimension count.
    """
    present = entity_tags.select(id_col, "tag_id").distinct()
    if tags is not None:
        present = present.join(tags.select("tag_id"), "tag_id", "left_semi")
    return present.select(id_col, "tag_id", F.lit(1).alias("has"), F.lit(run_date).alias("date"))


def tag_presence(pairs: DataFrame, feature: DataFrame, id_col: str) -> DataFrame:
    """``has`` as 0 or 1 for each given (entity, tag_id)."""
    present = feature.select(id_col, "tag_id", "has")
    return lookup(pairs, present, [id_col, "tag_id"], "left").withColumn(
        "has", F.coalesce("has", F.lit(0))
    )
