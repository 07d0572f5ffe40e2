"""Small reference tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The weight of each tracked event type.
EVENT_WEIGHTS = {
    "view": 1.0,
    "click": 4.0,
    "long_view": 7.0,
    "add_to_favorites": 20.0,
    "purchase": 30.0,
    "search_view": 5.0,
    "search_click": 10.0,
}

# The recommendation algorithms a feed row can come from.
REC_ALGORITHMS = ("content_based", "list_based", "cf_based")


def event_weights(spark: SparkSession, mapping: Mapping[str, float] = EVENT_WEIGHTS) -> DataFrame:
    """The event weights as a table (event_type, score)."""
    rows = [(k, float(v)) for k, v in mapping.items()]
    return spark.createDataFrame(rows, "event_type string, score double")


def category_dimension(items: DataFrame) -> DataFrame:
    """The categories that occur, one row each."""
    return items.select("category").where(F.col("category").isNotNull()).distinct()


def tag_dimension(tags: DataFrame, categories: DataFrame, run_date: str) -> DataFrame:
    """Tags with the attributes of their tag category, kept when the category is unknown."""
    return tags.join(categories, tags["category_id"] == categories["tag_category_id"], "left").withColumn(
        "date", F.lit(run_date)
    )


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One stop word per line of a text file."""
    return spark.read.text(path).select(F.trim("value").alias("key_word")).where("key_word <> ''").distinct()

