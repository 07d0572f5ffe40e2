"""Joins of many rows with few rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` with a ``table`` that has few rows per key; a key of any share of the rows is split.

    Adaptive execution splits a large join partition over several tasks, but only where both inputs
    come straight from an exchange. A table just aggregated by the same keys does not: Spark joins
    it in place, and all rows of a hot key stay in one task. Joining on the hash of the keys as well
    makes Spark exchange the table, and the split applies.
    """
    hashed = F.xxhash64(*keys)
    return (
        rows.withColumn("_hash", hashed)
        .join(table.withColumn("_hash", hashed), [*keys, "_hash"], how)
        .drop("_hash")
    )
