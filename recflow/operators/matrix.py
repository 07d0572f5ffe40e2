"""Products of long-form sparse matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.joins import lookup

# Cells of the right matrix that are packed into one array.
PACKED_CELLS = 1_000


def sparse_matmul(
    a: DataFrame,
    b: DataFrame,
    row: str,
    inner: str,
    column: str,
    a_val: str = "val",
    b_val: str = "val",
    packed_cells: int = PACKED_CELLS,
) -> DataFrame:
    """(row, column, val) of ``a (row, inner)`` times ``b (inner, column)``.

    The rows of ``b`` are packed into arrays of about ``packed_cells`` cells, one for a narrow row and
    as many as it takes for a wide one, so the join meets few rows per key whatever the number of cells
    ``a`` has there, a hot key can be split, and no array grows with the data. The products are summed
    before the shuffle.
    """
    cells = b.where(F.col(b_val) != 0).select(inner, F.col(column), F.col(b_val).alias("_b"))
    sizes = cells.groupBy(inner).agg(F.ceil(F.count("*") / F.lit(packed_cells)).alias("_shards"))
    packed = (
        lookup(cells, sizes, [inner])
        .withColumn("_shard", F.pmod(F.xxhash64(column), F.col("_shards")))
        # the join above leaves all cells of a key together, which would undo the shards
        .repartition(inner, "_shard")
        .groupBy(inner, "_shard")
        .agg(F.collect_list(F.struct(column, "_b")).alias("_cells"))
    )
    left = a.where(F.col(a_val) != 0).select(row, inner, F.col(a_val).alias("_a"))
    return (
        lookup(left, packed, [inner])
        .select(row, "_a", F.inline("_cells"))
        .groupBy(row, column)
        .agg(F.sum(F.col("_a") * F.col("_b")).alias("val"))
    )


def user_text_feature(actions: DataFrame, item_text: DataFrame, run_date: str) -> DataFrame:
    """(user_id, key_word, val, date): the action matrix times the items' text features."""
    product = sparse_matmul(actions, item_text, "user_id", "item_id", "key_word")
    return product.withColumn("date", F.lit(run_date))
