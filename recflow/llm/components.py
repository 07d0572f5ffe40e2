"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.joins import lookup
from recflow.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(hashed), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge (u, v) of long ids; the root is the smallest node.

    Each round hangs the neighbours of every node under its smallest neighbour, first the larger ones,
    then the smaller ones, until the edges are stars. A node of any degree is one key of an aggregation
    with partial minima and of a join that adaptive execution can split. Each round is written to the
    shared folder, so lineage stays short; the driver sees two numbers of a round.
    """
    edges = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = materialize(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = lookup(both.where(F.col("v") > F.col("u")), least, ["u"])
        edges = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = materialize(edges, "edges")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup(edges, least, ["u"]).where(F.col("v") != F.col("m")).select("v", "m")
        edges = small.union(least).distinct().toDF("u", "v")
        edges = materialize(edges, "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct()
    )
