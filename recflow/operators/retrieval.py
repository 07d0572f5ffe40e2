"""Top-k retrieval from an inverted index whose postings are ordered by weight.

The postings of a word are cut into blocks, heaviest first, each with its largest weight. A query first reads the
first block of its words, which gives it a floor: what its k-th item reaches at least. An item of which
every word weighs less than the same share of that word's largest weight cannot reach the floor, if the share is the
floor over the most that any item could reach. So only blocks above that share are read; the items
found there are scored in full. Weights must not be negative.

Where the words are few and most items have them, queries find most items in any block. How many postings they could read
is known before; when products of blocks of rows cost less, the postings of an item are put together and multiplied there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.blocks import best_matches, cheaper, packed_cells
from recflow.operators.joins import lookup
from recflow.operators.ranking import rank_within, top_list_rows
from recflow.session import materialize

# Postings of a block.
BLOCK = 128
SLACK = 1e-9


def impact_blocks(items: DataFrame, size: int = BLOCK) -> DataFrame:
    """(key_word, block, largest, postings) from (item_id, key_word, val); a posting is (item_id, val).

    A word of any share of the items has as many blocks as it needs.
    """
    weights = items.where(F.col("val") > 0).select("item_id", "key_word", F.col("val").cast("double").alias("val"))
    ranked = rank_within(weights, ["key_word"], [F.desc("val"), "item_id"])
    block = F.floor((F.col("rn") - 1) / size).cast("int").alias("block")
    return ranked.groupBy("key_word", block).agg(
        F.max("val").alias("largest"), F.collect_list(F.struct("item_id", "val")).alias("postings")
    )


def needed_blocks(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(user_id, key_word, block, least): the blocks that each query must read, and from which weight on."""
    asked = queries.where(F.col("val") > 0).select("user_id", "key_word", F.col("val").cast("double").alias("q"))
    asked = materialize(asked, "asked-words")
    heads = index.where(F.col("block") == 0).select("key_word", F.col("largest").alias("top"), "postings")
    met = materialize(lookup(asked, heads.select("key_word", "top"), ["key_word"]), "met-words")
    first = lookup(asked, heads, ["key_word"]).select("user_id", "q", F.inline("postings"))
    parts = first.groupBy("user_id", "item_id").agg(F.sum(F.col("q") * F.col("val")).alias("part"))
    floor = top_list_rows(parts, "user_id", "item_id", "part", k).where(F.col("pos") == k)
    most = met.groupBy("user_id").agg(F.sum(F.col("q") * F.col("top")).alias("most"))
    share = F.coalesce(F.col("part") / F.col("most"), F.lit(0.0)) * (1 - SLACK)
    shares = lookup(most, floor.select("user_id", "part"), ["user_id"], "left").select("user_id", share.alias("share"))
    least = (F.col("share") * F.col("top")).alias("least")
    wanted = lookup(met, materialize(shares, "shares"), ["user_id"]).select("user_id", "key_word", least)
    blocks = index.select("key_word", "block", "largest")
    return lookup(wanted, blocks, ["key_word"]).where(F.col("largest") >= F.col("least")).drop("largest")


def _by_products(index: DataFrame, asked: DataFrame, k: int, users: int, items: int) -> DataFrame:
    """The lists of ``index_top_k`` from all postings of the asked words, without a row per pair."""
    words = asked.select("key_word").distinct()
    postings = lookup(index.select("key_word", F.inline("postings")), words, ["key_word"]).where("item_id is not null")
    left = asked.where("user_id is not null and key_word is not null").select(
        F.col("user_id").alias("id"), F.col("key_word").alias("dim"), F.col("q").alias("x")
    )
    right = postings.select(F.col("item_id").alias("id"), F.col("key_word").alias("dim"), F.col("val").alias("x"))
    found = best_matches(packed_cells(left), packed_cells(right), k, left_rows=users, right_rows=items)
    found = found.where(F.col("score") > 0)
    return found.select(F.col("left_id").alias("user_id"), "pos", F.col("right_id").alias("item_id"), "score")


def index_top_k(index: DataFrame, items: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(user_id, pos, item_id, score): the ``k`` items with the largest sum of products of weights.

    ``index`` comes from ``impact_blocks`` of ``items`` (item_id, key_word, val); ``queries`` are rows (user_id,
    key_word, val). Items without a common word are not returned; ties go to the smaller item_id.
    """
    asked = queries.where(F.col("val") > 0).select("user_id", "key_word", F.col("val").cast("double").alias("q"))
    sizes = index.groupBy("key_word").agg(F.sum(F.size("postings")).alias("n"))
    met = lookup(asked.groupBy("key_word").agg(F.count("*").alias("users")), sizes, ["key_word"])
    read = met.agg(F.coalesce(F.sum(F.col("users") * F.col("n")), F.lit(0)).alias("rows"), F.count("*").alias("words"))
    read, users = read.first(), asked.agg(F.count_distinct("user_id")).first()[0]
    found = items.where(F.col("val") > 0).agg(F.count_distinct("item_id")).first()[0]
    if cheaper(read.rows, users, found, read.words):
        return _by_products(index, asked, k, users, found)
    needed = materialize(needed_blocks(index, queries, k), "needed-blocks")
    read = lookup(needed, index.select("key_word", "block", "postings"), ["key_word", "block"])
    found = read.select("user_id", "least", F.inline("postings")).where(F.col("val") >= F.col("least"))
    found = materialize(found.select("user_id", "item_id").distinct(), "found-items")
    weights = items.where(F.col("val") > 0).select("item_id", "key_word", F.col("val").cast("double").alias("val"))
    scored = (
        lookup(lookup(found, weights, ["item_id"]), asked, ["user_id", "key_word"])
        .groupBy("user_id", "item_id")
        .agg(F.sum(F.col("q") * F.col("val")).alias("score"))
    )
    return top_list_rows(scored, "user_id", "item_id", "score", k)
