import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.operators import blocks, retrieval
from recflow.session import materialize


def skewed(seed):
    """Words of very different frequency, weights of a long tail."""
    pick = random.Random(seed)
    items = {}
    for item in range(400):
        for _ in range(6):
            items[item, f"w{int(pick.paretovariate(0.6)) % 30}"] = round(pick.paretovariate(1.2), 3)
    queries = {}
    for user in range(25):
        for _ in range(4):
            queries[user, f"w{pick.randrange(30)}"] = round(pick.random() + 0.1, 3)
    return items, queries


def frames(spark, items, queries):
    items = spark.createDataFrame([(i, w, v) for (i, w), v in items.items()], "item_id long, key_word string, val double")
    queries = spark.createDataFrame([(u, w, v) for (u, w), v in queries.items()], "user_id long, key_word string, val double")
    return items, queries


@pytest.mark.parametrize("seed, size, k", [(1, 8, 5), (2, 1, 1), (3, 128, 400)])
def test_lists_are_those_of_all_items(spark, seed, size, k):
    items, queries = skewed(seed)
    scores = {}
    for (user, word), q in queries.items():
        for item in range(400):
            if (item, word) in items:
                scores[user, item] = scores.get((user, item), 0.0) + q * items[item, word]
    expected = {}
    for (user, item), s in sorted(scores.items(), key=lambda x: (x[0][0], -round(x[1], 9), x[0][1])):
        if len(expected.setdefault(user, [])) < k:
            expected[user].append(item)
    item_frame, query_frame = frames(spark, items, queries)
    index = materialize(retrieval.impact_blocks(item_frame, size), "index")
    found = {}
    for user, _, item in sorted(rows(retrieval.index_top_k(index, item_frame, query_frame, k), "user_id", "pos", "item_id"), key=lambda r: (r[0], r[1])):
        found.setdefault(user, []).append(item)
    assert found == expected


def test_light_blocks_are_skipped(spark):
    items, queries = skewed(4)
    item_frame, query_frame = frames(spark, items, queries)
    index = materialize(retrieval.impact_blocks(item_frame, 8), "index")
    every = query_frame.join(index, "key_word").count()
    assert retrieval.needed_blocks(index, query_frame, 5).count() < 0.5 * every
    largest = index.select("largest", F.array_max(F.transform("postings", lambda p: p["val"])).alias("m"))
    assert largest.where("largest <> m").count() == 0 and index.where(F.size("postings") > 8).count() == 0


def test_empty_and_zero_weights(spark):
    items, queries = frames(spark, {(1, "a"): 0.0, (2, "a"): 1.0}, {(7, "a"): 2.0, (8, "b"): 1.0, (9, "a"): 0.0})
    index = materialize(retrieval.impact_blocks(items), "index")
    assert rows(retrieval.index_top_k(index, items, queries, 3)) == [(7, 1, 2, 2.0)]
    assert retrieval.index_top_k(index, items, queries.limit(0), 3).collect() == []


def test_words_of_most_items_write_no_pairs(spark, monkeypatch):
    """Both ways give the same lists; repeated rows count as often and rows without a key not at all."""
    items, queries = skewed(5)
    items, queries = frames(spark, items, queries)
    items = items.union(items.limit(50)).union(items.limit(5).withColumn("item_id", F.lit(None).cast("long")))
    queries = queries.union(queries.limit(9)).union(queries.limit(3).withColumn("key_word", F.lit(None).cast("string")))
    items, queries = materialize(items, "items"), materialize(queries, "queries")
    index = materialize(retrieval.impact_blocks(items, 16), "index")
    monkeypatch.setattr(blocks, "MET_COST", 0)
    expected = rows(retrieval.index_top_k(index, items, queries, 6))
    monkeypatch.undo()
    monkeypatch.setattr(retrieval, "needed_blocks", None)
    found = rows(retrieval.index_top_k(index, items, queries, 6))
    assert found == expected and len(found) > 25
