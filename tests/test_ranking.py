import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.operators.ranking import (
    bottom_m,
    fresh_list,
    hot_list,
    quantiles,
    rank_items,
    rank_within,
    ranked_list,
    top_n,
    top_per_group,
)


@pytest.fixture(scope="module")
def shop(spark):
    """Category a: 400 items, many tied; category b: 5 items."""
    items = spark.range(405).select(
        "id", F.when(F.col("id") < 400, "a").otherwise("b").alias("category")
    )
    scores = items.where("id % 10 <> 7").select(
        F.col("id").alias("item_id"), (F.col("id") % 40).cast("double").alias("score")
    )
    return items, scores


def window_ranks(spark, items, scores):
    items.createOrReplaceTempView("shop_items")
    scores.createOrReplaceTempView("shop_scores")
    return spark.sql(
        "select id as item_id, category, coalesce(score, 0D) as score, row_number() over "
        "(partition by category order by coalesce(score, 0D) desc, id) as rn "
        "from shop_items left join shop_scores on id = item_id"
    )


def test_ranks_match_a_window(spark, shop):
    ranked = rank_items(shop[1], shop[0], "2024-01-02")
    expected = window_ranks(spark, *shop)
    assert rows(ranked, "item_id", "category", "score", "rn") == rows(expected)


def test_unscored_items_are_ranked_last_with_zero(spark, shop):
    ranked = rank_items(shop[1], shop[0], "2024-01-02")
    assert ranked.where("item_id = 17").first()["score"] == 0.0
    assert ranked.count() == 405


def test_ranks_without_groups_number_all_rows(spark):
    df = spark.range(1000).select((-F.col("id")).alias("v"))
    assert rank_within(df, [], ["v"]).where("rn <> v + 1000").count() == 0


def test_ranks_of_no_rows(spark):
    empty = spark.range(5).where("id > 9").withColumn("g", F.lit("a"))
    assert rank_within(empty, ["g"], ["id"]).collect() == []
    assert rank_within(empty, [], ["id"]).collect() == []


def test_ranks_of_many_groups_and_null_groups(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("g"))
    df.createOrReplaceTempView("grouped")
    expected = spark.sql("select id, g, row_number() over (partition by g order by id desc) as rn from grouped")
    assert rows(rank_within(df, ["g"], [F.col("id").desc()])) == rows(expected)


def test_fresh_and_hot_do_not_overlap(spark, shop):
    ranked = rank_items(shop[1], shop[0], "2024-01-02")
    fresh = fresh_list(ranked, 38.5)
    hot = hot_list(ranked, fresh, 30)
    assert not set(rows(fresh, "item_id")) & set(rows(hot, "item_id"))
    # 10 items score 39, the rest of the first 30 counts as fresh
    assert hot.count() == 10
    assert hot.where("category = 'b'").count() == 0


def test_hot_list_is_cut_by_rank(shop):
    ranked = rank_items(shop[1], shop[0], "2024-01-02")
    assert hot_list(ranked, fresh_list(ranked), 30).count() == 30


def test_top_n_of_scored_and_ranked_rows(spark, shop):
    ranked = rank_items(shop[1], shop[0], "2024-01-02")
    expected = window_ranks(spark, *shop)
    best = rows(top_n(expected.drop("rn"), 80), "item_id", "rn")
    assert best == rows(top_n(ranked, 80), "item_id", "rn") == rows(expected.where("rn <= 80"), "item_id", "rn")


@pytest.mark.parametrize("m", [3, 200, 401])
def test_bottom_m_has_exactly_m_or_the_whole_category(spark, shop, m):
    ranked = rank_items(shop[1], shop[0], "2024-01-02")
    expected = window_ranks(spark, *shop)
    sizes = {"a": 400, "b": 5}
    last = sorted(
        (i, rn) for i, c, rn in rows(expected, "item_id", "category", "rn") if rn > sizes[c] - m
    )
    assert len(last) == min(m, 400) + min(m, 5)
    assert sorted(rows(bottom_m(ranked, m), "item_id", "rn")) == last
    assert sorted(rows(bottom_m(expected.drop("rn"), m), "item_id", "rn")) == last


def test_a_large_k_takes_the_distributed_ranking(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("g"))
    top = top_per_group(df, ["g"], ["id"], 1200)
    assert top.count() == 2400
    assert top.agg(F.max("id")).first()[0] == 2399


def test_ranked_list_is_one_ordered_row_per_user(spark):
    sims = spark.createDataFrame(
        [(1, 10, 0.5), (1, 11, 0.9), (1, 12, 0.5), (1, 13, 0.1), (2, 10, 0.0)],
        "user_id long, item_id long, sim double",
    )
    lists = {u: items for u, items in ranked_list(sims, "user_id", "item_id", "sim", 3).collect()}
    assert lists == {1: [11, 10, 12], 2: [10]}


def test_quantiles_are_exact(spark):
    df = spark.range(1, 101).select("id", F.col("id").cast("double").alias("v"))
    found = dict(rows(quantiles(df, "v", "id", [0.0, 0.25, 0.5, 1.0])))
    assert found == {0.0: 1.0, 0.25: 25.0, 0.5: 50.0, 1.0: 100.0}


def test_tiny_scores_keep_their_order_and_equal_sums_tie(spark):
    scores = [(0, 0.0), (1, 1e-17), (2, 2.8e-17), (3, 0.1 + 0.2), (4, 0.3), (5, -1e-17), (6, 1e-300), (7, 3e300)]
    frame = spark.createDataFrame(scores, "item_id long, score double")
    items = frame.select(F.col("item_id").alias("id"), F.lit("a").alias("category"))
    ranked = rank_items(frame, items, "2024-01-30").orderBy("rn")
    assert [r.item_id for r in ranked.collect()] == [7, 3, 4, 2, 1, 6, 0, 5]
    best = top_n(ranked.drop("rn"), 3).orderBy("rn")
    assert [r.item_id for r in best.collect()] == [7, 3, 4]
