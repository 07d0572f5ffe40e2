import os
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.operators.interactions import decayed_score
from recflow.operators.similarity import PRODUCT_BLEND
from recflow.plans import daily
from recflow.plans.testdata import RUN_DATE, Shop


@pytest.fixture
def store(spark, tmp_path):
    return daily.Store(spark, str(tmp_path))


def test_a_missed_day_is_caught_up(spark, store):
    start = date(2024, 1, 1)
    events = spark.range(200).select(
        (F.col("id") % 5).alias("user_id"),
        (F.col("id") % 7).alias("item_id"),
        F.when(F.col("id") % 3 > 0, "click").otherwise("view").alias("event_type"),
        F.date_add(F.lit(start), (F.col("id") % 6).cast("int")).alias("day"),
    )
    for day in (0, 1, 4, 5, 5):  # two days missed, the last one run twice
        today = (start + timedelta(days=day)).isoformat()
        known = events.where(F.col("day") <= F.lit(today).cast("date"))
        items, actions = daily.update_scores(store, known, today)
        assert rows(items, "item_id", "score") == rows(decayed_score(known, ["item_id"], today))
        assert rows(actions, "user_id", "item_id", "val") == rows(
            decayed_score(known, ["user_id", "item_id"], today, value="val")
        )


def test_late_events_count_when_their_day_is_computed_anew(spark, store):
    rows_of = lambda late: spark.createDataFrame(
        [(1, 7, "view", date(2024, 1, d)) for d in (1, 2, 3)] + [(2, 7, "purchase", date(2024, 1, 2))] * late,
        "user_id long, item_id long, event_type string, day date",
    )
    for day in ("2024-01-01", "2024-01-02"):
        daily.update_scores(store, rows_of(0), day)
    for since, late in ((None, 0), ("2024-01-02", 1)):
        items, _ = daily.update_scores(store, rows_of(1), "2024-01-03", since)
        assert rows(items, "item_id", "score") == rows(decayed_score(rows_of(late), ["item_id"], "2024-01-03"))


def test_the_whole_day(spark, store, data):
    scratch = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(scratch))
    shop = Shop(spark, data)
    items = shop.products().join(shop.product_places(), "id").withColumn("district", F.lit(None).cast("string"))
    users = shop.users().withColumn("district", F.lit(None).cast("string"))
    daily.update_scores(store, shop.events(), RUN_DATE)
    lists = daily.build_lists(store, items, RUN_DATE)
    assert lists["ranked_items"].count() == items.count()
    assert lists["item_hot_list"].join(lists["item_fresh_list"], "item_id").count() == 0
    daily.build_text(store, "product", items, ["name", "description"], RUN_DATE)
    best = daily.build_content_lists(
        store,
        "product",
        users,
        items,
        PRODUCT_BLEND,
        {"text": "product"},
        5,
        RUN_DATE,
        user_tags=shop.user_product_tags(),
        item_tags=shop.product_tags(),
    )
    assert best.count() == 5 * users.count()
    shown = daily.build_cf_lists(store, "product", items, 3, RUN_DATE, rank=3, max_iter=2)
    assert shown.groupBy("user_id").count().where("count <> 3").count() == 0
    assert "fac_2" in store.read("product_user_factors", RUN_DATE).columns
    feed = shown.withColumn("rec_algo", F.lit("cf_based"))
    result = daily.evaluate_day(store, feed, shop.events(), items, RUN_DATE)
    assert result.count() == 3 * items.select("category").distinct().count()
    assert result.where("precision > 1 or recall > 1").count() == 0
    assert best.where("sim < 0 or sim > 1").count() == 0
    assert set(os.listdir(scratch)) == before
