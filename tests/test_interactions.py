from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.operators import interactions
from recflow.operators.interactions import (
    action_matrix,
    day_score,
    decayed_score,
    item_score,
    matrix_cells,
    update_score,
    user_level,
    user_score,
    weight_events,
)
from recflow.sources import event_weights

DAY1, DAY2 = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture(scope="module")
def events(spark):
    data = [
        (1, 1, 1, "view", DAY1),
        (2, 1, 1, "purchase", DAY1),
        (3, 1, 2, "click", DAY2),
        (4, 2, 1, "view", DAY2),
        (5, 2, 3, "error", DAY2),
        (6, 2, 2, "long_view", DAY2),
        (7, 1, 1, "search_click", DAY2),
        (8, 2, 1, None, DAY2),
    ]
    return spark.createDataFrame(
        data, "event_id long, user_id long, item_id long, event_type string, day date"
    )


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b")], "id long, category string")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(1,), (2,), (3,)], "uid long")


def test_unknown_event_types_weigh_nothing(events):
    weights = dict(rows(weight_events(events), "event_id", "weight"))
    assert weights == {1: 1.0, 2: 30.0, 3: 4.0, 4: 1.0, 5: 0.0, 6: 7.0, 7: 10.0, 8: 0.0}


def test_weights_may_be_a_table(spark, events):
    table = event_weights(spark, {"error": 2.0})
    assert rows(weight_events(events, table).where("weight > 0"), "event_id", "weight") == [(5, 2.0)]


def test_older_events_decay(events):
    scores = rows(decayed_score(events, ["item_id"], "2024-01-02"))
    assert scores == [(1, round(31 * 0.9 + 11, 6)), (2, 11.0)]


def test_events_after_the_run_date_do_not_count(events):
    assert rows(decayed_score(events, ["item_id"], "2024-01-01")) == [(1, 31.0)]


def test_every_item_and_user_gets_a_score(users, items, events):
    assert rows(item_score(items, events, "2024-01-02"), "item_id", "score") == [
        (1, 38.9),
        (2, 11.0),
        (3, 0.0),
        (4, 0.0),
    ]
    assert rows(user_score(users, events, "2024-01-02"), "user_id", "score") == [
        (1, round(31 * 0.9 + 14, 6)),
        (2, 8.0),
        (3, 0.0),
    ]


def test_without_decay_scores_add_up(users, events):
    scores = dict(rows(user_score(users, events, "2024-01-02", gamma=1.0), "user_id", "score"))
    assert scores == {1: 45.0, 2: 8.0, 3: 0.0}


def test_daily_updates_equal_the_closed_form(events):
    keys = ["user_id", "item_id"]
    first = day_score(events, keys, "2024-01-01")
    second = update_score(first, day_score(events, keys, "2024-01-02"), keys)
    assert rows(second) == rows(decayed_score(events, keys, "2024-01-02"))


def test_an_update_may_skip_days(events):
    first = day_score(events, ["item_id"], "2024-01-01")
    nothing = first.where(F.lit(False))
    later = update_score(first, nothing, ["item_id"], days=3)
    assert rows(later) == [(1, round(31 * 0.9**3, 6))]


def test_action_matrix_keeps_the_category(users, items, events):
    cells = action_matrix(events, items, "2024-01-02", "a", users=users)
    assert rows(cells, "user_id", "item_id", "val") == [
        (1, 1, round(31 * 0.9 + 10, 6)),
        (1, 2, 4.0),
        (2, 1, 1.0),
        (2, 2, 7.0),
    ]
    assert rows(action_matrix(events, items, "2024-01-02", "b")) == []


def test_absent_cells_are_zero(spark, items, events):
    pairs = spark.createDataFrame([(1, 1), (3, 4)], "user_id long, item_id long")
    cells = matrix_cells(pairs, action_matrix(events, items, "2024-01-02"))
    assert rows(cells, "user_id", "item_id", "val") == [(1, 1, 37.9), (3, 4, 0.0)]


@pytest.mark.parametrize("n", [1, 3, 4, 10, 11])
def test_levels_are_those_of_ntile(spark, n):
    scores = spark.range(n).select(F.col("id").alias("user_id"), (F.col("id") % 3).cast("double").alias("score"))
    scores.createOrReplaceTempView("level_scores")
    expected = spark.sql(
        "select user_id, ntile(4) over (order by score, user_id) as level from level_scores"
    )
    assert rows(user_level(scores), "user_id", "level") == rows(expected)


def test_levels_by_threshold(spark):
    scores = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 9.9), (4, 50.0)], "user_id long, score double")
    levels = dict(rows(user_level(scores, [5.0, 10.0]), "user_id", "level"))
    assert levels == {1: 1, 2: 2, 3: 2, 4: 3}


def test_late_events_count_from_the_day_they_arrive(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05"]
    rows = [(i, d, a) for i in range(3) for d in days for a in ["2024-01-02", "2024-01-04", "2024-01-06", "2024-01-09", None]]
    events = spark.createDataFrame([(i, "buy" if i else "click", d, a) for i, d, a in rows], "item_id int, event_type string, day string, arrived string")
    events = events.withColumn("day", F.to_date("day"))
    weights = {"buy": 5.0, "click": 1.0}
    known = F.greatest(F.to_date("arrived"), F.col("day"))

    def whole(day):
        return interactions.decayed_score(events.where(known <= F.lit(day).cast("date")), ["item_id"], day, 0.5, weights)

    now = whole("2024-01-02")
    for before, day in (("2024-01-02", "2024-01-03"), ("2024-01-03", "2024-01-07"), ("2024-01-07", "2024-01-10")):
        now = interactions.catch_up(now, events, ["item_id"], before, day, 0.5, weights)
        got, expected = ({r.item_id: round(r.score, 9) for r in f.collect()} for f in (now, whole(day)))
        assert got == expected and len(got) == 3
