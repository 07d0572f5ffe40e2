from datetime import date

import pytest
from conftest import rows

from recflow.operators.analysis import analyze_items, analyze_users
from recflow.operators.evaluate import evaluate, mean_average_precision, user_coverage

DAY = "2024-01-02"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "id long, category string")


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(
        [
            (1, 1, "list_based", 1),
            (1, 1, "list_based", 1),  # shown twice, counts once
            (1, 2, "list_based", 2),
            (2, 1, "list_based", 1),
            (2, 3, "cf_based", 1),
            (9, 3, "other", 1),
        ],
        "user_id long, item_id long, rec_algo string, pos int",
    )


@pytest.fixture(scope="module")
def actions(spark):
    return spark.createDataFrame(
        [(1, 1), (1, 1), (2, 2), (3, 1), (1, 3)], "user_id long, item_id long"
    )


def test_precision_and_recall_match_users_and_items(feed, actions, items):
    result = {(c, a): (p, r, f) for c, a, p, r, f, _ in rows(evaluate(feed, actions, items, DAY))}
    assert len(result) == 9
    # shown (1,1) (1,2) (2,1), acted on (1,1) (2,2) (3,1)
    assert result[("a", "list_based")] == (round(1 / 3, 6), round(1 / 3, 6), round(1 / 3, 6))
    # shown to user 2, acted on by user 1: no hit, and f1 of 0 and 0 is not defined
    assert result[("b", "cf_based")] == (0.0, 0.0, None)


def test_ratios_over_nothing_are_null(feed, actions, items):
    result = {(c, a): (p, r, f) for c, a, p, r, f, _ in rows(evaluate(feed, actions, items, DAY))}
    assert result[("a", "content_based")] == (None, 0.0, None)
    assert result[("c", "list_based")] == (None, None, None)


def test_mean_average_precision(spark):
    feed = spark.createDataFrame(
        [(1, i, "cf_based", p) for p, i in enumerate([5, 6, 7, 8], 1)]
        + [(2, 5, "cf_based", 1), (2, 6, "cf_based", 2), (3, 5, "cf_based", 1)],
        "user_id long, item_id long, rec_algo string, pos int",
    )
    actions = spark.createDataFrame([(1, 5), (1, 7), (1, 8), (2, 6)], "user_id long, item_id long")
    # user 1: (1/1 + 2/3) / 3, user 2: (1/2) / 1; user 3 did nothing
    expected = ((1 + 2 / 3) / 3 + 0.5) / 2
    assert rows(mean_average_precision(feed, actions, 3)) == [("cf_based", round(expected, 6), 2)]


def test_user_coverage_counts_known_users(spark, feed):
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "uid long")
    assert rows(user_coverage(feed, users)) == [
        ("cf_based", 1, 4, 0.25),
        ("list_based", 2, 4, 0.5),
    ]


def test_activity(spark):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    events = spark.createDataFrame(
        [(1, 7, "view", d1), (1, 7, "view", d1), (1, 8, "click", d2), (1, 8, "error", d2)],
        "user_id long, item_id long, event_type string, day date",
    )
    scores = spark.createDataFrame([(1, 5.0), (2, 0.0)], "user_id long, score double")
    users = rows(analyze_users(scores, events, event_types=("view", "click")))
    assert users == [(1, 5.0, 4, 2, d1, d2, 0.5, 0.25), (2, 0.0, 0, 0, None, None, None, None)]
    items = spark.createDataFrame([(8, 1.0)], "item_id long, score double")
    assert rows(analyze_items(items, events), "events", "active_days", "share_click") == [(2, 1, 0.5)]


def test_shown_rows_are_moved_before_they_are_made_distinct(spark, feed, actions, items):
    """Made distinct first, all rows that a task shows were held in its memory."""
    shown = evaluate(feed, actions, items, DAY)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in shown.splitlines() if "REPARTITION_BY_COL" in line]
    assert moved and all("user_id" in line and "item_id" in line and "rec_algo" not in line for line in moved)
