import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.operators import blocks, sparse


def brute(cells, k):
    """id -> the k best (other, cosine), by all pairs."""
    vectors = {}
    for user, item, val in cells:
        if val:
            vectors.setdefault(item, {})[user] = val
    norm = {i: sum(x * x for x in v.values()) ** 0.5 for i, v in vectors.items()}
    out = {}
    for i, a in vectors.items():
        sims = []
        for j, b in vectors.items():
            dot = sum(x * b[u] for u, x in a.items() if u in b)
            if i != j and dot > 0:
                sims.append((-round(dot / norm[i] / norm[j], 10), j))
        out[i] = [(j, -s) for s, j in sorted(sims)[:k]]
    return {i: v for i, v in out.items() if v}


def skewed(seed, negative=False):
    """Users of very different activity; some act on nearly everything."""
    pick = random.Random(seed)
    cells = {}
    for user in range(60):
        for _ in range(90 if user < 3 else pick.randint(1, 8)):
            value = pick.choice([1.0, 2.0, 5.0])
            cells[user, pick.randrange(100)] = -value if negative and pick.random() < 0.2 else value
    return [(u, i, v) for (u, i), v in cells.items()]


@pytest.mark.parametrize("seed, few, negative", [(1, 4, False), (2, 64, False), (3, 4, True), (4, 0, False)])
def test_neighbours_equal_all_pairs(spark, seed, few, negative):
    """Recall is 1, whatever sets the floors."""
    cells = skewed(seed, negative)
    frame = spark.createDataFrame(cells, "user_id long, item_id long, val double").repartition(3)
    found = {}
    for i, _, j, s in sorted(rows(sparse.action_neighbours(frame, 5, few=few)), key=lambda r: (r[0], r[1])):
        found.setdefault(i, []).append((j, s))
    expected = brute(cells, 5)
    assert {i: [j for j, _ in v] for i, v in found.items()} == {i: [j for j, _ in v] for i, v in expected.items()}
    assert all(abs(x[1] - y[1]) < 1e-5 for i in found for x, y in zip(found[i], expected[i]))


def test_popular_users_are_left_out(spark):
    """Clustered items with their own users find each other without the users of everything."""
    cells = [(1000 + g * 10 + u, g * 5 + i, 1.0) for g in range(40) for u in range(10) for i in range(5)]
    cells += [(u, i, 1.0) for u in range(3) for i in range(200)]
    frame = spark.createDataFrame(cells, "user_id long, item_id long, val double")
    units = sparse.unit_cells(frame, "item_id", "user_id")
    kept = sparse.prefixes(units, sparse.floors(units, 4))
    assert kept.where("dim < 1000").count() == 0
    assert sparse.candidates(units, 4).count() == 200 * 4
    assert sparse.action_neighbours(frame, 4).where("sim < 0.99").count() == 0


def test_nulls_zeros_and_empty(spark):
    schema = "user_id string, item_id string, val double"
    cells = [("a", "x", 1.0), ("a", "y", 0.0), ("a", "z", None), ("b", "x", float("nan")), ("a", "w", 2.0)]
    frame = spark.createDataFrame(cells, schema)
    assert rows(sparse.action_neighbours(frame, 3)) == [("w", 1, "x", 1.0), ("x", 1, "w", 1.0)]
    assert sparse.action_neighbours(spark.createDataFrame([], schema), 3).collect() == []
    users = sparse.action_neighbours(frame.withColumn("val", F.lit(1.0)), 3, "user_id", "item_id")
    assert rows(users)[0][2] == "b"


def test_few_columns_of_many_rows_meet_in_blocks(spark, monkeypatch):
    """Every second pair shares a column, so no pair is written; cells of one place count together."""
    pick = random.Random(6)
    cells = [(f"u{user:03}", f"i{pick.randrange(8)}", float(pick.randint(1, 9))) for user in range(120) for _ in range(4)]
    frame = spark.createDataFrame(cells, "user_id string, item_id string, val double")
    joined = sparse.action_neighbours(frame, 4, "user_id", "item_id", few=8)
    monkeypatch.setattr(blocks, "MET_COST", 0)
    expected = rows(sparse.action_neighbours(frame, 4, "user_id", "item_id", few=8))
    monkeypatch.undo()
    monkeypatch.setattr(sparse, "candidates", None)
    assert rows(joined) == expected and len(expected) == 120 * 4
    assert rows(sparse.action_neighbours(frame, 4, "user_id", "item_id", few=8)) == expected
