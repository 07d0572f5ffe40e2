import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.operators.cf import (
    als_factors,
    cf_list,
    cf_recommend,
    check_lists,
    factorize,
    item_similarity,
    user_similarity,
)


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(3)
    cells = {(int(u), int(i)) for u, i in zip(rng.integers(0, 30, 250), rng.integers(0, 20, 250))}
    data = [(u, i, float(1 + (u * i) % 5)) for u, i in sorted(cells)] + [(100, 0, 0.0)]
    return spark.createDataFrame(data, "user_id long, item_id long, val double")


@pytest.fixture(scope="module")
def model(matrix):
    return factorize(matrix, rank=4, max_iter=3)


def test_factor_tables_are_wide(model):
    users, items = als_factors(model)
    assert users.columns == ["user_id", "fac_0", "fac_1", "fac_2", "fac_3"]
    assert items.columns[0] == "item_id"


def test_zero_cells_are_not_trained_on(model):
    assert als_factors(model)[0].where("user_id = 100").count() == 0


def test_lists_are_the_sorted_factor_products(model):
    users = {r[0]: np.array(r[1:]) for r in als_factors(model)[0].collect()}
    items = {r[0]: np.array(r[1:]) for r in als_factors(model)[1].collect()}
    found = {}
    for u, pos, i, score in cf_recommend(model, 5).collect():
        found.setdefault(u, {})[pos] = (i, score)
    assert set(found) == set(users)
    for u, places in found.items():
        best = sorted((float(users[u] @ v) for v in items.values()), reverse=True)[:5]
        assert sorted(places) == [1, 2, 3, 4, 5]
        assert np.allclose([places[p][1] for p in range(1, 6)], best, atol=1e-4)
        assert all(abs(float(users[u] @ items[i]) - s) < 1e-4 for i, s in places.values())


def test_array_form_has_the_same_items(model):
    flat = cf_recommend(model, 3).groupBy("user_id").agg(F.collect_set("item_id").alias("s"))
    both = flat.join(cf_list(model, 3), "user_id")
    assert both.where("size(rec_list) = 3 and size(array_except(rec_list, s)) = 0").count() == flat.count()


def test_similar_items_are_the_nearest_factors(model):
    vectors = {r[0]: np.array(r[1:]) for r in als_factors(model)[1].collect()}
    unit = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
    found = {(i, p): s for i, p, _, s in item_similarity(model, 3).collect()}
    for i in unit:
        best = sorted((float(unit[i] @ unit[j]) for j in unit if j != i), reverse=True)[:3]
        assert np.allclose([found[(i, p)] for p in (1, 2, 3)], best, atol=1e-6)
    assert user_similarity(model, 3).count() == 90


def test_implicit_training(matrix):
    assert cf_list(factorize(matrix, rank=3, max_iter=2, implicit=True), 2).count() == 30


def test_the_seed_fixes_the_result(matrix, model):
    again = factorize(matrix, rank=4, max_iter=3)
    assert rows(als_factors(again)[0]) == rows(als_factors(model)[0])


def test_ids_of_any_type_and_size(spark, matrix):
    large = matrix.selectExpr("concat('u', user_id) as user_id", "item_id + 5000000000 as item_id", "val")
    model = factorize(large, rank=3, max_iter=2)
    found = cf_recommend(model, 2)
    assert found.count() == 60 and found.where("item_id < 5000000000 or user_id not like 'u%'").count() == 0


def test_lists_do_not_follow_the_partitions(matrix):
    key = ("user_id", "pos", "item_id")
    one, two = (cf_recommend(factorize(matrix.repartition(n), rank=3, max_iter=2), 3) for n in (1, 7))
    assert rows(one, *key) == rows(two, *key)


def test_checks_hold_and_see_a_wrong_list(matrix, model):
    lists = cf_recommend(model, 4)
    good = check_lists(model, lists, matrix).collect()
    assert {tuple(r)[1:] for r in good} == {(4, 4, True, True, True)} and len(good) == 30
    wrong = lists.withColumn("score", F.col("score") * F.col("pos")).withColumn("item_id", F.lit(99))
    assert {tuple(r)[1:4] for r in check_lists(model, wrong, matrix).collect()} == {(4, 1, False)}
    assert not any(r.matching for r in check_lists(model, wrong, matrix).collect())
