import itertools
import re
import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.functions import cosine_dense, geo_weights
from recflow.operators import blocks, similarity
from recflow.operators.features import geo_feature, tag_feature, tag_presence
from recflow.operators.matrix import sparse_matmul
from recflow.operators.similarity import (
    POST_BLEND,
    PRODUCT_BLEND,
    Blend,
    blend,
    blended_similarity,
    content_based_recommend,
    geo_similarity,
    neighbourhood_recommend,
    pair_cosine,
    profiles,
    tag_neighbours,
    tag_similarity,
    text_similarity,
    vector_neighbours,
)
from recflow.session import CLEANUP, materialize

PLACE = "province string, city string, district string"


@pytest.fixture(scope="module")
def places(spark):
    users = spark.createDataFrame(
        [(1, "P", "C", "D"), (2, "P", "C", None), (3, None, None, None)], f"user_id long, {PLACE}"
    )
    items = spark.createDataFrame(
        [(10, "P", "C", "D"), (11, "Q", "C", None), (12, "P", "X", "Y")], f"item_id long, {PLACE}"
    )
    return users, items


@pytest.fixture(scope="module")
def tags(spark):
    users = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 2), (2, 3), (2, 4)], "user_id long, tag_id long"
    )
    items = spark.createDataFrame(
        [(10, 1), (10, 2), (11, 3), (11, 4), (12, 2), (12, 3)], "item_id long, tag_id long"
    )
    return tag_feature(users, "user_id", "d"), tag_feature(items, "item_id", "d")


@pytest.fixture(scope="module")
def words(spark):
    users = spark.createDataFrame(
        [(1, "a", 3.0), (1, "b", 4.0), (2, "c", 1.0)], "user_id long, key_word string, val double"
    )
    items = spark.createDataFrame(
        [(10, "a", 1.0), (11, "b", 2.0), (11, "c", 0.0), (12, "c", 5.0)],
        "item_id long, key_word string, val double",
    )
    return users, items


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(
        list(itertools.product([1, 2, 3], [10, 11, 12])), "user_id long, item_id long"
    )


def cells(df):
    return {(u, i): s for u, i, s in rows(df, "user_id", "item_id", "sim")}


def test_level_weights():
    assert geo_weights(3) == [1 / 7, 2 / 7, 4 / 7]


def test_geo_levels_are_compared_one_by_one(pairs, places):
    sims = cells(geo_similarity(pairs, *places))
    assert sims[(1, 10)] == 1.0
    assert sims[(1, 11)] == round(2 / 7, 6)  # same city name elsewhere
    assert sims[(2, 10)] == round(3 / 7, 6)
    assert sims[(2, 11)] == round(2 / 7, 6)  # two missing districts are no match
    assert sims[(3, 10)] == 0.0


def test_tags_are_matched_on_the_tag(pairs, tags):
    sims = cells(tag_similarity(pairs, *tags, n_tags=4))
    assert sims[(1, 10)] == 0.5
    assert sims[(1, 11)] == 0.0  # disjoint
    assert sims[(1, 12)] == 0.25
    assert sims[(3, 10)] == 0.0


def test_repeated_tags_count_once(tags):
    assert rows(tags[0], "user_id", "tag_id", "has") == [(1, 1, 1), (1, 2, 1), (2, 3, 1), (2, 4, 1)]


def test_tag_presence_is_zero_or_one(spark, tags):
    asked = spark.createDataFrame([(1, 1), (1, 4)], "user_id long, tag_id long")
    assert rows(tag_presence(asked, tags[0], "user_id"), "tag_id", "has") == [(1, 1), (4, 0)]


def test_tags_outside_the_dimension_are_left_out(spark):
    raw = spark.createDataFrame([(1, 1), (1, 9)], "user_id long, tag_id long")
    dimension = spark.createDataFrame([(1,)], "tag_id long")
    assert rows(tag_feature(raw, "user_id", "d", dimension), "tag_id") == [(1,)]


def test_text_cosine(pairs, words):
    sims = cells(text_similarity(pairs, *words))
    assert sims[(1, 10)] == 0.6
    assert sims[(1, 11)] == 0.8
    assert sims[(1, 12)] == 0.0
    assert sims[(2, 12)] == 1.0
    assert sims[(3, 10)] == 0.0


def test_dense_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(cosine_dense(F.col("a"), F.col("b"))).collect()] == [0.96, None]


def test_blend_counts_missing_parts_as_zero(spark, pairs, places, tags):
    geo = geo_similarity(pairs, *places)
    tag = tag_similarity(pairs, *tags, n_tags=4).where("sim > 0")
    sims = cells(blend([(geo, 5.0), (tag, 3.0)]))
    assert sims[(1, 10)] == round((5 + 3 * 0.5) / 8, 6)
    assert sims[(1, 11)] == round(5 * 2 / 7 / 8, 6)


def shop_profiles(spark, places, tags, words):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    items = spark.createDataFrame([(10,), (11,), (12,)], "item_id long")
    return (
        profiles(users, "user_id", places[0], tags[0], {"text": words[0]}),
        profiles(items, "item_id", places[1], tags[1], {"text": words[1]}),
    )


def test_blend_weights_are_fixed():
    assert (PRODUCT_BLEND.geo, PRODUCT_BLEND.tag, PRODUCT_BLEND.text) == (5.0, 3.0, (("text", 1.0),))
    assert (POST_BLEND.tag, dict(POST_BLEND.text), POST_BLEND.total) == (3.0, {"title": 4.0, "content": 7.0}, 14.0)


def test_profiles_give_the_same_as_the_parts(spark, pairs, places, tags, words):
    users, items = shop_profiles(spark, places, tags, words)
    whole = cells(blended_similarity(pairs, users, items, PRODUCT_BLEND, 4))
    parts = cells(
        blend(
            [
                (geo_similarity(pairs, *places), 5.0),
                (tag_similarity(pairs, *tags, n_tags=4), 3.0),
                (text_similarity(pairs, *words), 1.0),
            ]
        )
    )
    assert whole == parts


def test_lists_hold_the_best_of_all_pairs(spark, pairs, places, tags, words):
    users, items = shop_profiles(spark, places, tags, words)
    sims = cells(blended_similarity(pairs, users, items, PRODUCT_BLEND, 4))
    lists = content_based_recommend(users, items, PRODUCT_BLEND, 4, 2)
    expected = []
    for user in (1, 2, 3):
        best = sorted((10, 11, 12), key=lambda i: (-sims[(user, i)], i))[:2]
        expected += [(user, pos + 1, i, sims[(user, i)]) for pos, i in enumerate(best)]
    assert rows(lists, "user_id", "pos", "item_id", "sim") == sorted(expected)


def test_a_single_text_part(spark, pairs, words):
    users = profiles(spark.range(1, 4).withColumnRenamed("id", "user_id"), "user_id", text={"t": words[0]})
    items = profiles(
        spark.range(10, 13).withColumnRenamed("id", "item_id"), "item_id", text={"t": words[1]}
    )
    weights = Blend(text=(("t", 2.0),))
    lists = content_based_recommend(users, items, weights, 0, 3)
    assert cells(lists) == cells(text_similarity(pairs, *words))


def test_matmul_is_the_matrix_product(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 3, (6, 5)), rng.integers(0, 3, (5, 4))

    def long(m, r, c):
        data = [(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]
        return spark.createDataFrame(data, f"{r} long, {c} long, val double")

    product = sparse_matmul(long(a, "r", "k"), long(b, "k", "c"), "r", "k", "c")
    expected = {(i, j): float(v) for (i, j), v in np.ndenumerate(a @ b) if v}
    assert {(r, c): v for r, c, v in rows(product, "r", "c", "val")} == expected


def test_matmul_with_a_wide_right_side(spark):
    a = spark.createDataFrame([(1, 1, 2.0), (2, 1, 3.0)], "r long, k long, val double")
    b = spark.range(12_000).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("c"), F.lit(1.0).alias("val"))
    product = sparse_matmul(a, b, "r", "k", "c", packed_cells=100)
    assert rows(product.groupBy("r", "val").count()) == [(1, 2.0, 12_000), (2, 3.0, 12_000)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "MAX_BLOCK_ROWS", 16)
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 4)
    monkeypatch.setattr(blocks, "LEFT_ROWS", 5)
    monkeypatch.setattr(blocks, "RIGHT_ROWS", 4)
    monkeypatch.setattr(blocks, "FIRST_ROWS", 3)


def test_neighbours_over_many_blocks_equal_brute_force(spark, small_blocks):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-2, 3, (60, 4)).astype(float)
    vectors[7] = 0
    vectors[20:30] = vectors[3]  # copies: ties go to the smaller id
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vec array<double>")
    found = {(i, p): (n, s) for i, p, n, s in rows(vector_neighbours(df, "id", "vec", 5))}
    norms = np.linalg.norm(vectors, axis=1)
    alive = [i for i in range(60) if norms[i] > 0]
    assert len(found) == 5 * len(alive)
    for i in alive:
        sims = {j: round(float(vectors[i] @ vectors[j] / norms[i] / norms[j]), 9) for j in alive if j != i}
        best = sorted(sims, key=lambda j: (-sims[j], j))[:5]
        assert [found[(i, p + 1)][0] for p in range(5)] == best


def test_sparse_matches_with_one_feature_shared_by_all(spark, small_blocks):
    """A feature every row has: the case in which an inverted join writes all pairs."""
    rng = np.random.default_rng(2)
    entity_tags = [(i, 0) for i in range(50)] + [(i, int(t)) for i in range(40) for t in rng.integers(1, 9, 3)]
    df = spark.createDataFrame(entity_tags, "user_id long, tag_id long")
    sets = {}
    for i, t in entity_tags:
        sets.setdefault(i, set()).add(t)
    found = {(i, p): n for i, p, n, _ in rows(tag_neighbours(df, "user_id", 4))}
    for i in sets:
        sims = {
            j: round(len(sets[i] & sets[j]) / (len(sets[i]) * len(sets[j])) ** 0.5, 9) for j in sets if j != i
        }
        best = sorted(sims, key=lambda j: (-sims[j], j))[:4]
        assert [found[(i, p + 1)] for p in range(4)] == best


def test_pair_cosine_by_hand(spark):
    matrix = spark.createDataFrame(
        [(1, 1, 3.0), (2, 1, 4.0), (1, 2, 1.0), (3, 3, 1.0)], "user_id long, item_id long, val double"
    )
    pairs = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (1, 9), (1, 1)], "id long, other_id long")
    found = {(a, b): s for a, b, s in rows(pair_cosine(pairs, matrix))}
    assert found == {(1, 2): 0.6, (2, 1): 0.6, (1, 3): 0.0, (1, 9): 0.0, (1, 1): 1.0}
    swapped = pair_cosine(pairs.limit(1), matrix, "user_id", "item_id")
    assert rows(swapped) == [(1, 2, round(3 / 10**0.5, 6))]


def test_neighbourhood_list(spark):
    matrix = spark.createDataFrame([(1, 1, 2.0), (1, 2, 1.0), (2, 2, 1.0)], "user_id long, item_id long, val double")
    near = spark.createDataFrame(
        [(1, 3, 0.5), (1, 2, 0.9), (2, 3, 0.4), (2, 4, 0.4)], "id long, neighbour_id long, sim double"
    )
    assert rows(neighbourhood_recommend(matrix, near, 2)) == [
        (1, 1, 2, 1.8),
        (1, 2, 3, 1.4),
        (2, 1, 3, 0.4),
        (2, 2, 4, 0.4),
    ]


def test_products_of_a_task_do_not_grow_with_the_cells(spark, monkeypatch):
    """Products were summed where the cells lie, in as few tasks as the size of the cells asks for."""
    monkeypatch.setattr(similarity, "MAX_TASK_PRODUCTS", 10)
    matrix = spark.range(60).select((F.col("id") % 20).alias("user_id"), (F.col("id") % 3).alias("item_id"), F.lit(1.0).alias("val"))
    near = spark.range(6).select((F.col("id") % 3).alias("id"), (F.col("id") + 10).alias("neighbour_id"), F.lit(0.5).alias("sim"))
    lists = neighbourhood_recommend(matrix, near, 2)
    shown = lists._jdf.queryExecution().executedPlan().toString()
    # 60 cells with 2 neighbours each
    moved = shown.index("REPARTITION_BY_NUM")
    assert re.search(r"hashpartitioning\(user_id#\d+L?, item_id#\d+L?, 12\), REPARTITION_BY_NUM", shown)
    assert "partial_sum" in shown[:moved] and "partial_sum" not in shown[moved:]
    assert lists.count() == 40


def test_tasks_hold_no_more_rows_of_the_right_side_than_allowed(spark, monkeypatch):
    """Seven blocks of 50 rows in pairs were 14 or 15 rows a task, where 10 are allowed."""
    monkeypatch.setattr(blocks, "MAX_BLOCK_ROWS", 10)
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 2)
    monkeypatch.setattr(blocks, "FINE_BLOCKS", 7)
    vectors = spark.range(50).select("id", F.array(F.sin("id"), F.cos("id")).alias("vec"))
    met = blocks.Matching(vectors, vectors, 2, True, 50, 50)
    group = F.floor(F.col("rb") / met.per_group)
    assert max(r["count"] for r in met.right.groupBy(group).count().collect()) <= 10


def test_geo_feature_projects_the_levels(spark):
    users = spark.createDataFrame([(1, "p", "c", "d", "x")], f"uid long, {PLACE}, role string")
    assert rows(geo_feature(users, "uid", "user_id", "2024-01-02")) == [(1, "p", "c", "d", "2024-01-02")]


def test_wide_features_stay_within_the_byte_budget():
    rng = np.random.default_rng(5)
    rows, width = 4096, 20_000
    ids = np.arange(rows)
    dims = [rng.integers(0, width, 20, dtype=np.int64) for _ in ids]
    block = pd.DataFrame({"id": ids, "dims": [np.unique(d) for d in dims]})
    block["vals"] = [np.full(len(d), 0.5) for d in block["dims"]]
    tracemalloc.start()
    found = blocks._match_blocks(block, block, 3, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    sets = [set(d.tolist()) for d in block["dims"]]
    for i in (0, 1234, rows - 1):
        shared = np.array([len(sets[i] & s) if j != i else -1 for j, s in enumerate(sets)])
        best = sorted(ids, key=lambda j: (-shared[j], j))[:3]
        own = found[found["left_id"] == i].sort_values(["score", "right_id"], ascending=[False, True])
        assert own["right_id"].tolist()[:3] == best


def test_large_scores_and_more_pairs_than_tasks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MAX_TASKS", 3)
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 4)
    left = spark.range(20).select("id", F.array(F.col("id") * 1e9, F.lit(1.0)).alias("vec"))
    right = spark.range(15).select("id", F.array(F.col("id") * 1e6, F.lit(1.0)).alias("vec"))
    found = blocks.best_matches(left, right, 2).collect()
    assert len(found) == 40
    assert {(r.left_id, r.pos): r.right_id for r in found if r.left_id} == {
        (i, p): 15 - p for i in range(1, 20) for p in (1, 2)
    }
    assert [r.right_id for r in sorted(found, key=lambda r: (r.left_id, r.pos))[:2]] == [0, 1]


def test_vectors_with_nan_have_no_neighbours(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [nan, 1.0]), (2, [0.9, 0.1]), (3, [float("inf"), 0.0]), (4, [0.0, 0.0]), (5, [0.5, 0.5])]
    found = blocks.nearest(spark.createDataFrame(rows, "id long, vec array<double>"), "id", "vec", 3).collect()
    assert {r.id for r in found} | {r.neighbour_id for r in found} == {0, 2, 5}


def best_by_hand(left, right, k):
    scores = left @ right.T
    return {i: np.lexsort((np.arange(len(right)), -np.round(scores[i], 9)))[:k].tolist() for i in range(len(left))}


def matched(left, right, k, columns):
    found = {}
    for r in sorted(blocks.best_matches(left, right, k).select(*columns).collect()):
        found.setdefault(r[0], []).append(r[2])
    return found


@pytest.mark.parametrize("sparse", [False, True])
def test_blocks_that_cannot_win_are_skipped(spark, monkeypatch, sparse):
    """On clustered rows more than half of the blocks are skipped, and the lists are those of all pairs."""
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 16)
    monkeypatch.setattr(blocks, "LEFT_ROWS", 7)
    rng = np.random.default_rng(5)
    centres = 4 * np.eye(12)

    def side(n):
        return centres[rng.integers(0, 12, n)] + rng.integers(0, 3, (n, 12)) * 0.25

    a, b = side(150), side(600)

    def frame(values):
        if not sparse:
            return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "id long, vec array<double>")
        # the owner's order puts what matters most first
        rows = []
        for i, v in enumerate(values):
            order = [int(j) for j in np.argsort(-v, kind="stable") if v[j]]
            rows.append((i, [f"f{j}" for j in order], [float(v[j]) for j in order]))
        return spark.createDataFrame(rows, "id long, dims array<string>, vals array<double>")

    left, right = frame(a), frame(b)
    assert matched(left, right, 6, ("left_id", "pos", "right_id")) == best_by_hand(a, b, 6)
    met = blocks.Matching(left, right, 6, False, 150, 600)
    first = met.scored(met.asked())
    met_later = met.asked(met.floors(first)).agg(F.sum(F.size("blocks"))).first()[0]
    assert len(met.blocks) > 20
    assert (met_later + 150) / (150 * len(met.blocks)) < 0.5


def test_negative_values_floors_and_short_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 3)
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(40, 3)) - 1, rng.normal(size=(50, 3)) + 1
    left, right = (
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>") for x in (a, b)
    )
    for k in (1, 9, 70):
        assert matched(left, right, k, ("left_id", "pos", "right_id")) == best_by_hand(a, b, k)
    assert blocks.best_matches(left, right.limit(0), 3).collect() == []
    assert blocks.best_matches(left.limit(0), right, 3).collect() == []


def test_blocks_leave_out_what_a_floor_excludes():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 6))
    block = pd.DataFrame({"id": np.arange(300), "vec": list(vectors)})
    scores = vectors @ vectors.T
    np.fill_diagonal(scores, -np.inf)
    floor = np.sort(scores, axis=1)[:, -2] - 1e-6
    found = blocks._match_blocks(block.assign(floor=floor), block, 5, True)
    expected = {(i, j) for i, j in zip(*np.nonzero(scores >= floor[:, None]))}
    above = found["score"].to_numpy() >= floor[found["left_id"]]
    assert set(zip(found["left_id"][above], found["right_id"][above])) == expected
    # a short first chunk may keep a few lower ones, a later chunk none
    assert len(found) < 300 * 5


@pytest.mark.parametrize("size", [1.0, 1e-20, 1e200])
def test_blocks_give_exact_lists_at_any_size(size):
    """Scores closer than single precision are told apart, and lengths beyond it are multiplied in double."""
    rng = np.random.default_rng(4)
    near = 1.0 + rng.integers(0, 1000, size=(900, 1)) * 1e-9
    vectors = np.hstack([near, rng.integers(0, 2, size=(900, 3)) * 0.5])
    block = pd.DataFrame({"id": np.arange(900), "dims": [np.arange(4)] * 900, "vals": list(vectors * size)})
    left = pd.DataFrame({"id": [1000, 1001], "dims": [np.arange(4)] * 2, "vals": [np.ones(4), np.array([1.0, 0, 0, 0.25])]})
    found = blocks._match_blocks(left, block, 7, False)
    for i, row in zip((1000, 1001), left["vals"]):
        best = sorted(range(900), key=lambda j: (-round(float(vectors[j] @ row), 10), j))[:7]
        assert sorted(found[found["left_id"] == i]["right_id"]) == sorted(best)


def test_pairs_meet_the_small_side_first(spark):
    pairs = spark.createDataFrame([(1, 2), (1, None), (None, 2), (3, 9)], "user_id long, item_id long")
    users = spark.createDataFrame([(1, "a")], "user_id long, name string")
    items = spark.createDataFrame([(2, "b")], "item_id long, name string")
    met = similarity._meet(pairs, users, items)
    assert rows(met, "user_id", "item_id", "u_name", "i_name") == rows(
        spark.createDataFrame(
            [(1, 2, "a", "b"), (1, None, "a", None), (None, 2, None, "b"), (3, 9, None, None)],
            "user_id long, item_id long, u_name string, i_name string",
        )
    )
    # the last join is the one with the users
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and "user_id" in joins[0] and "item_id" in joins[1]


def test_a_feature_has_the_same_part_wherever_it_stands(spark):
    """Features were numbered by their place in the row, so bounds on the parts did not hold and best items were lost."""
    one = spark.createDataFrame(
        [(1, "p", "c", ["a", "b", "z"], {"u": 1.0, "w": 2.0}), (2, None, "c", ["z"], {"w": 1.0})],
        "user_id long, province string, city string, tags array<string>, text map<string, double>",
    )
    weights = Blend(geo=1.0, tag=1.0, text=(("text", 1.0),), levels=("province", "city"))
    vectors = similarity._feature_vector(one, "user_id", weights, {}).collect()
    parts = [dict(zip(r["dims"], r["parts"])) for r in vectors]
    assert parts[0] == {"g:province:p": 0, "g:city:c": 1, "t:a": 2, "t:b": 2, "t:z": 2, "w:text:u": 3, "w:text:w": 3}
    assert parts[1] == {"g:city:c": 1, "t:z": 2, "w:text:w": 3}


def test_rows_meet_only_the_blocks_of_their_place(spark, monkeypatch):
    """Bounds without the right parts let nearly every row meet nearly every block."""
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 10)
    rng = np.random.default_rng(2)

    def side(n, name):
        rows = [
            (i, f"c{rng.integers(8)}", [f"t{j}" for j in rng.permutation(6)[: rng.integers(1, 6)]], {"w": 1.0, f"v{i % 3}": 2.0})
            for i in range(n)
        ]
        return spark.createDataFrame(rows, f"{name} long, city string, tags array<string>, text map<string, double>")

    users, items = side(60, "user_id"), side(400, "item_id")
    weights = Blend(geo=5.0, tag=3.0, text=(("text", 1.0),), levels=("city",))
    asked, asks = [], blocks.Matching.asked
    monkeypatch.setattr(blocks.Matching, "asked", lambda self, *a: asked.append((self, out := asks(self, *a))) or out)
    lists = content_based_recommend(users, items, weights, 6, 5)
    got = {(r.user_id, r.pos): (r.item_id, round(r.sim, 9)) for r in lists.collect()}
    pairs = users.select("user_id").crossJoin(items.select("item_id"))
    sims = similarity.blended_similarity(pairs, users, items, weights, 6).collect()
    for user in range(60):
        best = sorted((-round(r.sim, 9), r.item_id) for r in sims if r.user_id == user)[:5]
        assert [got[user, p + 1] for p in range(5)] == [(i, -s) for s, i in best]
    matching, later = asked[-1]
    assert len(matching.blocks) > 30
    assert later.agg(F.avg(F.size("blocks"))).first()[0] < 0.5 * len(matching.blocks)


def test_ties_over_blocks_met_one_after_the_other():
    """The ids of blocks lie among each other, and of equal scores the smaller ids are kept."""
    rng = np.random.default_rng(6)
    n, width = 900, 8
    cells = rng.integers(0, 2, (n, width)) * 0.5
    ids, rb = rng.permutation(n) * 3, rng.integers(0, 5, n)
    right = pd.DataFrame({"id": ids, "dims": [np.arange(width)] * n, "vals": list(cells), "rb": rb})
    left = pd.DataFrame({"id": np.arange(40), "dims": [np.arange(width)] * 40, "vals": list(cells[:40] + 0.1)})
    best = blocks._Best(left, right, 7, False)
    for b in (3, 0, 4, 1, 2):
        best.meet(np.arange(40), np.flatnonzero(best.right["rb"].to_numpy() == b))
    found = best.found()
    scores = (cells[:40] + 0.1) @ cells.T
    for i in range(40):
        wanted = sorted(range(n), key=lambda j: (-round(float(scores[i, j]), 10), ids[j]))[:7]
        assert sorted(found[found["left_id"] == i]["right_id"]) == sorted(ids[wanted])


def test_rows_equal_to_the_floor_count_below_its_id_only():
    right = pd.DataFrame({"id": np.arange(100), "vec": [np.ones(2)] * 100})
    left = pd.DataFrame({"id": [1000, 1001], "vec": [np.ones(2)] * 2, "floor": [2.0, 2.0], "floor_id": [3.0, np.nan]})
    found = blocks._match_blocks(left, right, 10, False)
    assert sorted(found[found["left_id"] == 1000]["right_id"]) == [0, 1, 2]
    assert sorted(found[found["left_id"] == 1001]["right_id"]) == list(range(10))


def test_what_is_moved_at_a_time_does_not_grow_with_the_product_of_both_sides(spark, monkeypatch):
    """Each part of the left rows needs a copy of the right ones, all of which were shuffled at once."""
    monkeypatch.setattr(blocks, "MAX_BLOCK_ROWS", 20)
    monkeypatch.setattr(blocks, "MIN_BLOCK_ROWS", 5)
    rng = np.random.default_rng(1)
    vectors = rng.integers(0, 4, (240, 4)) * 0.5
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vec array<double>")
    moved, scored = [], blocks.Matching.scored

    def counted(self, asked, parts=None):
        groups = F.explode(F.array_distinct(F.transform("blocks", self.group))).alias("rg")
        met = [r["rg"] for r in asked.select(groups).collect()]
        parts = parts if parts is not None else dict.fromkeys(range(len(self.sizes)), self.parts)
        moved.append(sum(int(self.sizes[g]) * cut for g, cut in parts.items()) + sum(g in parts for g in met))
        assert all(self.sizes[g] <= 20 and met.count(g) <= 20 * cut for g, cut in parts.items())
        return scored(self, asked, parts)

    monkeypatch.setattr(blocks.Matching, "scored", counted)
    monkeypatch.setattr(blocks, "COPIES", 2)
    assert matched(frame, frame, 6, ("left_id", "pos", "right_id")) == best_by_hand(vectors, vectors, 6)
    # a group of 20 rows for 240 ones cut in 12 parts moves 480
    assert len(moved) > 4 and max(moved) <= 2 * 480


def test_what_was_shuffled_goes_once_it_is_written(spark):
    frame = spark.range(50_000).select((F.col("id") % 1000).alias("k"), F.xxhash64("id").alias("x")).repartition(3, "k")
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before = shuffled()
    stored = materialize(frame, "shuffled")
    deadline = time.time() + 30
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before
    assert stored.count() == 50_000
    assert spark.conf.get(CLEANUP, None) is None
