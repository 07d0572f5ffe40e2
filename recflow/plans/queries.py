"""Every operator as a query over the whole test tables.

Results are rounded to six digits so that they can be compared between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions import comparable, rounded_double
from recflow.operators import (
    analysis,
    cf,
    evaluate,
    features,
    gram,
    interactions,
    matrix,
    ranking,
    retrieval,
    segment,
    similarity,
    sparse,
    text,
)
from recflow.plans.testdata import ACTION_DATE, FEED_DATE, PLACES, RUN_DATE, Shop
from recflow.session import materialize, scratch_path
from recflow.sinks import to_list_rows, to_sorted_set_rows, write_snapshot
from recflow.sinks.cache import (
    CONTENT_LIST_KEY,
    FRESH_LIST_KEY,
    HOT_LIST_KEY,
    INVERSE_INDEX_KEY,
    USER_SCORE_KEY,
)
from recflow.sources import read_or_empty, read_snapshot, schemas, snapshot
from recflow.sources.dimensions import category_dimension, event_weights, tag_dimension

DIGITS = 6
LIST_SIZE = 10
CF_SIZE = 5
RANK = cf.RANK
USER_SHARDS = 16
# Users and items of more cells are summed in parts.
SPLIT_CELLS = 20
# A year after the events.
OLD_DATE = "2025-01-30"
# Words of the posts without their spaces; short alphabets hold together less than large ones.
UNSPACED = {"max_length": 4, "min_cohesion": 1.0, "min_freedom": 1.5, "min_count": 5}
EVENT_TYPES = ("view", "click", "purchase")
LEVEL_THRESHOLDS = (50.0, 100.0, 200.0)
POSTS_LANGUAGE = "en"
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
BLEND_OF_PRODUCTS = similarity.Blend(geo=5.0, tag=3.0, text=(("text", 1.0),), levels=PLACES)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    """Register a query under its function name."""

    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(Shop(spark, folder))

    QUERIES[run.__name__] = call
    return run


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    kinds = dict(df.dtypes)
    found = {c: rounded_double(F.col(c), DIGITS) if kinds[c] == "double" else F.round(c, DIGITS) for c in columns}
    # adding 0 turns a negative zero into zero
    return df.withColumns({c: x + F.lit(0.0) for c, x in found.items()})


# sources


@query
def user_snapshot(shop: Shop) -> DataFrame:
    return snapshot(shop.users(), schemas.USERS, RUN_DATE, drop=["district"])


@query
def item_snapshot(shop: Shop) -> DataFrame:
    items = snapshot(shop.products(), schemas.ITEMS, RUN_DATE)
    return items.select(
        "id", "name", "description", "category", F.col("price").cast("double").alias("price"), "date"
    )


@query
def event_snapshot(shop: Shop) -> DataFrame:
    events = shop.events().withColumnRenamed("day", "timestamp")
    stored = snapshot(events, schemas.EVENTS, RUN_DATE, drop=["page_depth", "current_url"])
    return stored.withColumn("timestamp", F.col("timestamp").cast("string"))


@query
def tag_dimension_snapshot(shop: Shop) -> DataFrame:
    tags = tag_dimension(shop.tags(), shop.tag_categories(), RUN_DATE)
    return tags.drop("tag_category_id").fillna("unknown", ["category_name"])


@query
def item_tag_snapshot(shop: Shop) -> DataFrame:
    tags = shop.product_tags().withColumn("weight", F.lit("0.65"))
    stored = snapshot(tags, schemas.ITEM_TAGS, RUN_DATE, drop=["id"])
    return stored.withColumn("weight", F.col("weight").cast("double"))


@query
def user_tag_snapshot(shop: Shop) -> DataFrame:
    return snapshot(shop.user_product_tags().distinct(), schemas.USER_TAGS, RUN_DATE, drop=["id", "weight"])


@query
def feed_snapshot(shop: Shop) -> DataFrame:
    shown = _feed(shop).withColumn("timestamp", F.lit(FEED_DATE))
    stored = snapshot(shown, schemas.FEED, FEED_DATE, drop=["feed_id"])
    return stored.withColumn("timestamp", F.col("timestamp").cast("string"))


@query
def categories(shop: Shop) -> DataFrame:
    return category_dimension(shop.products())


@query
def snapshot_rewrite(shop: Shop) -> DataFrame:
    """Two stored days, the second written twice: both days are read back, each once."""
    path = scratch_path(shop.spark, "item-score")
    for day in (FEED_DATE, RUN_DATE, RUN_DATE):
        scores = interactions.item_score(shop.products(), shop.events(), day)
        write_snapshot(scores, path, day)
    first = read_snapshot(shop.spark, path, FEED_DATE)
    second = read_or_empty(shop.spark, path, schemas.ITEM_SCORE, RUN_DATE)
    return rounded(first.unionByName(second), "score").select("item_id", "score", "date")


@query
def snapshot_rewrite_empty(shop: Shop) -> DataFrame:
    """Two stored days, the second written again without rows: the first alone is left."""
    path = scratch_path(shop.spark, "item-score")
    for day in (FEED_DATE, RUN_DATE):
        write_snapshot(interactions.item_score(shop.products(), shop.events(), day), path, day)
    write_snapshot(_item_score(shop).where("item_id is null"), path, RUN_DATE)
    days = [read_snapshot(shop.spark, path, day) for day in (FEED_DATE, RUN_DATE)]
    return rounded(days[0].unionByName(days[1]), "score").select("item_id", "score", "date")


# scores and the action matrix


@query
def weighted_events(shop: Shop) -> DataFrame:
    weighted = interactions.weight_events(shop.events(), event_weights(shop.spark))
    return weighted.withColumn("day", F.col("day").cast("string"))


def _item_score(shop: Shop, day: str = RUN_DATE) -> DataFrame:
    return interactions.item_score(shop.products(), shop.events(), day)


def _user_score(shop: Shop) -> DataFrame:
    return interactions.user_score(shop.users(), shop.events(), RUN_DATE)


@query
def item_score(shop: Shop) -> DataFrame:
    return rounded(_item_score(shop), "score")


@query
def item_score_incremental(shop: Shop) -> DataFrame:
    """The stored score of the day before, aged and topped up with the run date's events."""
    before = (date.fromisoformat(RUN_DATE) - timedelta(days=1)).isoformat()
    events = shop.events()
    previous = interactions.decayed_score(events, ["item_id"], before)
    today = interactions.day_score(events, ["item_id"], RUN_DATE)
    return rounded(interactions.update_score(previous, today, ["item_id"]), "score")


@query
def item_score_late(shop: Shop) -> DataFrame:
    """Events arrive up to four days late: the stored score of a week before, and what arrived since."""
    late = (F.col("event_id") % 5).cast("int")
    events = shop.events().withColumn("arrived", F.date_add("day", late))
    seen = events.where(F.col("arrived") <= F.lit(FEED_DATE).cast("date"))
    stored = materialize(interactions.decayed_score(seen, ["item_id"], FEED_DATE), "stored-score")
    return rounded(interactions.catch_up(stored, events, ["item_id"], FEED_DATE, RUN_DATE), "score")


@query
def user_score(shop: Shop) -> DataFrame:
    return rounded(_user_score(shop), "score")


@query
def user_level(shop: Shop) -> DataFrame:
    return rounded(interactions.user_level(_user_score(shop)), "score")


@query
def user_level_by_threshold(shop: Shop) -> DataFrame:
    return rounded(interactions.user_level(_user_score(shop), LEVEL_THRESHOLDS), "score")


def _actions(shop: Shop, items: DataFrame, day: str = RUN_DATE) -> DataFrame:
    return interactions.action_matrix(shop.events(), items, day)


@query
def action_matrix(shop: Shop) -> DataFrame:
    return rounded(_actions(shop, shop.products()), "val")


@query
def action_matrix_of_category(shop: Shop) -> DataFrame:
    cells = interactions.action_matrix(
        shop.events(), shop.posts(), RUN_DATE, POSTS_LANGUAGE, users=shop.users()
    )
    return rounded(cells, "val")


@query
def matrix_cells(shop: Shop) -> DataFrame:
    """The action value of every pair that was bought."""
    return rounded(interactions.matrix_cells(shop.bought(), _actions(shop, shop.products())), "val")


# rankings


def _ranked(shop: Shop) -> DataFrame:
    return ranking.rank_items(_item_score(shop), shop.products(), RUN_DATE)


def _scored(shop: Shop) -> DataFrame:
    return ranking.with_category(_item_score(shop), shop.products())


@query
def rank_items(shop: Shop) -> DataFrame:
    return rounded(_ranked(shop), "score")


@query
def fresh_list(shop: Shop) -> DataFrame:
    return rounded(ranking.fresh_list(_ranked(shop)), "score")


@query
def hot_list(shop: Shop) -> DataFrame:
    scored = _scored(shop)
    hot = ranking.hot_list(scored, ranking.fresh_list(scored)).withColumn("date", F.lit(RUN_DATE))
    return rounded(hot, "score")


@query
def rank_items_old_events(shop: Shop) -> DataFrame:
    """The ranking a year after the events, when all scores are far below 1e-9."""
    scores = _item_score(shop, OLD_DATE)
    return ranking.rank_items(scores, shop.products(), OLD_DATE).select("item_id", "category", "rn")


@query
def top_n(shop: Shop) -> DataFrame:
    return rounded(ranking.top_n(_scored(shop)), "score")


@query
def bottom_m(shop: Shop) -> DataFrame:
    return rounded(ranking.bottom_m(_scored(shop)), "score")


# text


def _post_counts(shop: Shop, field: str) -> DataFrame:
    return text.word_count(shop.posts(), [field], RUN_DATE, stopwords=shop.stopwords)


def _product_counts(shop: Shop) -> DataFrame:
    return text.word_count(shop.products(), ["name", "description"], RUN_DATE)


def _stored_counts(shop: Shop, field: str) -> DataFrame:
    """Word counts with several consumers: the texts are cut into words once."""
    return materialize(_post_counts(shop, field), "word-count")


def _tfidf(shop: Shop) -> DataFrame:
    return text.tfidf(_stored_counts(shop, "description"))


@query
def word_count_combined(shop: Shop) -> DataFrame:
    counts = text.word_count(shop.posts(), ["name", "description"], RUN_DATE, stopwords=shop.stopwords)
    return counts.drop("date")


@query
def word_count_title(shop: Shop) -> DataFrame:
    return _post_counts(shop, "name").drop("date")


@query
def word_count_content(shop: Shop) -> DataFrame:
    return _post_counts(shop, "description").drop("date")


def _unspaced(shop: Shop) -> tuple[DataFrame, DataFrame]:
    """(posts with the spaces taken out, the vocabulary learned from them)."""
    closed = [F.regexp_replace(f, r"[\x20\x09-\x0D]+", "").alias(f) for f in ("name", "description")]
    posts = shop.posts().select("id", *closed)
    return posts, segment.learn_vocabulary(posts, ["name", "description"], **UNSPACED)


@query
def unspaced_vocabulary(shop: Shop) -> DataFrame:
    return rounded(rounded(_unspaced(shop)[1], "cohesion"), "freedom")


@query
def word_count_unspaced(shop: Shop) -> DataFrame:
    """Word counts of posts whose words stand without spaces."""
    posts, vocabulary = _unspaced(shop)
    tokenizer = segment.segmenter(vocabulary)
    return text.word_count(posts, ["name", "description"], RUN_DATE, tokenizer=tokenizer).drop("date")


@query
def idf(shop: Shop) -> DataFrame:
    return rounded(text.idf(_stored_counts(shop, "description")), "idf")


@query
def tf(shop: Shop) -> DataFrame:
    return rounded(text.tf(_post_counts(shop, "description")), "tf").drop("date")


@query
def tfidf(shop: Shop) -> DataFrame:
    return rounded(_tfidf(shop), "tfidf").select("item_id", "key_word", "tfidf")


@query
def top_keywords(shop: Shop) -> DataFrame:
    return text.top_keywords(_tfidf(shop))


@query
def hot_words(shop: Shop) -> DataFrame:
    return rounded(text.hot_words(_product_counts(shop), 20), "weight")


@query
def inverse_index(shop: Shop) -> DataFrame:
    """The index as rows; the shards are kept small here so that frequent words have several."""
    index = text.inverse_index(_tfidf(shop), max_postings=100)
    return rounded(text.index_rows(index), "tfidf")


@query
def item_text_feature(shop: Shop) -> DataFrame:
    counts = _stored_counts(shop, "description")
    feature = text.item_text_feature(counts, RUN_DATE, shop.posts(), POSTS_LANGUAGE)
    return rounded(feature, "val").drop("date")


def _post_text(shop: Shop, field: str) -> tuple[DataFrame, DataFrame]:
    items = text.item_text_feature(_stored_counts(shop, field), RUN_DATE)
    items = materialize(items, "item-text")
    return matrix.user_text_feature(_actions(shop, shop.posts()), items, RUN_DATE), items


def _product_text(shop: Shop) -> tuple[DataFrame, DataFrame]:
    items = materialize(text.item_text_feature(_product_counts(shop), RUN_DATE), "item-text")
    return matrix.user_text_feature(_actions(shop, shop.products()), items, RUN_DATE), items


@query
def user_text_feature(shop: Shop) -> DataFrame:
    return rounded(_post_text(shop, "description")[0], "val").drop("date")


@query
def index_top_k(shop: Shop) -> DataFrame:
    """The posts nearest to each user's text profile, from the inverted index."""
    users, items = _post_text(shop, "description")
    index = materialize(retrieval.impact_blocks(items, 32), "impact-blocks")
    return rounded(retrieval.index_top_k(index, items, materialize(users, "user-text"), LIST_SIZE), "score")


# features


@query
def geo_feature_user(shop: Shop) -> DataFrame:
    return features.geo_feature(shop.users(), "uid", "user_id", RUN_DATE, PLACES)


@query
def geo_feature_item(shop: Shop) -> DataFrame:
    return features.geo_feature(shop.product_places(), "id", "item_id", RUN_DATE, PLACES)


def _n_tags(shop: Shop):
    return shop.tags().agg(F.count("*").alias("n")).scalar()


@query
def tag_feature_user(shop: Shop) -> DataFrame:
    return features.tag_feature(shop.user_product_tags(), "user_id", RUN_DATE)


@query
def tag_feature_item(shop: Shop) -> DataFrame:
    return features.tag_feature(shop.product_tags(), "item_id", RUN_DATE, shop.tags())


@query
def tag_presence(shop: Shop) -> DataFrame:
    """For each tag of what a user bought: did the user act on a product with that tag?"""
    pairs = shop.user_product_tags().distinct()
    actions = _actions(shop, shop.products())
    acted = actions.select("user_id", "item_id").join(shop.product_tags(), "item_id")
    return features.tag_presence(pairs, features.tag_feature(acted, "user_id", RUN_DATE), "user_id")


# similarities of given pairs, best items of every user


@query
def geo_similarity(shop: Shop) -> DataFrame:
    user_geo = features.geo_feature(shop.users(), "uid", "user_id", RUN_DATE, PLACES)
    item_geo = features.geo_feature(shop.product_places(), "id", "item_id", RUN_DATE, PLACES)
    return rounded(similarity.geo_similarity(shop.bought(), user_geo, item_geo, PLACES), "sim")


@query
def tag_similarity(shop: Shop) -> DataFrame:
    sims = similarity.tag_similarity(
        shop.bought(), shop.user_product_tags(), shop.product_tags(), _n_tags(shop)
    )
    return rounded(sims, "sim")


@query
def text_similarity(shop: Shop) -> DataFrame:
    user_text, item_text = _post_text(shop, "description")
    return rounded(similarity.text_similarity(shop.seen_posts(), user_text, item_text), "sim")


@query
def embedding_cosine(shop: Shop) -> DataFrame:
    """Cosine of the vectors filed under the user's and the item's number, for every event pair."""
    users, items = shop.vectors("user_id"), shop.vectors("item_id")
    pairs = shop.events().select("user_id", "item_id").distinct()
    return rounded(similarity.vector_similarity(pairs, users, items), "sim")


def _product_profiles(shop: Shop) -> tuple[DataFrame, DataFrame]:
    user_text, item_text = _product_text(shop)
    users = shop.users().select(F.col("uid").alias("user_id"), *PLACES)
    items = shop.products().select(F.col("id").alias("item_id"))
    homes = shop.product_places().withColumnRenamed("id", "item_id")
    return (
        similarity.profiles(
            users, "user_id", tags=shop.user_product_tags(), text={"text": user_text}, levels=PLACES
        ),
        similarity.profiles(items, "item_id", homes, shop.product_tags(), {"text": item_text}, PLACES),
    )


def _post_profiles(shop: Shop) -> tuple[DataFrame, DataFrame]:
    user_title, item_title = _post_text(shop, "name")
    user_content, item_content = _post_text(shop, "description")
    users = shop.users().select(F.col("uid").alias("user_id"))
    items = shop.posts().select(F.col("id").alias("item_id"))
    user_tags, item_tags = shop.user_post_tags(), shop.post_tags()
    return (
        similarity.profiles(
            users, "user_id", tags=user_tags, text={"title": user_title, "content": user_content}
        ),
        similarity.profiles(
            items, "item_id", tags=item_tags, text={"title": item_title, "content": item_content}
        ),
    )


def _n_post_tags(shop: Shop):
    return shop.post_tags().agg(F.countDistinct("tag_id").alias("n")).scalar()


@query
def product_similarity(shop: Shop) -> DataFrame:
    users, items = _product_profiles(shop)
    sims = similarity.blended_similarity(
        shop.bought(), users, items, BLEND_OF_PRODUCTS, _n_tags(shop)
    )
    return rounded(sims, "sim")


@query
def post_similarity(shop: Shop) -> DataFrame:
    users, items = _post_profiles(shop)
    sims = similarity.blended_similarity(
        shop.seen_posts(), users, items, similarity.POST_BLEND, _n_post_tags(shop)
    )
    return rounded(sims, "sim")


@query
def blend_of_parts(shop: Shop) -> DataFrame:
    """Place and tag similarity of the bought pairs, computed apart and then blended."""
    user_geo, item_geo = shop.users(), shop.product_places()
    geo = similarity.geo_similarity(
        shop.bought(),
        user_geo.withColumnRenamed("uid", "user_id"),
        item_geo.withColumnRenamed("id", "item_id"),
        PLACES,
    )
    tag = similarity.tag_similarity(
        shop.bought(), shop.user_product_tags(), shop.product_tags(), _n_tags(shop)
    )
    return rounded(similarity.blend([(geo, 5.0), (tag, 3.0)]), "sim")


def _product_lists(shop: Shop) -> DataFrame:
    users, items = _product_profiles(shop)
    return similarity.content_based_recommend(
        users,
        items,
        BLEND_OF_PRODUCTS,
        _n_tags(shop),
        LIST_SIZE,
        left_rows=shop.table("customer").count(),
        right_rows=shop.table("part").count(),
    )


@query
def content_based_products(shop: Shop) -> DataFrame:
    return rounded(_product_lists(shop), "sim")


@query
def content_based_posts(shop: Shop) -> DataFrame:
    users, items = _post_profiles(shop)
    lists = similarity.content_based_recommend(
        users,
        items,
        similarity.POST_BLEND,
        _n_post_tags(shop),
        LIST_SIZE,
        left_rows=shop.table("customer").count(),
        right_rows=shop.table("documents").count(),
    )
    return rounded(lists, "sim")


# collaborative filtering


@query
def item_neighbours(shop: Shop) -> DataFrame:
    return rounded(similarity.vector_neighbours(shop.vectors("id"), "id", "vec", LIST_SIZE), "sim")


@query
def user_neighbours(shop: Shop) -> DataFrame:
    return rounded(similarity.tag_neighbours(shop.user_product_tags(), "user_id", LIST_SIZE), "sim")


@query
def item_pair_cosine(shop: Shop) -> DataFrame:
    """How alike neighbouring items are by the users who acted on both."""
    near = similarity.vector_neighbours(shop.vectors("id"), "id", "vec", LIST_SIZE)
    pairs = near.select("id", F.col("neighbour_id").alias("other_id"))
    return rounded(similarity.pair_cosine(pairs, _actions(shop, shop.products())), "sim")


@query
def user_pair_cosine(shop: Shop) -> DataFrame:
    """The same for users with neighbouring numbers, over their items."""
    users = shop.users().select(F.col("uid").alias("id"), (F.col("uid") + 1).alias("other_id"))
    actions = _actions(shop, shop.products())
    return rounded(similarity.pair_cosine(users, actions, "user_id", "item_id"), "sim")


def _neighbourhood(shop: Shop, day: str = RUN_DATE) -> DataFrame:
    near = similarity.vector_neighbours(shop.vectors("id"), "id", "vec", LIST_SIZE)
    return similarity.neighbourhood_recommend(_actions(shop, shop.products(), day), near, LIST_SIZE)


@query
def neighbourhood_list(shop: Shop) -> DataFrame:
    return rounded(_neighbourhood(shop), "score")


@query
def action_item_neighbours(shop: Shop) -> DataFrame:
    """The items most alike by who acted on them."""
    return rounded(sparse.action_neighbours(_actions(shop, shop.products()), LIST_SIZE), "sim")


@query
def action_user_neighbours(shop: Shop) -> DataFrame:
    """The users most alike by what they acted on."""
    actions = _actions(shop, shop.products())
    return rounded(sparse.action_neighbours(actions, LIST_SIZE, "user_id", "item_id"), "sim")


@query
def action_neighbourhood_list(shop: Shop) -> DataFrame:
    """Lists from the neighbours by actions."""
    actions = materialize(_actions(shop, shop.products()), "actions")
    near = sparse.action_neighbours(actions, LIST_SIZE)
    return rounded(similarity.neighbourhood_recommend(actions, near, LIST_SIZE), "score")


def _als(shop: Shop, **options) -> cf.Factors:
    return cf.factorize(_actions(shop, shop.products()), **options)


@query
def als_user_factors(shop: Shop) -> DataFrame:
    return cf.als_factors(_als(shop))[0]


@query
def als_item_factors(shop: Shop) -> DataFrame:
    return cf.als_factors(_als(shop))[1]


@query
def als_factor_check(shop: Shop) -> DataFrame:
    """Every user and item with actions, and how many finite factors it has."""
    factors = _als(shop)

    def finite(df: DataFrame, side: str) -> DataFrame:
        usable = F.filter("features", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.select(F.lit(side).alias("side"), F.col(f"{side}_id").alias("id"), F.size(usable).alias("factors"))

    return finite(factors.users, "user").unionByName(finite(factors.items, "item"))


@query
def als_fit_check(shop: Shop) -> DataFrame:
    """How many cells the factorization was fitted to, and whether it predicts them better than their mean."""
    cells = _actions(shop, shop.products())
    error = cf.training_error(_als(shop), cells)
    return error.select("cells", (F.col("rmse") < F.col("rmse_of_mean")).alias("better_than_mean"))


@query
def als_split_check(shop: Shop) -> DataFrame:
    """The fit with hot rows summed in parts: how many vectors, and its error against the mean's and ALS's."""
    cells = materialize(_actions(shop, shop.products()), "actions")
    ours = gram.factorize_split(cells, hot_cells=SPLIT_CELLS)
    als = cf.training_error(cf.factorize(cells), cells).first()
    usable = F.forall("features", lambda x: F.abs(x) < float("inf")) & (F.size("features") == RANK)
    return cf.training_error(ours, cells).select(
        "cells",
        (F.col("rmse") < F.col("rmse_of_mean")).alias("better_than_mean"),
        (F.col("rmse") <= 1.01 * F.lit(als.rmse)).alias("as_good_as_als"),
        F.lit(ours.users.where(usable).count()).alias("users"),
        F.lit(ours.items.where(usable).count()).alias("items"),
    )


@query
def als_implicit_list(shop: Shop) -> DataFrame:
    return cf.cf_list(_als(shop, implicit=True), CF_SIZE)


@query
def als_implicit_check(shop: Shop) -> DataFrame:
    """What must hold of the lists of the implicit factorization."""
    factors = _als(shop, implicit=True)
    return cf.check_lists(factors, cf.cf_recommend(factors, CF_SIZE), _actions(shop, shop.products()))


@query
def als_item_similarity(shop: Shop) -> DataFrame:
    return cf.item_similarity(_als(shop), CF_SIZE)


@query
def als_user_similarity(shop: Shop) -> DataFrame:
    return cf.user_similarity(_als(shop), CF_SIZE)


@query
def als_similarity_check(shop: Shop) -> DataFrame:
    """Of each item's and user's neighbours: how many, how many different others, cosines in range."""
    factors = _als(shop)
    out = []
    for side, found in (("item", cf.item_similarity(factors, CF_SIZE)), ("user", cf.user_similarity(factors, CF_SIZE))):
        own = found.groupBy("id").agg(
            F.count("*").alias("neighbours"),
            F.countDistinct(F.when(F.col("id") != F.col("neighbour_id"), F.col("neighbour_id"))).alias("others"),
            F.every((F.col("sim") <= 1.000001) & (F.col("sim") >= -1.000001)).alias("cosines"),
        )
        out.append(own.withColumn("side", F.lit(side)))
    return out[0].unionByName(out[1])


@query
def cf_list(shop: Shop) -> DataFrame:
    return cf.cf_recommend(_als(shop), CF_SIZE)


@query
def cf_list_check(shop: Shop) -> DataFrame:
    """What must hold of the lists of ``cf_list``."""
    factors = _als(shop)
    return cf.check_lists(factors, cf.cf_recommend(factors, CF_SIZE), _actions(shop, shop.products()))


# cache rows


@query
def sorted_set_hot(shop: Shop) -> DataFrame:
    scored = _scored(shop)
    hot = ranking.hot_list(scored, ranking.fresh_list(scored))
    return rounded(to_sorted_set_rows(hot, HOT_LIST_KEY, "category", "item_id", "score"), "score")


@query
def sorted_set_fresh(shop: Shop) -> DataFrame:
    fresh = ranking.fresh_list(_ranked(shop))
    return rounded(to_sorted_set_rows(fresh, FRESH_LIST_KEY, "category", "item_id", "score"), "score")


@query
def sorted_set_user_score(shop: Shop) -> DataFrame:
    """The users' scores, in sets by the last digits of their ids, so that no key holds all users."""
    shards = _user_score(shop).withColumn("shard", F.pmod("user_id", F.lit(USER_SHARDS)))
    return rounded(to_sorted_set_rows(shards, USER_SCORE_KEY, "shard", "user_id", "score"), "score")


@query
def sorted_set_index(shop: Shop) -> DataFrame:
    rows = text.index_rows(text.inverse_index(text.tfidf(_product_counts(shop))))
    return rounded(to_sorted_set_rows(rows, INVERSE_INDEX_KEY, "key_word", "item_id", "tfidf"), "score")


@query
def list_rows(shop: Shop) -> DataFrame:
    """The neighbourhood lists as ordered cache lists."""
    lists = ranking.ranked_list(_neighbourhood(shop), "user_id", "item_id", "score", LIST_SIZE)
    key = CONTENT_LIST_KEY.format(category="product")
    return to_list_rows(lists, key, "user_id", "item_list")


# evaluation and analysis


def _feed(shop: Shop) -> DataFrame:
    """What was shown: the overall best items to every user, and the neighbourhood lists."""
    best = (
        _item_score(shop, FEED_DATE)
        .orderBy(comparable(F.col("score")).desc(), "item_id")
        .limit(LIST_SIZE)
        .agg(F.array_sort(F.collect_list(F.struct(-comparable(F.col("score")), "item_id"))).alias("best"))
    )
    ids = best.select(F.col("best.item_id")).scalar()
    shown = shop.users().select(F.col("uid").alias("user_id"), F.posexplode(ids).alias("pos", "item_id"))
    listed = shown.select(
        "user_id", "item_id", (F.col("pos") + 1).cast("long").alias("pos"), F.lit("list_based").alias("rec_algo")
    )
    near = _neighbourhood(shop, FEED_DATE).select(
        "user_id", "item_id", "pos", F.lit("cf_based").alias("rec_algo")
    )
    return listed.unionByName(near)


@query
def evaluate_feed(shop: Shop) -> DataFrame:
    result = evaluate.evaluate(_feed(shop), shop.actions(), shop.products(), ACTION_DATE)
    return rounded(result, "precision", "recall", "f1")


@query
def map_at_k(shop: Shop) -> DataFrame:
    return rounded(
        evaluate.mean_average_precision(_feed(shop), shop.actions(), LIST_SIZE), "map_at_k"
    )


@query
def user_coverage(shop: Shop) -> DataFrame:
    return rounded(evaluate.user_coverage(_feed(shop), shop.users()), "coverage")


def _analysis(df: DataFrame) -> DataFrame:
    days = {c: F.coalesce(F.col(c).cast("string"), F.lit("never")) for c in ("first_day", "last_day")}
    return rounded(df.withColumns(days), "score", *[f"share_{t}" for t in EVENT_TYPES])


@query
def analyze_users(shop: Shop) -> DataFrame:
    return _analysis(analysis.analyze_users(_user_score(shop), shop.events(), event_types=EVENT_TYPES))


@query
def analyze_items(shop: Shop) -> DataFrame:
    return _analysis(analysis.analyze_items(_item_score(shop), shop.events(), event_types=EVENT_TYPES))


@query
def user_score_quantiles(shop: Shop) -> DataFrame:
    return rounded(ranking.quantiles(_user_score(shop), "score", "user_id", QUARTILES), "score")


@query
def item_score_quantiles(shop: Shop) -> DataFrame:
    return rounded(ranking.quantiles(_item_score(shop), "score", "item_id", QUARTILES), "score")
