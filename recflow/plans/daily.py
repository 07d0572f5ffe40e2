"""The daily job: stage after stage, each stored as a snapshot of its day.

Later stages read what earlier ones stored, so nothing is computed twice and a lost executor costs
at most the stage it worked on. Running a day again replaces that day. Scratch frames of a stage are
deleted when it is stored.

Events that arrive after their day was stored are not in the stored scores. ``update_scores`` takes the
first day to compute anew; it then starts from the day stored before that one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.operators import cf, evaluate, features, interactions, ranking, similarity, text
from recflow.operators.matrix import user_text_feature
from recflow.session import scratch
from recflow.sinks import write_snapshot
from recflow.sources import read_snapshot, stored_days
from recflow.sources.schemas import ACTION_MATRIX, ITEM_SCORE


@dataclass(frozen=True)
class Store:
    """Named daily tables below one folder."""

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def save(self, df: DataFrame, name: str, run_date: str) -> DataFrame:
        write_snapshot(df, self.path(name), run_date)
        return self.read(name, run_date)

    def read(self, name: str, run_date: str) -> DataFrame:
        return read_snapshot(self.spark, self.path(name), run_date)

    def last_before(self, name: str, schema: str, run_date: str) -> tuple[DataFrame, int]:
        """The newest stored day before ``run_date`` without its date, and its age in days; -1 for none."""
        earlier = [day for day in stored_days(self.spark, self.path(name)) if day < run_date]
        if not earlier:
            return self.spark.createDataFrame([], schema), -1
        age = (date.fromisoformat(run_date) - date.fromisoformat(earlier[-1])).days
        return self.read(name, earlier[-1]).drop("date"), age


def _without_scratch(stage):
    """The stage, with its scratch frames deleted once it has stored its tables."""

    @wraps(stage)
    def run(store: Store, *args, **kwargs):
        with scratch(store.spark):
            return stage(store, *args, **kwargs)

    return run


def update_scores(
    store: Store, events: DataFrame, run_date: str, recompute_from: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Store the item scores and the action matrix of ``run_date`` from the previous day's.

    Reads the events since the stored day alone. Without a stored day the full history is used. With
    ``recompute_from``, days stored from then on are not built upon, so late events of theirs count.
    """
    out = []
    before = min(run_date, recompute_from or run_date)
    for name, schema, keys, value in (
        ("item_score", ITEM_SCORE, ["item_id"], "score"),
        ("action_matrix", ACTION_MATRIX, ["user_id", "item_id"], "val"),
    ):
        previous, age = store.last_before(name, schema, before)
        if age < 0:
            score = interactions.decayed_score(events, keys, run_date, value=value)
        else:
            age += (date.fromisoformat(run_date) - date.fromisoformat(before)).days
            since = F.date_sub(F.lit(run_date).cast("date"), age)
            recent = interactions.decayed_score(events.where(F.col("day") > since), keys, run_date, value=value)
            score = interactions.update_score(previous, recent, keys, age, value=value)
        out.append(store.save(score, name, run_date))
    return out[0], out[1]


@_without_scratch
def build_lists(store: Store, items: DataFrame, run_date: str) -> dict[str, DataFrame]:
    """Rank the items by stored score and store the ranking and its four lists."""
    scores = store.read("item_score", run_date)
    ranked = store.save(ranking.rank_items(scores, items, run_date), "ranked_items", run_date)
    fresh = store.save(ranking.fresh_list(ranked), "item_fresh_list", run_date)
    return {
        "ranked_items": ranked,
        "item_fresh_list": fresh,
        "item_hot_list": store.save(ranking.hot_list(ranked, fresh), "item_hot_list", run_date),
        "item_top_n": store.save(ranking.top_n(ranked), "item_top_n", run_date),
        "item_bottom_m": store.save(ranking.bottom_m(ranked), "item_bottom_m", run_date),
    }


@_without_scratch
def build_text(
    store: Store,
    name: str,
    items: DataFrame,
    fields: list[str],
    run_date: str,
    stopwords: DataFrame | None = None,
) -> DataFrame:
    """Store word counts, tfidf and the item and user text features of one text."""
    counts = store.save(
        text.word_count(items, fields, run_date, stopwords=stopwords), f"{name}_word_count", run_date
    )
    weights = store.save(text.tfidf(counts), f"{name}_tfidf", run_date)
    item_text = store.save(
        text.item_text_feature(weights, run_date), f"{name}_item_text_feature", run_date
    )
    actions = store.read("action_matrix", run_date)
    user_text = user_text_feature(actions, item_text, run_date)
    store.save(user_text, f"{name}_user_text_feature", run_date)
    return weights


@_without_scratch
def build_content_lists(
    store: Store,
    name: str,
    users: DataFrame,
    items: DataFrame,
    weights: similarity.Blend,
    texts: dict[str, str],
    k: int,
    run_date: str,
    user_tags: DataFrame | None = None,
    item_tags: DataFrame | None = None,
) -> DataFrame:
    """Store the content-based list of every user.

    ``texts`` maps the text parts of the blend to the names given to ``build_text``.
    """
    sides = []
    n_tags = 1
    if item_tags is not None:
        n_tags = item_tags.select("tag_id").distinct().count()
    for df, raw, key, tags, side in (
        (users, "uid", "user_id", user_tags, "user"),
        (items, "id", "item_id", item_tags, "item"),
    ):
        geo = features.geo_feature(df, raw, key, run_date, weights.levels) if weights.geo else None
        words = {
            part: store.read(f"{stored}_{side}_text_feature", run_date) for part, stored in texts.items()
        }
        sides.append(
            similarity.profiles(
                df.select(F.col(raw).alias(key)), key, geo, tags, words, weights.levels
            )
        )
    lists = similarity.content_based_recommend(
        *sides, weights, n_tags, k, left_rows=users.count(), right_rows=items.count()
    )
    return store.save(lists, f"{name}_content_based", run_date)


@_without_scratch
def build_cf_lists(
    store: Store, name: str, items: DataFrame, k: int, run_date: str, **options
) -> DataFrame:
    """Train ALS on the stored action matrix of some items and store every user's list."""
    wanted = items.select(F.col("id").alias("item_id"))
    cells = store.read("action_matrix", run_date).join(wanted, "item_id", "left_semi")
    model = cf.factorize(cells, **options)
    for side, table in zip(("user", "item"), cf.als_factors(model)):
        store.save(table, f"{name}_{side}_factors", run_date)
    return store.save(cf.cf_recommend(model, k), f"{name}_cf_lists", run_date)


@_without_scratch
def evaluate_day(
    store: Store, feed: DataFrame, events: DataFrame, items: DataFrame, run_date: str
) -> DataFrame:
    """Store precision, recall and F1 of what the feed log says was shown on a day."""
    acted = events.where(F.col("day") == F.lit(run_date).cast("date"))
    result = evaluate.evaluate(feed, acted, items, run_date)
    return store.save(result, "evaluation", run_date)
