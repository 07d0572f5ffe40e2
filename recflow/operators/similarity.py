"""How well an item suits a user: place, tags, words, and their blend.

The similarity of all users with all items has a cell for every pair, which cannot be written out at
scale. It is offered in the two forms its users need: the value of given pairs (what was shown,
bought or is about to be ranked), and the best items of every user, found over all items.

Both work on profiles: one row per user or item that packs its place, its tags and its word vectors.
Tags and words come from dimensions of bounded size, so a profile is small however many events stand
behind it, and a pair meets one profile row on each side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.functions import cosine_dense, cosine_sparse, geo_match, geo_weights, tag_overlap
from recflow.operators.blocks import as_neighbours, best_matches, nearest
from recflow.operators.features import LEVELS
from recflow.operators.joins import lookup
from recflow.operators.ranking import top_list_rows
from recflow.session import materialize

# Products of cells and neighbours that a task sums.
MAX_TASK_PRODUCTS = 500_000


@dataclass(frozen=True)
class Blend:
    """Weights of the parts of a similarity; a part that is absent counts 0 but keeps its weight."""

    geo: float = 0.0
    tag: float = 0.0
    text: tuple[tuple[str, float], ...] = ()
    levels: tuple[str, ...] = LEVELS

    @property
    def total(self) -> float:
        return self.geo + self.tag + sum(w for _, w in self.text)


# Products weigh place 5, tags 3, words 1; posts weigh tags 3, title 4, content 7.
PRODUCT_BLEND = Blend(geo=5.0, tag=3.0, text=(("text", 1.0),))
POST_BLEND = Blend(tag=3.0, text=(("title", 4.0), ("content", 7.0)))


def pack_tags(feature: DataFrame, id_col: str) -> DataFrame:
    """(entity, tags): the distinct tags of an entity, at most as many as there are tags.

    ``feature`` is a tag feature, or plain (entity, tag_id) rows, repeated or not.
    """
    if "has" in feature.columns:
        feature = feature.where(F.col("has") == 1)
    return feature.groupBy(id_col).agg(F.collect_set("tag_id").alias("tags"))


def pack_words(feature: DataFrame, id_col: str, name: str = "words") -> DataFrame:
    """(entity, map from word to value), at most as many words as serve as features."""
    return feature.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.struct("key_word", "val"))).alias(name)
    )


def profiles(
    entities: DataFrame,
    id_col: str,
    geo: DataFrame | None = None,
    tags: DataFrame | None = None,
    text: Mapping[str, DataFrame] | None = None,
    levels: Sequence[str] = LEVELS,
) -> DataFrame:
    """One row per entity with ``levels``, ``tags`` and one word map per text field.

    The levels come from ``geo`` or, without it, from ``entities`` if they are there. Parts that are
    not given, and parts an entity lacks, are null.
    """
    own = [c for c in levels if geo is None and c in entities.columns]
    out = entities.select(id_col, *own).dropDuplicates([id_col])
    if geo is not None:
        out = out.join(geo.select(id_col, *levels).dropDuplicates([id_col]), id_col, "left")
    if tags is not None:
        out = out.join(pack_tags(tags, id_col), id_col, "left")
    for name, feature in (text or {}).items():
        out = out.join(pack_words(feature, id_col, name), id_col, "left")
    return out


def _meet(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """The given pairs with the user's columns as ``u_*`` and the item's as ``i_*``.

    Pairs carry what they met first through the second exchange, so they meet the items first: a user's columns sum
    up those of many items.
    """
    for side, key, prefix in ((items, "item_id", "i_"), (users, "user_id", "u_")):
        named = [F.col(c).alias(prefix + c) for c in side.columns if c != key]
        pairs = lookup(pairs, side.select(key, *named), [key], "left")
    return pairs


def _words(name: str) -> Column:
    return cosine_sparse(F.col(f"u_{name}"), F.col(f"i_{name}"))


def geo_similarity(
    pairs: DataFrame, user_geo: DataFrame, item_geo: DataFrame, levels: Sequence[str] = LEVELS
) -> DataFrame:
    """(user_id, item_id, sim) of given pairs: weighted share of equal place levels."""
    met = _meet(pairs, user_geo.select("user_id", *levels), item_geo.select("item_id", *levels))
    sim = geo_match([F.col(f"u_{c}") for c in levels], [F.col(f"i_{c}") for c in levels])
    return met.select("user_id", "item_id", sim.alias("sim"))


def tag_similarity(
    pairs: DataFrame, user_tags: DataFrame, item_tags: DataFrame, n_tags: int | Column
) -> DataFrame:
    """(user_id, item_id, sim) of given pairs: shared tags over all tags there are."""
    met = _meet(pairs, pack_tags(user_tags, "user_id"), pack_tags(item_tags, "item_id"))
    every = n_tags if isinstance(n_tags, Column) else F.lit(n_tags)
    return met.select(
        "user_id", "item_id", tag_overlap(F.col("u_tags"), F.col("i_tags"), every).alias("sim")
    )


def text_similarity(pairs: DataFrame, user_text: DataFrame, item_text: DataFrame) -> DataFrame:
    """(user_id, item_id, sim) of given pairs: cosine over the top words."""
    met = _meet(pairs, pack_words(user_text, "user_id"), pack_words(item_text, "item_id"))
    return met.select("user_id", "item_id", _words("words").alias("sim"))


def vector_similarity(
    pairs: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, vec: str = "vec"
) -> DataFrame:
    """(user_id, item_id, sim) of given pairs: cosine of dense vectors, null without a vector."""
    met = _meet(pairs, user_vectors.select("user_id", vec), item_vectors.select("item_id", vec))
    return met.select(
        "user_id", "item_id", cosine_dense(F.col(f"u_{vec}"), F.col(f"i_{vec}")).alias("sim")
    )


def blend(parts: Sequence[tuple[DataFrame, float]]) -> DataFrame:
    """Weighted mean of similarity frames; a pair a part does not hold has 0 there.

    The parts are stacked and summed once rather than joined one by one.
    """
    total = sum(weight for _, weight in parts)
    weighted = [
        df.select("user_id", "item_id", (F.col("sim") * F.lit(weight / total)).alias("sim"))
        for df, weight in parts
    ]
    return (
        reduce(DataFrame.unionByName, weighted)
        .groupBy("user_id", "item_id")
        .agg(F.coalesce(F.sum("sim"), F.lit(0.0)).alias("sim"))
    )


def blended_similarity(
    pairs: DataFrame, users: DataFrame, items: DataFrame, weights: Blend, n_tags: int | Column
) -> DataFrame:
    """(user_id, item_id, sim) of given pairs from profiles, all parts in one pass."""
    met = _meet(pairs, users, items)
    every = n_tags if isinstance(n_tags, Column) else F.lit(n_tags)
    sim = F.lit(0.0)
    if weights.geo:
        left = [F.col(f"u_{c}") for c in weights.levels]
        right = [F.col(f"i_{c}") for c in weights.levels]
        sim = sim + F.lit(weights.geo) * geo_match(left, right)
    if weights.tag:
        sim = sim + F.lit(weights.tag) * tag_overlap(F.col("u_tags"), F.col("i_tags"), every)
    for name, weight in weights.text:
        sim = sim + F.lit(weight) * _words(name)
    return met.select("user_id", "item_id", (sim / F.lit(weights.total)).alias("sim"))


def _prefixed(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda n: F.concat(F.lit(prefix), n.cast("string")))


def _times(values: Column, factor: Column) -> Column:
    return F.transform(values, lambda x: x * factor)


def _feature_vector(
    profile: DataFrame, id_col: str, weights: Blend, scale: Mapping[str, Column]
) -> DataFrame:
    """(id, dims, vals) such that the dot product of two rows is their blended similarity.

    ``scale`` holds the factor of each part on this side, 1 where the other side carries it.
    """
    one = F.lit(1.0)
    names, values = [], []
    if weights.geo:
        for level, weight in zip(weights.levels, geo_weights(len(weights.levels)), strict=True):
            known = F.col(level).isNotNull()
            value = scale["geo"] * F.lit(weight) if "geo" in scale else one
            names.append(F.when(known, F.array(F.concat(F.lit(f"g:{level}:"), F.col(level)))))
            values.append(F.when(known, F.array(value)))
    if weights.tag:
        names.append(_prefixed(F.col("tags"), "t:"))
        values.append(F.transform("tags", lambda t: scale.get("tag", one)))
    for name, _ in weights.text:
        words = F.map_filter(name, lambda k, v: v != 0)
        norm = F.sqrt(F.aggregate(F.map_values(words), F.lit(0.0), lambda acc, x: acc + x * x))
        factor = scale.get(name, one) / norm
        names.append(_prefixed(F.map_keys(words), f"w:{name}:"))
        values.append(_times(F.map_values(words), factor))
    nothing, zero = F.array().cast("array<string>"), F.array().cast("array<double>")
    names = [F.coalesce(n, nothing) for n in names]
    return profile.select(
        F.col(id_col).alias("id"),
        F.concat(*names).alias("dims"),
        F.concat(*[F.coalesce(v, zero) for v in values]).alias("vals"),
        F.concat(*[F.array_repeat(F.lit(p), F.size(n)) for p, n in enumerate(names)]).alias("parts"),
    )


def content_based_recommend(
    users: DataFrame, items: DataFrame, weights: Blend, n_tags: int | Column, k: int, **sizes
) -> DataFrame:
    """(user_id, pos, item_id, sim): the ``k`` items with the largest blended similarity.

    Exact over all users and items of the two profile frames; ties go to the smaller item_id.
    """
    total = F.lit(weights.total)
    every = (n_tags if isinstance(n_tags, Column) else F.lit(n_tags)).cast("double")
    # a scalar subquery may not stand inside an array function, a column may
    users = users.withColumn("_tags_all", every)
    scale = {
        "geo": F.lit(weights.geo) / total,
        "tag": F.coalesce(F.try_divide(F.lit(weights.tag) / total, F.col("_tags_all")), F.lit(0.0)),
    }
    scale |= {name: F.lit(weight) / total for name, weight in weights.text}
    found = best_matches(
        _feature_vector(users, "user_id", weights, scale),
        _feature_vector(items, "item_id", weights, {}),
        k,
        **sizes,
    )
    return found.select(
        F.col("left_id").alias("user_id"),
        "pos",
        F.col("right_id").alias("item_id"),
        F.col("score").alias("sim"),
    )


def tag_neighbours(feature: DataFrame, id_col: str, k: int, **sizes) -> DataFrame:
    """(id, pos, neighbour_id, sim): the ``k`` most alike entities by cosine of their tags."""
    packed = pack_tags(feature, id_col)
    each = F.lit(1.0) / F.sqrt(F.size("tags").cast("double"))
    vectors = packed.select(
        F.col(id_col).alias("id"),
        F.transform("tags", lambda t: t.cast("string")).alias("dims"),
        F.transform("tags", lambda t: each).alias("vals"),
    )
    # counted and read as both sides
    vectors = materialize(vectors, "tag-vectors")
    found = best_matches(vectors, vectors, k, exclude_same_id=True, **sizes)
    return as_neighbours(found)


def vector_neighbours(vectors: DataFrame, id_col: str, vec_col: str, k: int, **sizes) -> DataFrame:
    """(id, pos, neighbour_id, sim): the ``k`` nearest by cosine, for factor or embedding vectors."""
    return nearest(vectors, id_col, vec_col, k, **sizes)


def pair_cosine(
    pairs: DataFrame, matrix: DataFrame, entity: str = "item_id", across: str = "user_id"
) -> DataFrame:
    """(id, other_id, sim): cosine of given pairs of items over the users who acted on them.

    With the two columns swapped, of users over their items. Of each pair only the cells of the
    entity with fewer of them are spread out and looked up under the other one, so an entity with
    very many cells is not unrolled for every pair it is in: a pair costs as many rows as the smaller
    of its two entities has cells. Pairs without common cells have 0.
    """
    cells = matrix.where(F.col("val") != 0).select(entity, across, F.col("val").cast("double").alias("val"))
    # read four times below
    cells = materialize(cells, "cells")
    sizes = cells.groupBy(entity).agg(
        F.count("*").alias("_n"), F.sqrt(F.sum(F.col("val") * F.col("val"))).alias("_norm")
    )
    met = pairs.select("id", "other_id")
    for key, side in (("id", "a"), ("other_id", "b")):
        named = sizes.select(
            F.col(entity).alias(key),
            F.col("_n").alias(f"_n_{side}"),
            F.col("_norm").alias(f"_norm_{side}"),
        )
        met = lookup(met, named, [key])
    first = F.col("_n_a") <= F.col("_n_b")
    asked = met.select(
        "id",
        "other_id",
        F.when(first, F.col("id")).otherwise(F.col("other_id")).alias("_few"),
        F.when(first, F.col("other_id")).otherwise(F.col("id")).alias("_many"),
        (F.col("_norm_a") * F.col("_norm_b")).alias("_norms"),
    )
    few = cells.select(F.col(entity).alias("_few"), across, F.col("val").alias("_x"))
    many = cells.select(F.col(entity).alias("_many"), across, F.col("val").alias("_y"))
    products = (
        lookup(lookup(asked, few, ["_few"]), many, ["_many", across])
        .groupBy("id", "other_id")
        .agg((F.sum(F.col("_x") * F.col("_y") / F.col("_norms"))).alias("sim"))
    )
    return lookup(pairs.select("id", "other_id"), products, ["id", "other_id"], "left").withColumn(
        "sim", F.coalesce("sim", F.lit(0.0))
    )


def neighbourhood_recommend(matrix: DataFrame, neighbours: DataFrame, k: int) -> DataFrame:
    """(user_id, pos, item_id, score): items near those a user acted on.

    An item scores the sum of ``val * sim`` over the user's items that have it as a neighbour.
    ``neighbours`` has a bounded number of rows per item, packed so that each matrix cell meets one
    row. Few products of a task belong to one sum, so they are not summed before the shuffle, where a
    task's sums were many times its cells; after it, a task has a bounded number of them.
    """
    cells = materialize(matrix.where(F.col("val") != 0).select("user_id", "item_id", "val"), "cells")
    packed = neighbours.groupBy(F.col("id").alias("item_id")).agg(
        F.collect_list(F.struct("neighbour_id", "sim")).alias("_near")
    )
    # counted and read
    packed = materialize(packed, "neighbours")
    products = cells.count() * (packed.agg(F.max(F.size("_near"))).first()[0] or 0)
    tasks = max(cells.sparkSession.sparkContext.defaultParallelism, -(-products // MAX_TASK_PRODUCTS))
    scored = (
        lookup(cells, packed, ["item_id"])
        .select("user_id", "val", F.inline("_near"))
        .select("user_id", F.col("neighbour_id").alias("item_id"), (F.col("val") * F.col("sim")).alias("part"))
        .repartition(tasks, "user_id", "item_id")
        .groupBy("user_id", "item_id")
        .agg(F.sum("part").alias("score"))
    )
    return top_list_rows(scored, "user_id", "item_id", "score", k)
