"""The queries in SQL, for engines that read the same tables under their names.

Each statement is built from named subqueries; only those it needs are put in front of it.
"""

from __future__ import annotations

import re

from recflow.plans.queries import (
    CF_SIZE,
    DIGITS,
    EVENT_TYPES,
    LEVEL_THRESHOLDS,
    LIST_SIZE,
    OLD_DATE,
    POSTS_LANGUAGE,
    QUARTILES,
    RANK,
    UNSPACED,
    USER_SHARDS,
)
from recflow.plans.testdata import ACTION_DATE, FEED_DATE, N_STOPWORDS, RUN_DATE
from recflow.sources.dimensions import EVENT_WEIGHTS, REC_ALGORITHMS

GAMMA = 0.9
UNIT, EXACT = 1000, 9
WEIGHT = (
    "CASE event_type "
    + " ".join(f"WHEN '{t}' THEN {w}" for t, w in EVENT_WEIGHTS.items())
    + " ELSE 0.0 END"
)
WORDS = r"list_distinct(regexp_extract_all(lower({}), '\p{{L}}+'))"


def _first_digits(x: str) -> str:
    """A double cut to 12 digits from its leading one, so that equal sums compare equal."""
    unit = f"power(10.0, 11 - floor(log10(greatest(abs({x}), 1e-300))))"
    return f"CASE WHEN abs({x}) < 1e-290 THEN {x} ELSE round({x} * {unit}) / {unit} END"


def _decayed(keys: str, day: str, name: str) -> str:
    return (
        f"SELECT {keys}, sum({WEIGHT} * power({GAMMA}, date_diff('day', day, DATE '{day}'))) AS {name} "
        f"FROM ev WHERE day <= DATE '{day}' AND {WEIGHT} > 0 GROUP BY {keys}"
    )


def _item_score(day: str) -> str:
    return (
        "SELECT p.id AS item_id, coalesce(s.score, 0.0) AS score FROM products p LEFT JOIN "
        f"({_decayed('item_id', day, 'score')}) s ON s.item_id = p.id"
    )


def _count(source: str, columns: list[str], stop: bool) -> str:
    """Field presence counts of the given columns."""
    drop = "WHERE key_word NOT IN (SELECT key_word FROM stopwords)" if stop else ""
    each = " UNION ALL ".join(
        f"SELECT id AS item_id, unnest({WORDS.format(c)}) AS key_word FROM {source}" for c in columns
    )
    return f"SELECT item_id, key_word, count(*) AS word_count FROM ({each}) {drop} GROUP BY 1, 2"


def _unspaced_grams(longest: int) -> str:
    """All sequences of letters of the runs, up to one letter more than a word may have."""
    return (
        "SELECT gram, sum(k) AS n FROM (SELECT k, substr(run, CAST(place AS BIGINT), size) AS gram FROM "
        "(SELECT run, k, unnest(range(1, length(run) + 1)) AS place FROM distinct_runs) "
        f"CROSS JOIN range(1, {longest + 2}) s(size) WHERE place + size - 1 <= length(run)) GROUP BY gram"
    )


def _vocabulary(max_length: int, min_cohesion: float, min_freedom: float, min_count: int) -> str:
    """Words by cohesion and freedom, and all letters, with their costs."""
    ends = " UNION ALL ".join(
        f"SELECT {word} AS word, sum(n * log2(n)) AS bits FROM grams WHERE length(gram) > 2 GROUP BY 1"
        for word in ("substr(gram, 1, length(gram) - 1)", "substr(gram, 2)")
    )
    total = "(SELECT sum(n) FROM grams WHERE length(gram) = 1)"
    return (
        "SELECT word, n, cohesion, freedom, "
        f"CAST(round((log2({total}) - log2(n)) * {UNIT}) AS BIGINT) AS cost FROM ("
        "SELECT word, any_value(f.n) AS n, "
        f"round(min(log2(f.n) - log2(a.n) - log2(b.n)) + log2({total}), {EXACT}) AS cohesion, "
        "any_value(freedom) AS freedom FROM (SELECT gram AS word, n, "
        f"round(log2(n) - coalesce(most, 0.0) / n, {EXACT}) AS freedom, "
        "unnest(range(1, length(gram))) AS place FROM grams LEFT JOIN "
        f"(SELECT word, max(bits) AS most FROM ({ends}) GROUP BY word) e ON e.word = gram "
        f"WHERE n >= {min_count} AND length(gram) BETWEEN 2 AND {max_length}) f "
        "JOIN grams a ON a.gram = substr(word, 1, CAST(place AS BIGINT)) "
        "JOIN grams b ON b.gram = substr(word, CAST(place AS BIGINT) + 1) "
        f"WHERE freedom >= {min_freedom} GROUP BY word HAVING cohesion >= {min_cohesion} "
        "UNION ALL SELECT gram, n, NULL, NULL FROM grams WHERE length(gram) = 1)"
    )


def _best_cuts(longest: int) -> str:
    """The words of each distinct run on its cheapest way, one letter after the other.

    The state holds, for the last ends, the least cost and the way there; among equal ones the shorter last word wins.
    """
    sizes = f"range(1, {longest + 1})"
    far = 1 << 40
    ways = f"list_transform({sizes}, lambda j: a.c[j] + x.e[j])"
    best = f"list_min({ways})"
    size = f"list_position({ways}, {best})"
    step = (
        f"lambda a, x: {{'c': list_concat([{best}], a.c[:{longest - 1}]), "
        f"'p': list_concat([a.p[{size}] || ' ' || right(x.t, {size})], a.p[:{longest - 1}]), 'e': x.e, 't': x.t}}"
    )
    none = ", ".join([str(far)] * (longest - 1))
    start = (
        f"{{'c': CAST([0, {none}] AS BIGINT[]), 'p': list_transform({sizes}, lambda j: ''), "
        "'e': CAST([] AS BIGINT[]), 't': ''}"
    )
    edge = "{'c': CAST([] AS BIGINT[]), 'p': CAST([] AS VARCHAR[]), 'e': e, 't': t}"
    return (
        f"SELECT run, string_split(trim(list_reduce(list_concat([{start}], list({edge} ORDER BY place)), {step}).p[1]), ' ') "
        f"AS words FROM (SELECT run, place, list(coalesce(cost, {far}) ORDER BY size) AS e, any_value(t) AS t FROM ("
        "SELECT run, place, size, cost, "
        f"substr(run, greatest(place - {longest - 1}, 1), least(place, {longest})) AS t FROM (SELECT run, place, size, "
        "CASE WHEN size <= place THEN substr(run, place - size + 1, size) END AS part FROM (SELECT run, "
        "CAST(unnest(range(1, length(run) + 1)) AS BIGINT) AS place FROM distinct_runs) "
        f"CROSS JOIN {sizes} s(size)) LEFT JOIN vocabulary ON word = part) GROUP BY run, place) GROUP BY run"
    )


def _tfidf(counts: str) -> str:
    return (
        f"SELECT c.item_id, c.key_word, c.word_count / t.total * log10(n.n / d.df) AS tfidf FROM {counts} c "
        f"JOIN (SELECT item_id, sum(word_count) AS total FROM {counts} GROUP BY 1) t ON t.item_id = c.item_id "
        f"JOIN (SELECT key_word, count(*) AS df FROM {counts} GROUP BY 1) d ON d.key_word = c.key_word "
        f"CROSS JOIN (SELECT count(DISTINCT item_id) AS n FROM {counts}) n"
    )


def _top(weights: str, k: int = 30) -> str:
    return (
        f"SELECT key_word, sum(tfidf) AS weight FROM {weights} GROUP BY 1 "
        f"ORDER BY {_first_digits('sum(tfidf)')} DESC, key_word LIMIT {k}"
    )


def _item_text(weights: str) -> str:
    return (
        f"SELECT item_id, key_word, tfidf AS val FROM {weights} "
        f"WHERE key_word IN (SELECT key_word FROM ({_top(weights)}))"
    )


def _user_text(actions: str, item_text: str) -> str:
    return (
        f"SELECT a.user_id, t.key_word, sum(a.val * t.val) AS val FROM {actions} a "
        f"JOIN {item_text} t ON t.item_id = a.item_id WHERE t.val <> 0 AND a.val <> 0 GROUP BY 1, 2"
    )


def _cosine(user_text: str, item_text: str) -> str:
    """(user_id, item_id, sim) of all pairs that share a word."""
    norm = "sqrt(sum(val * val)) AS norm"
    return (
        "SELECT u.user_id, i.item_id, sum(u.val * i.val) / any_value(nu.norm * ni.norm) AS sim "
        f"FROM {user_text} u JOIN {item_text} i ON i.key_word = u.key_word "
        f"JOIN (SELECT user_id, {norm} FROM {user_text} GROUP BY 1) nu ON nu.user_id = u.user_id "
        f"JOIN (SELECT item_id, {norm} FROM {item_text} GROUP BY 1) ni ON ni.item_id = i.item_id "
        "WHERE nu.norm * ni.norm > 0 GROUP BY 1, 2"
    )


def _shared_tags(user_tags: str, item_tags: str) -> str:
    return (
        f"SELECT u.user_id, i.item_id, count(*) AS shared FROM {user_tags} u "
        f"JOIN {item_tags} i ON i.tag_id = u.tag_id GROUP BY 1, 2"
    )


GEO = (
    "CASE WHEN u.province = i.province THEN 1.0 / 3 ELSE 0.0 END "
    "+ CASE WHEN u.city = i.city THEN 2.0 / 3 ELSE 0.0 END"
)


def _top_list(scores: str, value: str, k: int = LIST_SIZE) -> str:
    return (
        "SELECT user_id, row_number() OVER (PARTITION BY user_id "
        f"ORDER BY {_first_digits(value)} DESC, item_id) AS pos, item_id, {value} FROM {scores} "
        f"QUALIFY pos <= {k}"
    )


PARTS: dict[str, str] = {
    "places": "SELECT n_nationkey, r_name AS province, n_name AS city FROM nation "
    "JOIN region ON n_regionkey = r_regionkey",
    "users": "SELECT c_custkey AS uid, c_name AS username, c_mktsegment AS role, province, city "
    "FROM customer JOIN places ON c_nationkey = n_nationkey",
    "products": "SELECT p_partkey AS id, p_name AS name, p_brand || ' ' || p_type AS description, "
    "p_type AS category, p_retailprice AS price FROM part",
    "product_places": "SELECT l_partkey AS id, province, city FROM "
    "(SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1) "
    "JOIN supplier ON s_suppkey = s JOIN places ON s_nationkey = n_nationkey",
    "posts": "SELECT doc_id AS id, split_part(text, chr(10), 1) AS name, "
    "CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END "
    "AS description, lang AS category, source FROM documents",
    "ev": "SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, "
    "event_type, CAST(ts AS DATE) AS day FROM events",
    "tags": "SELECT DISTINCT category_id || ':' || tag_name AS tag_id, tag_name, category_id FROM ("
    "SELECT 1 AS category_id, p_brand AS tag_name FROM part UNION ALL SELECT 2, p_type FROM part "
    "UNION ALL SELECT 3, CAST(p_size AS VARCHAR) FROM part)",
    "product_tags": "SELECT p_partkey AS item_id, '1:' || p_brand AS tag_id FROM part UNION ALL "
    "SELECT p_partkey, '2:' || p_type FROM part UNION ALL SELECT p_partkey, '3:' || p_size FROM part",
    "bought": "SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey",
    "user_product_tags": "SELECT DISTINCT user_id, tag_id FROM bought "
    "JOIN product_tags ON bought.item_id = product_tags.item_id",
    "post_tags": "SELECT doc_id AS item_id, 'lang:' || lang AS tag_id FROM documents UNION ALL "
    "SELECT doc_id, 'source:' || source FROM documents",
    "seen_posts": "SELECT DISTINCT user_id, item_id FROM ev JOIN documents ON doc_id = item_id",
    "user_post_tags": "SELECT DISTINCT user_id, tag_id FROM seen_posts s "
    "JOIN post_tags t ON t.item_id = s.item_id",
    "unspaced_runs": "SELECT item_id, field, unnest(regexp_extract_all(lower(regexp_replace(t, "
    "'[\\x20\\x09-\\x0D]+', '', 'g')), '\\p{L}+')) AS run FROM (SELECT id AS item_id, 1 AS field, name AS t FROM posts "
    "UNION ALL SELECT id, 2, description FROM posts)",
    "distinct_runs": "SELECT run, count(*) AS k FROM unspaced_runs GROUP BY run",
    "grams": _unspaced_grams(UNSPACED["max_length"]),
    "vocabulary": _vocabulary(**UNSPACED),
    "best_cuts": _best_cuts(UNSPACED["max_length"]),
    "unspaced_counts": "SELECT item_id, key_word, count(*) AS word_count FROM (SELECT DISTINCT item_id, field, "
    "unnest(words) AS key_word FROM unspaced_runs JOIN best_cuts ON best_cuts.run = unspaced_runs.run) GROUP BY 1, 2",
    "stopwords": f"SELECT key_word FROM (SELECT unnest({WORDS.format('text')}) AS key_word "
    f"FROM documents) GROUP BY 1 ORDER BY count(*) DESC, key_word LIMIT {N_STOPWORDS}",
    "item_scores": _item_score(RUN_DATE),
    "item_scores_before": _item_score(FEED_DATE),
    "user_scores": "SELECT u.uid AS user_id, coalesce(s.score, 0.0) AS score FROM users u LEFT JOIN "
    f"({_decayed('user_id', RUN_DATE, 'score')}) s ON s.user_id = u.uid",
    "cells": _decayed("user_id, item_id", RUN_DATE, "val"),
    "cells_before": _decayed("user_id, item_id", FEED_DATE, "val"),
    "actions": "SELECT * FROM cells WHERE item_id IN (SELECT id FROM products)",
    "actions_before": "SELECT * FROM cells_before WHERE item_id IN (SELECT id FROM products)",
    "post_actions": "SELECT * FROM cells WHERE item_id IN (SELECT id FROM posts)",
    "ranked": "SELECT item_id, category, score, row_number() OVER (PARTITION BY category "
    f"ORDER BY {_first_digits('score')} DESC, item_id) AS rn FROM item_scores JOIN products ON id = item_id",
    "title_counts": _count("posts", ["name"], True),
    "content_counts": _count("posts", ["description"], True),
    "product_counts": _count("products", ["name", "description"], False),
    "title_tfidf": _tfidf("title_counts"),
    "content_tfidf": _tfidf("content_counts"),
    "product_tfidf": _tfidf("product_counts"),
    "title_items": _item_text("title_tfidf"),
    "content_items": _item_text("content_tfidf"),
    "product_items": _item_text("product_tfidf"),
    "title_users": _user_text("post_actions", "title_items"),
    "content_users": _user_text("post_actions", "content_items"),
    "product_users": _user_text("actions", "product_items"),
    "title_cos": _cosine("title_users", "title_items"),
    "content_cos": _cosine("content_users", "content_items"),
    "product_cos": _cosine("product_users", "product_items"),
    "shared_product_tags": _shared_tags("user_product_tags", "product_tags"),
    "shared_post_tags": _shared_tags("user_post_tags", "post_tags"),
    "product_sims": f"SELECT u.uid AS user_id, p.id AS item_id, (5 * ({GEO}) "
    "+ 3 * coalesce(t.shared, 0) / (SELECT count(*) FROM tags) + coalesce(c.sim, 0.0)) / 9 AS sim "
    "FROM users u CROSS JOIN products p LEFT JOIN product_places i ON i.id = p.id "
    "LEFT JOIN shared_product_tags t ON t.user_id = u.uid AND t.item_id = p.id "
    "LEFT JOIN product_cos c ON c.user_id = u.uid AND c.item_id = p.id",
    "post_sims": "SELECT u.uid AS user_id, p.id AS item_id, "
    "(3 * coalesce(t.shared, 0) / (SELECT count(DISTINCT tag_id) FROM post_tags) "
    "+ 4 * coalesce(a.sim, 0.0) + 7 * coalesce(b.sim, 0.0)) / 14 AS sim "
    "FROM users u CROSS JOIN posts p "
    "LEFT JOIN shared_post_tags t ON t.user_id = u.uid AND t.item_id = p.id "
    "LEFT JOIN title_cos a ON a.user_id = u.uid AND a.item_id = p.id "
    "LEFT JOIN content_cos b ON b.user_id = u.uid AND b.item_id = p.id",
    "item_vectors": "SELECT vec_id, embedding::DOUBLE[] AS vec FROM embeddings",
    "item_cosines": "SELECT a.vec_id AS id, b.vec_id AS neighbour_id, list_cosine_similarity(a.vec, b.vec) AS sim "
    "FROM item_vectors a JOIN item_vectors b ON a.vec_id <> b.vec_id",
    "item_near": "SELECT id, row_number() OVER (PARTITION BY id ORDER BY "
    f"{_first_digits('sim')} DESC, neighbour_id) AS pos, neighbour_id, sim FROM item_cosines QUALIFY pos <= {LIST_SIZE}",
    "near_scores": "SELECT user_id, neighbour_id AS item_id, sum(val * sim) AS score FROM actions "
    "JOIN item_near ON id = item_id GROUP BY 1, 2",
    "near_scores_before": "SELECT user_id, neighbour_id AS item_id, sum(val * sim) AS score "
    "FROM actions_before JOIN item_near ON id = item_id GROUP BY 1, 2",
    "near_lists": _top_list("near_scores", "score"),
    "near_lists_before": _top_list("near_scores_before", "score"),
    "old_scores": _item_score(OLD_DATE),
    "feed": "SELECT uid AS user_id, item_id, pos, 'list_based' AS rec_algo FROM users CROSS JOIN "
    f"(SELECT item_id, row_number() OVER (ORDER BY {_first_digits('score')} DESC, item_id) AS pos "
    f"FROM item_scores_before QUALIFY pos <= {LIST_SIZE}) UNION ALL "
    "SELECT user_id, item_id, pos, 'cf_based' FROM near_lists_before",
    "acted": f"SELECT DISTINCT user_id, item_id FROM ev WHERE day >= DATE '{ACTION_DATE}'",
}


# Subqueries of several readers, computed once.
STORED = ("actions", "item_vectors", "item_near", "item_pairs", "distinct_runs", "grams", "vocabulary")


def _with(body: str) -> str:
    """The statement preceded by the named subqueries it uses, in the order of ``PARTS``."""

    def used(sql: str) -> set[str]:
        return {name for name in PARTS if re.search(rf"\b(?:FROM|JOIN) {name}\b", sql)}

    needed: set[str] = set()
    todo = used(body)
    while todo:
        needed |= todo
        todo = set().union(*(used(PARTS[name]) for name in todo)) - needed
    once = lambda name: "MATERIALIZED " if name in STORED else ""
    parts = ", ".join(f"{name} AS {once(name)}({sql})" for name, sql in PARTS.items() if name in needed)
    return f"WITH {parts} {body}" if parts else body


def _r(expression: str, name: str | None = None) -> str:
    return f"round({expression}, {DIGITS}) + 0.0 AS {name or expression}"


DAY = f"'{RUN_DATE}' AS date"
SCORE = _r("score")


def _sorted_set(prefix: str, key: str, value: str, source: str) -> str:
    return (
        f"SELECT '{prefix}' || {key} AS key, CAST(item_id AS VARCHAR) AS member, {_r(value, 'score')} "
        f"FROM {source}"
    )


def _activity(key: str, scores: str) -> str:
    shares = ", ".join(
        f"round(CASE WHEN n IS NULL THEN NULL ELSE n_{t} / n END, {DIGITS}) + 0.0 AS share_{t}"
        for t in EVENT_TYPES
    )
    counts = ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in EVENT_TYPES)
    return (
        f"SELECT s.{key}, {SCORE}, coalesce(n, 0) AS events, coalesce(active_days, 0) AS active_days, "
        "coalesce(first_day, 'never') AS first_day, coalesce(last_day, 'never') AS last_day, "
        f"{shares} FROM {scores} s LEFT JOIN (SELECT {key}, count(*) AS n, "
        "count(DISTINCT day) AS active_days, CAST(min(day) AS VARCHAR) AS first_day, "
        f"CAST(max(day) AS VARCHAR) AS last_day, {counts} FROM ev GROUP BY 1) e ON e.{key} = s.{key}"
    )


def _quantiles(scores: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS probability, round(quantile_disc({_first_digits('score')}, {q}), {DIGITS}) + 0.0 AS score "
        f"FROM {scores}"
        for q in QUARTILES
    )


def _counts(source: str) -> str:
    return (
        "SELECT item_id, key_word, CAST(word_count AS INTEGER) AS word_count, "
        "CAST(sum(word_count) OVER (PARTITION BY item_id) AS INTEGER) AS word_total "
        f"FROM {source}"
    )


def _cosine_of_pairs(pairs: str, entity: str, across: str) -> str:
    norm = f"(SELECT {entity}, sqrt(sum(val * val)) AS norm FROM actions GROUP BY 1)"
    return (
        f"SELECT p.id, p.other_id, coalesce(s.sim, 0.0) AS sim FROM ({pairs}) p LEFT JOIN ("
        f"SELECT q.id, q.other_id, sum(a.val * b.val) / any_value(na.norm * nb.norm) AS sim FROM ({pairs}) q "
        f"JOIN actions a ON a.{entity} = q.id JOIN actions b ON b.{entity} = q.other_id AND b.{across} = a.{across} "
        f"JOIN {norm} na ON na.{entity} = q.id JOIN {norm} nb ON nb.{entity} = q.other_id GROUP BY 1, 2) s "
        "ON s.id = p.id AND s.other_id = p.other_id"
    )


def _pair_cosine(pairs: str, entity: str, across: str) -> str:
    return f"SELECT id, other_id, {_r('sim')} FROM ({_cosine_of_pairs(pairs, entity, across)})"


def _near_by_actions(entity: str, across: str) -> str:
    """All pairs with a common row of the action matrix, the best few of each."""
    return (
        f"SELECT id, row_number() OVER (PARTITION BY id ORDER BY {_first_digits('sim')} DESC, neighbour_id) AS pos, "
        f"neighbour_id, sim FROM (SELECT a.{entity} AS id, b.{entity} AS neighbour_id, "
        f"sum(a.val * b.val) / any_value(na.norm * nb.norm) AS sim FROM actions a "
        f"JOIN actions b ON a.{across} = b.{across} AND a.{entity} <> b.{entity} "
        f"JOIN {entity}_norms na ON na.id = a.{entity} JOIN {entity}_norms nb ON nb.id = b.{entity} GROUP BY 1, 2) "
        f"WHERE sim > 0 QUALIFY pos <= {LIST_SIZE}"
    )


for _side, _other in (("item_id", "user_id"), ("user_id", "item_id")):
    PARTS[f"{_side}_norms"] = f"SELECT {_side} AS id, sqrt(sum(val * val)) AS norm FROM actions GROUP BY 1"
    PARTS[f"{_side}_near"] = _near_by_actions(_side, _other)
PARTS["index_scores"] = (
    "SELECT u.user_id, i.item_id, sum(u.val * i.val) AS score FROM content_users u "
    "JOIN content_items i ON i.key_word = u.key_word WHERE u.val > 0 AND i.val > 0 GROUP BY 1, 2"
)
PARTS["index_lists"] = _top_list("index_scores", "score")
PARTS["item_pairs"] = "SELECT id, neighbour_id AS other_id FROM item_near"
PARTS["action_scores"] = (
    "SELECT user_id, neighbour_id AS item_id, sum(val * sim) AS score FROM actions "
    "JOIN item_id_near ON id = item_id GROUP BY 1, 2"
)
PARTS["action_lists"] = _top_list("action_scores", "score")

_LIST_CHECK = (
    f"SELECT user_id, least({CF_SIZE}, (SELECT count(DISTINCT item_id) FROM actions)) AS items, "
    f"least({CF_SIZE}, (SELECT count(DISTINCT item_id) FROM actions)) AS distinct_items, "
    "true AS known, true AS matching, true AS ordered FROM actions GROUP BY 1"
)


def _similar_check(side: str) -> str:
    n = f"least({CF_SIZE}, (SELECT count(DISTINCT {side}_id) FROM actions) - 1)"
    return (
        f"SELECT {side}_id AS id, {n} AS neighbours, {n} AS others, true AS cosines, '{side}' AS side "
        "FROM actions GROUP BY 1"
    )


STATEMENTS: dict[str, str] = {
    # sources
    "user_snapshot": f"SELECT uid, username, role, province, city, {DAY} FROM users",
    "item_snapshot": "SELECT id, name, description, category, "
    f"CAST(CAST(price AS DECIMAL(10, 2)) AS DOUBLE) AS price, {DAY} FROM products",
    "event_snapshot": "SELECT event_id, user_id, item_id, event_type, CAST(day AS VARCHAR) AS timestamp, "
    f"{DAY} FROM ev",
    "tag_dimension_snapshot": "SELECT tag_id, tag_name, t.category_id, "
    f"coalesce(k.name, 'unknown') AS category_name, {DAY} FROM tags t LEFT JOIN (SELECT DISTINCT category_id AS id, "
    "CASE category_id WHEN 1 THEN 'brand' WHEN 2 THEN 'type' ELSE 'size' END AS name FROM tags) k "
    "ON k.id = t.category_id",
    "item_tag_snapshot": f"SELECT item_id, tag_id, CAST(0.65 AS DOUBLE) AS weight, {DAY} FROM product_tags",
    "user_tag_snapshot": f"SELECT user_id, tag_id, {DAY} FROM user_product_tags",
    "feed_snapshot": f"SELECT user_id, item_id, rec_algo, '{FEED_DATE}' AS timestamp, '{FEED_DATE}' AS date "
    "FROM feed",
    "categories": "SELECT DISTINCT category FROM products",
    "snapshot_rewrite": f"SELECT item_id, {SCORE}, '{FEED_DATE}' AS date FROM item_scores_before UNION ALL "
    f"SELECT item_id, {SCORE}, {DAY} FROM item_scores",
    "snapshot_rewrite_empty": f"SELECT item_id, {SCORE}, '{FEED_DATE}' AS date FROM item_scores_before",
    # scores and the action matrix
    "weighted_events": "SELECT event_id, user_id, item_id, event_type, CAST(day AS VARCHAR) AS day, "
    f"CAST({WEIGHT} AS DOUBLE) AS weight FROM ev",
    "item_score": f"SELECT item_id, {SCORE}, {DAY} FROM item_scores",
    "item_score_incremental": f"SELECT item_id, {SCORE} FROM ({_decayed('item_id', RUN_DATE, 'score')})",
    "item_score_late": f"SELECT item_id, {SCORE} FROM (SELECT item_id, "
    f"sum({WEIGHT} * power({GAMMA}, date_diff('day', day, DATE '{RUN_DATE}'))) AS score FROM ev "
    f"WHERE day + CAST(event_id % 5 AS INTEGER) <= DATE '{RUN_DATE}' AND {WEIGHT} > 0 GROUP BY 1)",
    "user_score": f"SELECT user_id, {SCORE}, {DAY} FROM user_scores",
    "user_level": f"SELECT user_id, {SCORE}, {DAY}, "
    f"CAST(ntile(4) OVER (ORDER BY {_first_digits('score')}, user_id) AS INTEGER) AS level FROM user_scores",
    "user_level_by_threshold": f"SELECT user_id, {SCORE}, {DAY}, CAST(1"
    + "".join(f" + CASE WHEN score >= {t} THEN 1 ELSE 0 END" for t in LEVEL_THRESHOLDS)
    + " AS INTEGER) AS level FROM user_scores",
    "action_matrix": f"SELECT user_id, item_id, {_r('val')}, {DAY} FROM actions",
    "action_matrix_of_category": f"SELECT user_id, item_id, {_r('val')}, {DAY} FROM cells WHERE item_id IN "
    f"(SELECT id FROM posts WHERE category = '{POSTS_LANGUAGE}') AND user_id IN (SELECT uid FROM users)",
    "matrix_cells": f"SELECT b.user_id, b.item_id, {_r('coalesce(a.val, 0.0)', 'val')} FROM bought b "
    "LEFT JOIN actions a ON a.user_id = b.user_id AND a.item_id = b.item_id",
    # rankings
    "rank_items": f"SELECT item_id, category, {SCORE}, rn, {DAY} FROM ranked",
    "rank_items_old_events": "SELECT item_id, category, row_number() OVER (PARTITION BY category "
    f"ORDER BY {_first_digits('score')} DESC, item_id) AS rn FROM old_scores JOIN products ON id = item_id",
    "fresh_list": f"SELECT item_id, category, {SCORE}, rn, {DAY} FROM ranked WHERE ranked.score < 10",
    "hot_list": f"SELECT item_id, category, {SCORE}, rn, {DAY} FROM ranked "
    "WHERE rn <= 30 AND ranked.score >= 10",
    "top_n": f"SELECT item_id, category, {SCORE}, rn FROM ranked WHERE rn <= 80",
    "bottom_m": f"SELECT item_id, category, {SCORE}, rn FROM ranked "
    "QUALIFY max(rn) OVER (PARTITION BY category) - rn < 200",
    # text
    "word_count_combined": _counts(f"({_count('posts', ['name', 'description'], True)})"),
    "word_count_title": _counts("title_counts"),
    "word_count_content": _counts("content_counts"),
    "word_count_unspaced": _counts("unspaced_counts"),
    "unspaced_vocabulary": f"SELECT word, CAST(n AS BIGINT) AS n, {_r('cohesion')}, {_r('freedom')}, cost FROM vocabulary",
    "idf": "SELECT key_word, count(*) AS item_num_has_word, any_value(n) AS item_num_all, "
    f"{_r('log10(any_value(n) / count(*))', 'idf')} FROM content_counts "
    "CROSS JOIN (SELECT count(DISTINCT item_id) AS n FROM content_counts) GROUP BY 1",
    "tf": f"SELECT item_id, key_word, {_r('word_count / sum(word_count) OVER (PARTITION BY item_id)', 'tf')} "
    "FROM content_counts",
    "tfidf": f"SELECT item_id, key_word, {_r('tfidf')} FROM content_tfidf",
    "top_keywords": f"SELECT key_word FROM ({_top('content_tfidf')})",
    "hot_words": f"SELECT key_word, {_r('weight')} FROM ({_top('product_tfidf', 20)})",
    "inverse_index": f"SELECT key_word, item_id, {_r('tfidf')} FROM content_tfidf WHERE content_tfidf.tfidf > 0",
    "item_text_feature": f"SELECT item_id, key_word, {_r('val')} FROM content_items "
    f"WHERE item_id IN (SELECT id FROM posts WHERE category = '{POSTS_LANGUAGE}')",
    "user_text_feature": f"SELECT user_id, key_word, {_r('val')} FROM content_users",
    # features
    "geo_feature_user": f"SELECT uid AS user_id, province, city, {DAY} FROM users",
    "geo_feature_item": f"SELECT id AS item_id, province, city, {DAY} FROM product_places",
    "tag_feature_user": f"SELECT user_id, tag_id, 1 AS has, {DAY} FROM user_product_tags",
    "tag_feature_item": f"SELECT DISTINCT item_id, tag_id, 1 AS has, {DAY} FROM product_tags",
    "tag_presence": "SELECT p.user_id, p.tag_id, CASE WHEN a.tag_id IS NULL THEN 0 ELSE 1 END AS has "
    "FROM user_product_tags p LEFT JOIN (SELECT DISTINCT user_id, tag_id FROM actions "
    "JOIN product_tags ON product_tags.item_id = actions.item_id) a "
    "ON a.user_id = p.user_id AND a.tag_id = p.tag_id",
    # similarities and lists
    "geo_similarity": f"SELECT b.user_id, b.item_id, {_r(GEO, 'sim')} FROM bought b "
    "LEFT JOIN users u ON u.uid = b.user_id LEFT JOIN product_places i ON i.id = b.item_id",
    "tag_similarity": "SELECT b.user_id, b.item_id, "
    f"{_r('coalesce(t.shared, 0) / (SELECT count(*) FROM tags)', 'sim')} FROM bought b "
    "LEFT JOIN shared_product_tags t ON t.user_id = b.user_id AND t.item_id = b.item_id",
    "text_similarity": f"SELECT s.user_id, s.item_id, {_r('coalesce(c.sim, 0.0)', 'sim')} FROM seen_posts s "
    "LEFT JOIN content_cos c ON c.user_id = s.user_id AND c.item_id = s.item_id",
    "embedding_cosine": "SELECT p.user_id, p.item_id, "
    f"{_r('list_cosine_similarity(u.embedding::DOUBLE[], i.embedding::DOUBLE[])', 'sim')} "
    "FROM (SELECT DISTINCT user_id, item_id FROM ev) p LEFT JOIN embeddings u ON u.vec_id = p.user_id "
    "LEFT JOIN embeddings i ON i.vec_id = p.item_id",
    "product_similarity": f"SELECT b.user_id, b.item_id, {_r('p.sim', 'sim')} FROM bought b "
    "JOIN product_sims p ON p.user_id = b.user_id AND p.item_id = b.item_id",
    "post_similarity": f"SELECT b.user_id, b.item_id, {_r('p.sim', 'sim')} FROM seen_posts b "
    "JOIN post_sims p ON p.user_id = b.user_id AND p.item_id = b.item_id",
    "blend_of_parts": f"SELECT b.user_id, b.item_id, round((5 * ({GEO}) "
    f"+ 3 * coalesce(t.shared, 0) / (SELECT count(*) FROM tags)) / 8, {DIGITS}) + 0.0 AS sim FROM bought b "
    "LEFT JOIN users u ON u.uid = b.user_id LEFT JOIN product_places i ON i.id = b.item_id "
    "LEFT JOIN shared_product_tags t ON t.user_id = b.user_id AND t.item_id = b.item_id",
    "content_based_products": f"SELECT user_id, pos, item_id, {_r('sim')} FROM ({_top_list('product_sims', 'sim')})",
    "content_based_posts": f"SELECT user_id, pos, item_id, {_r('sim')} FROM ({_top_list('post_sims', 'sim')})",
    # collaborative filtering
    "item_neighbours": f"SELECT id, pos, neighbour_id, {_r('sim')} FROM item_near",
    "user_neighbours": "SELECT id, pos, neighbour_id, " + _r("sim") + " FROM ("
    "SELECT a.user_id AS id, b.user_id AS neighbour_id, "
    "count(b.tag_id) FILTER (WHERE a.tag_id = b.tag_id) / sqrt(any_value(a.n) * any_value(b.n)) AS sim, "
    f"row_number() OVER (PARTITION BY a.user_id ORDER BY {_first_digits('count(*) / sqrt(any_value(a.n) * any_value(b.n))')} "
    "DESC, b.user_id) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM user_product_tags) a "
    "JOIN (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM user_product_tags) b "
    f"ON a.tag_id = b.tag_id AND a.user_id <> b.user_id GROUP BY 1, 2 QUALIFY pos <= {LIST_SIZE})",
    "item_pair_cosine": _pair_cosine("SELECT * FROM item_pairs", "item_id", "user_id"),
    "user_pair_cosine": _pair_cosine("SELECT uid AS id, uid + 1 AS other_id FROM users", "user_id", "item_id"),
    "index_top_k": f"SELECT user_id, pos, item_id, {SCORE} FROM index_lists",
    "action_item_neighbours": f"SELECT id, pos, neighbour_id, {_r('sim')} FROM item_id_near",
    "action_user_neighbours": f"SELECT id, pos, neighbour_id, {_r('sim')} FROM user_id_near",
    "action_neighbourhood_list": f"SELECT user_id, pos, item_id, {SCORE} FROM action_lists",
    "als_factor_check": f"SELECT DISTINCT 'user' AS side, user_id AS id, {RANK} AS factors FROM actions UNION ALL "
    f"SELECT DISTINCT 'item', item_id, {RANK} FROM actions",
    "als_fit_check": "SELECT count(*) AS cells, true AS better_than_mean FROM actions WHERE val <> 0",
    "als_split_check": "SELECT count(*) AS cells, true AS better_than_mean, true AS as_good_as_als, "
    "count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items FROM actions WHERE val <> 0",
    "als_similarity_check": f"{_similar_check('item')} UNION ALL {_similar_check('user')}",
    "als_implicit_check": _LIST_CHECK,
    "cf_list_check": _LIST_CHECK,
    "neighbourhood_list": f"SELECT user_id, pos, item_id, {SCORE} FROM near_lists",
    # cache rows
    "sorted_set_hot": _sorted_set(
        "item-hot-list-", "category", "score", "ranked WHERE rn <= 30 AND ranked.score >= 10"
    ),
    "sorted_set_fresh": _sorted_set("item-fresh-list-", "category", "score", "ranked WHERE ranked.score < 10"),
    "sorted_set_index": _sorted_set(
        "item-inverse-index-", "key_word", "tfidf", "product_tfidf WHERE tfidf > 0"
    ),
    "sorted_set_user_score": f"SELECT 'user-score-' || (user_id % {USER_SHARDS}) AS key, "
    f"CAST(user_id AS VARCHAR) AS member, {SCORE} FROM user_scores",
    "list_rows": "SELECT 'content_based_product_user_' || user_id AS key, CAST(pos - 1 AS INTEGER) AS pos, "
    "CAST(item_id AS VARCHAR) AS member FROM near_lists",
    # evaluation and analysis
    "evaluate_feed": "SELECT k.item_category, k.rec_algo, "
    f"round(CASE WHEN shown > 0 THEN hits / shown END, {DIGITS}) + 0.0 AS precision, "
    f"round(CASE WHEN n_acted > 0 THEN coalesce(hits, 0) / n_acted END, {DIGITS}) + 0.0 AS recall, "
    "round(CASE WHEN shown > 0 AND n_acted > 0 AND hits > 0 THEN 2 * (hits / shown) * (hits / n_acted) "
    f"/ (hits / shown + hits / n_acted) END, {DIGITS}) + 0.0 AS f1, '{ACTION_DATE}' AS date FROM "
    "(SELECT DISTINCT category AS item_category, a AS rec_algo FROM products CROSS JOIN (VALUES "
    + ", ".join(f"('{a}')" for a in REC_ALGORITHMS)
    + ") v(a)) k LEFT JOIN (SELECT category, rec_algo, count(*) AS shown, count(t.item_id) AS hits "
    "FROM (SELECT DISTINCT user_id, item_id, rec_algo FROM feed) f JOIN products p ON p.id = f.item_id "
    "LEFT JOIN acted t ON t.user_id = f.user_id AND t.item_id = f.item_id GROUP BY 1, 2) s "
    "ON s.category = k.item_category AND s.rec_algo = k.rec_algo LEFT JOIN (SELECT category, count(*) AS n_acted "
    "FROM acted JOIN products ON id = item_id GROUP BY 1) d ON d.category = k.item_category",
    "map_at_k": f"SELECT rec_algo, {_r('avg(ap)', 'map_at_k')}, count(*) AS users FROM "
    "(SELECT h.user_id, rec_algo, sum(hit * so_far / pos) / least(any_value(n), "
    f"{LIST_SIZE}) AS ap FROM (SELECT f.*, CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END AS hit, "
    "sum(CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY f.user_id, f.rec_algo ORDER BY pos) "
    "AS so_far FROM feed f LEFT JOIN acted t ON t.user_id = f.user_id AND t.item_id = f.item_id) h "
    "JOIN (SELECT user_id, count(*) AS n FROM acted GROUP BY 1) r ON r.user_id = h.user_id GROUP BY 1, 2) "
    "GROUP BY 1",
    "user_coverage": "SELECT rec_algo, count(DISTINCT user_id) AS users_covered, "
    "(SELECT count(*) FROM users) AS users_all, "
    f"{_r('count(DISTINCT user_id) / (SELECT count(*) FROM users)', 'coverage')} FROM feed GROUP BY 1",
    "analyze_users": _activity("user_id", "user_scores"),
    "analyze_items": _activity("item_id", "item_scores"),
    "user_score_quantiles": _quantiles("user_scores"),
    "item_score_quantiles": _quantiles("item_scores"),
}

ORACLES: dict[str, str] = {name: _with(sql) for name, sql in STATEMENTS.items()}
