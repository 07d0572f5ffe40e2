"""Rows for a key-value cache, and writers that push them from the executors.

``make_client`` is a function without arguments, called once per partition, that returns a client
with the usual ``zadd(key, {member: score})``, ``delete(key)``, ``rpush(key, *members)``,
``exists(key)``, ``rename(key, new)`` and ``close()``.

What a reader sees of a key changes at once: members go to a key of their own run first, which then
takes the name of the old one, so nothing that left the table stays in the cache. Every push can be
repeated, so a retried task does no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.session import ship_functions

ship_functions(__name__)

# The key formats readers of the cache expect.
HOT_LIST_KEY = "item-hot-list-"
FRESH_LIST_KEY = "item-fresh-list-"
INVERSE_INDEX_KEY = "item-inverse-index-"
CONTENT_LIST_KEY = "content_based_{category}_user_"
# Own value: the scores of users, in as many sorted sets as it takes to keep each one bounded.
USER_SCORE_KEY = "user-score-"



def _key(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def to_sorted_set_rows(
    df: DataFrame, prefix: str, key_col: str, member: str, score: str
) -> DataFrame:
    """(key, member, score): one sorted set per value of ``key_col``."""
    return df.select(
        _key(prefix, F.col(key_col)).alias("key"),
        F.col(member).cast("string").alias("member"),
        F.col(score).cast("double").alias("score"),
    )


def to_list_rows(df: DataFrame, prefix: str, user: str, items: str) -> DataFrame:
    """(key, pos, member): the list of each user, positions from 0."""
    return df.select(
        _key(prefix, F.col(user)).alias("key"), F.posexplode(items).alias("pos", "member")
    ).select("key", "pos", F.col("member").cast("string").alias("member"))


def _in_chunks(rows: Iterator[Any], size: int) -> Iterator[list[Any]]:
    chunk: list[Any] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def _each_partition(rows: DataFrame, make_client: Callable[[], Any], push: Callable[..., None]) -> None:
    def run(part: Iterator[Any]) -> None:
        client = make_client()
        try:
            push(client, part)
        finally:
            client.close()

    rows.foreachPartition(run)


def push_sorted_sets(
    rows: DataFrame,
    make_client: Callable[[], Any],
    run: str,
    chunk: int = 1000,
    keys: DataFrame | None = None,
) -> None:
    """Replace the sorted sets by ``to_sorted_set_rows`` output, grouping a key's members within a chunk.

    ``run`` names this push, the run date for instance. ``keys`` are all keys that may be in the cache;
    those without rows now are deleted.
    """

    def add(client: Any, part: Iterator[Any]) -> None:
        for batch in _in_chunks(part, chunk):
            by_key: dict[str, dict[str, float]] = {}
            for row in batch:
                by_key.setdefault(row["key"], {})[row["member"]] = row["score"]
            for key, members in by_key.items():
                client.zadd(f"{key}:{run}", members)

    def switch(client: Any, part: Iterator[Any]) -> None:
        for row in part:
            # a repeated task finds the key renamed already
            if client.exists(f"{row['key']}:{run}"):
                client.rename(f"{row['key']}:{run}", row["key"])

    def forget(client: Any, part: Iterator[Any]) -> None:
        for row in part:
            client.delete(row["key"])

    pushed = rows.select("key").distinct()
    # what a push of the same name left when it broke off
    _each_partition(pushed.select(F.concat("key", F.lit(f":{run}")).alias("key")), make_client, forget)
    _each_partition(rows, make_client, add)
    _each_partition(pushed, make_client, switch)
    if keys is not None:
        _each_partition(keys.select("key").distinct().join(pushed, "key", "left_anti"), make_client, forget)


def push_lists(
    df: DataFrame,
    prefix: str,
    user: str,
    items: str,
    make_client: Callable[[], Any],
    users: DataFrame | None = None,
) -> None:
    """Replace the list of each user; ``items`` is an array column, best first.

    ``users`` names everyone who may have a list from before, in the column ``user``: those without a row in
    ``df`` lose theirs.
    """

    def push(client: Any, part: Iterator[Any]) -> None:
        for row in part:
            if not row["members"]:
                client.delete(row["key"])
                continue
            client.delete(f"{row['key']}:new")
            client.rpush(f"{row['key']}:new", *row["members"])
            client.rename(f"{row['key']}:new", row["key"])

    def forget(client: Any, part: Iterator[Any]) -> None:
        for row in part:
            client.delete(row["key"])

    members = F.col(items).cast("array<string>").alias("members")
    key = _key(prefix, F.col(user)).alias("key")
    _each_partition(df.select(key, members), make_client, push)
    if users is not None:
        gone = users.select(key).distinct().join(df.select(key), "key", "left_anti")
        _each_partition(gone, make_client, forget)
