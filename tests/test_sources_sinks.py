import json
import os
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recflow import session
from recflow.sinks import (
    push_lists,
    push_sorted_sets,
    to_list_rows,
    to_sorted_set_rows,
    write_snapshot,
    write_table,
)
from recflow.sources import (
    EVENT_WEIGHTS,
    event_weights,
    jdbc_table,
    read_or_empty,
    read_snapshot,
    read_table,
    schemas,
    snapshot,
    stored_days,
    tag_dimension,
)


def test_a_snapshot_has_the_schema_and_a_string_date(spark):
    users = spark.createDataFrame([(1, "ann", "secret")], "uid int, username string, password string")
    taken = snapshot(users, schemas.USERS, "2024-01-02")
    assert taken.columns == ["uid", "username", "role", "province", "city", "district", "date"]
    assert taken.first()["date"] == "2024-01-02"
    assert dict(taken.dtypes)["uid"] == "bigint"


def test_tag_weights_keep_their_decimals(spark):
    tags = spark.createDataFrame([(1, 2, "t", Decimal("0.65"))], "id long, item_id long, tag_id string, weight decimal(8,4)")
    assert snapshot(tags, schemas.ITEM_TAGS, "d").first()["weight"] == Decimal("0.6500")


def test_columns_can_be_dropped(spark):
    users = spark.createDataFrame([(1, "ann")], "uid int, username string")
    assert "username" not in snapshot(users, schemas.USERS, "d", drop=["username"]).columns


def test_rewriting_a_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "scores")
    day = lambda v: spark.createDataFrame([(1, v), (2, v)], schemas.ITEM_SCORE)
    write_snapshot(day(1.0), path, "2024-01-01")
    write_snapshot(day(2.0), path, "2024-01-02")
    write_snapshot(day(3.0), path, "2024-01-02")
    assert rows(read_snapshot(spark, path, "2024-01-01"), "score") == [(1.0,), (1.0,)]
    assert rows(read_snapshot(spark, path, "2024-01-02"), "score") == [(3.0,), (3.0,)]
    assert read_or_empty(spark, path, schemas.ITEM_SCORE).count() == 4


def test_a_write_that_fails_leaves_the_old_day(spark, tmp_path):
    path = str(tmp_path / "scores")
    write_snapshot(spark.range(5).select(F.col("id"), F.lit(1.0).alias("score")), path, "2024-01-02")
    half = F.when(F.col("id") < 4, 2.0).otherwise(F.raise_error(F.lit("lost")).cast("double"))
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            write_snapshot(spark.range(8).repartition(8).select("id", half.alias("score")), path, "2024-01-02")
    assert rows(read_snapshot(spark, path, "2024-01-02"), "id", "score") == [(i, 1.0) for i in range(5)]
    with pytest.raises(Exception, match="lost"):
        write_snapshot(spark.range(8).select("id", half.alias("score")), path, "2024-01-03")
    assert stored_days(spark, path) == ["2024-01-02"]


def test_a_frame_may_read_the_day_that_it_replaces(spark, tmp_path):
    path = str(tmp_path / "scores")
    write_snapshot(spark.range(3), path, "2024-01-02")
    for n in (6, 12, 24):
        before = read_snapshot(spark, path, "2024-01-02")
        write_snapshot(before.union(before), path, "2024-01-02")
        assert read_snapshot(spark, path, "2024-01-02").count() == n
        assert before.count() == n // 2  # kept for those who still read it
    assert len(list((tmp_path / "scores/date=2024-01-02").glob("run=*"))) == 2


def test_one_day_is_pruned_to_its_partition(spark, tmp_path):
    path = str(tmp_path / "scores")
    for day in ("2024-01-01", "2024-01-02"):
        write_snapshot(spark.createDataFrame([(1, 1.0)], schemas.ITEM_SCORE), path, day)
    one = read_snapshot(spark, path, "2024-01-02")
    assert len(one.select(F.input_file_name()).distinct().collect()) == 1


def test_history_is_empty_only_on_the_first_run(spark, tmp_path):
    path = str(tmp_path / "history")
    first = read_or_empty(spark, path, schemas.ITEM_SCORE)
    assert first.columns == ["item_id", "score", "date"] and first.count() == 0
    write_snapshot(spark.createDataFrame([(1, 1.0)], schemas.ITEM_SCORE), path, "2024-01-01")
    assert read_or_empty(spark, path, schemas.ITEM_SCORE).count() == 1
    assert read_or_empty(spark, path, schemas.ITEM_SCORE, "2024-01-02").count() == 0


def test_unpartitioned_tables_are_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(spark.range(5).toDF("id"), path)
    write_table(spark.range(2).toDF("id"), path)
    assert read_table(spark, path).count() == 2


def test_a_partitioned_database_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        jdbc_table(spark, {"url": "jdbc:none"}, "items", partition_column="id")


def test_event_weights_table(spark):
    assert dict(rows(event_weights(spark))) == EVENT_WEIGHTS


def test_tags_without_a_known_category_stay(spark):
    tags = spark.createDataFrame([("t1", 1), ("t2", 5)], "tag_id string, category_id int")
    categories = spark.createDataFrame([(1, "kind")], "tag_category_id int, category_name string")
    found = rows(tag_dimension(tags, categories, "2024-01-02"), "tag_id", "category_name", "date")
    assert found == [("t1", "kind", "2024-01-02"), ("t2", None, "2024-01-02")]


def test_cache_rows(spark):
    hot = spark.createDataFrame([(7, "a", 2.5)], "item_id long, category string, score double")
    assert rows(to_sorted_set_rows(hot, "item-hot-list-", "category", "item_id", "score")) == [
        ("item-hot-list-a", "7", 2.5)
    ]
    lists = spark.createDataFrame([(1, [9, 8])], "user_id long, items array<long>")
    assert rows(to_list_rows(lists, "user_", "user_id", "items")) == [("user_1", 0, "9"), ("user_1", 1, "8")]


def file_cache(folder):
    """A cache of one file per key; a set is an object, a list an array."""

    class Client:
        def path(self, key):
            return os.path.join(folder, key)

        def exists(self, key):
            return os.path.exists(self.path(key))

        def read(self, key, default):
            return json.load(open(self.path(key))) if self.exists(key) else default

        def write(self, key, value):
            with open(self.path(key), "w") as out:
                json.dump(value, out)

        def zadd(self, key, members):
            self.write(key, self.read(key, {}) | members)

        def rpush(self, key, *members):
            self.write(key, [*self.read(key, []), *members])

        def rename(self, key, new):
            os.replace(self.path(key), self.path(new))

        def delete(self, key):
            if self.exists(key):
                os.remove(self.path(key))

        def close(self):
            pass

    return Client


def cached(folder):
    return {name: json.loads((folder / name).read_text()) for name in os.listdir(folder)}


def test_sorted_sets_are_replaced(spark, tmp_path):
    sets = spark.range(40).select(
        F.concat(F.lit("k"), F.col("id") % 3).alias("key"), F.col("id").cast("string").alias("member"), F.lit(1.0).alias("score")
    ).coalesce(1)
    every = sets.select("key")
    client = file_cache(str(tmp_path))
    client().zadd("k1:day", {"left by a broken push": 1.0})
    for day, rows_of_day in (("day", sets), ("day", sets), ("next", sets.where("id < 20 and key <> 'k2'"))):
        push_sorted_sets(rows_of_day, client, day, chunk=10, keys=every)
    found = cached(tmp_path)
    assert set(found) == {"k0", "k1"}
    assert sorted(map(int, found["k0"])) == list(range(0, 20, 3))


def test_lists_are_replaced_in_order(spark, tmp_path):
    client = file_cache(str(tmp_path))
    for items in ([9, 8, 7], [6, 9]):
        lists = spark.createDataFrame([(1, items), (2, [])], "user_id long, items array<long>").coalesce(1)
        client().rpush("user_2", "old")
        push_lists(lists, "user_", "user_id", "items", client)
        assert cached(tmp_path) == {"user_1": list(map(str, items))}
    client().rpush("user_3", "old")
    everyone = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    push_lists(lists, "user_", "user_id", "items", client, users=everyone)
    assert set(cached(tmp_path)) == {"user_1"}


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    session.use_checkpoints(spark)
    chosen = spark.sparkContext.getCheckpointDir()
    session.use_checkpoints(spark)
    assert spark.sparkContext.getCheckpointDir() == chosen


def test_without_a_named_folder_there_is_none():
    class Session:
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})
        conf = type("Conf", (), {"get": staticmethod(lambda name, default: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_a_missing_table_leaves_the_schema_alone(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    for _ in range(2):
        assert read_or_empty(spark, str(tmp_path / "none"), schema).columns == ["a", "date"]
    assert schema.fieldNames() == ["a"]


def test_a_day_written_again_without_rows_has_none(spark, tmp_path):
    path = str(tmp_path / "table")
    for day, n in (("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-02", 0)):
        write_snapshot(spark.range(n), path, day)
    assert read_snapshot(spark, path, "2024-01-01").count() == 2
    assert read_snapshot(spark, path, "2024-01-02").count() == 0
    assert read_snapshot(spark, path, "2024-01-03").count() == 0
    assert stored_days(spark, path) == ["2024-01-01", "2024-01-02"]
    assert stored_days(spark, path + "-none") == []


def test_scratch_is_deleted_at_the_end(spark):
    kept = session.materialize(spark.range(3), "kept")
    with session.scratch(spark):
        gone = session.materialize(spark.range(4), "gone").inputFiles()[0]
    assert kept.count() == 3 and not os.path.exists(gone.removeprefix("file://"))


def test_broadcasts_are_checked(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in plan(session.broadcast_if_small(spark.range(10), 10))
    assert "strategy=broadcast" not in plan(session.broadcast_if_small(spark.range(11), 10))


def test_materialized_frames_live_in_the_shared_folder(spark):
    df = session.materialize(spark.range(5).toDF("n"), "numbers")
    assert df.count() == 5
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in df.inputFiles())
    session.drop_materialized(spark)
    assert not [name for name in os.listdir(folder) if name.startswith("recflow-numbers")]
