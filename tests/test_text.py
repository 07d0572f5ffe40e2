import math

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from recflow.functions import rounded_double, word_set
from recflow.operators import text
from recflow.operators.text import (
    hot_words,
    idf,
    index_rows,
    inverse_index,
    item_text_feature,
    tf,
    tfidf,
    top_keywords,
    word_count,
)
from recflow.sources import load_stopwords

DAY = "2024-01-02"


@pytest.fixture(scope="module")
def items(spark):
    data = [
        (0, "Red cow", "red barn, red door"),
        (1, "the the", "the"),
        (2, "", None),
        (3, "cow", "Éclair cow"),
    ]
    return spark.createDataFrame(data, "id long, name string, description string")


@pytest.fixture(scope="module")
def stopwords(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("words") / "stop.txt"
    path.write_text("the\n and \n\nthe\n")
    return load_stopwords(spark, str(path))


@pytest.fixture(scope="module")
def counts(items, stopwords):
    return word_count(items, ["name", "description"], DAY, stopwords=stopwords)


def test_stopwords_are_trimmed_and_distinct(stopwords):
    assert rows(stopwords) == [("and",), ("the",)]


def test_a_word_counts_once_per_field(counts):
    assert rows(counts, "item_id", "key_word", "word_count", "word_total") == [
        (0, "barn", 1, 5),
        (0, "cow", 1, 5),
        (0, "door", 1, 5),
        (0, "red", 2, 5),
        (3, "cow", 2, 3),
        (3, "éclair", 1, 3),
    ]


def test_single_fields_and_three_fields(items, stopwords):
    title = word_count(items, ["name"], DAY, stopwords=stopwords)
    assert rows(title, "item_id", "key_word", "word_count") == [(0, "cow", 1), (0, "red", 1), (3, "cow", 1)]
    wide = items.withColumn("extra", F.lit("cow"))
    three = word_count(wide, ["name", "description", "extra"], DAY, stopwords=stopwords)
    assert rows(three.where("key_word = 'cow'"), "item_id", "word_count", "word_total") == [
        (0, 2, 6),
        (1, 1, 1),
        (2, 1, 1),
        (3, 3, 4),
    ]


def test_without_stopwords_all_words_count(items):
    assert word_count(items, ["name"], DAY).where("key_word = 'the'").count() == 1


def test_the_tokenizer_can_be_replaced(spark, items, stopwords):
    @F.pandas_udf("array<string>")
    def letters(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(list)

    chars = word_count(items.where("id = 3"), ["name"], DAY, stopwords=stopwords, tokenizer=letters)
    assert rows(chars, "key_word", "word_count") == [("c", 1), ("o", 1), ("w", 1)]


def test_idf_is_over_items_with_words(counts):
    found = {w: (n, a, v) for w, n, a, v in rows(idf(counts))}
    assert found["cow"] == (2, 2, 0.0)
    assert found["red"] == (1, 2, round(math.log10(2), 6))


def test_tf_sums_to_one_with_and_without_the_total(counts):
    for frame in (counts, counts.drop("word_total")):
        shares = tf(frame)
        assert rows(shares.where("key_word = 'red'"), "tf") == [(0.4,)]
        assert rows(shares.groupBy("item_id").agg(F.sum("tf"))) == [(0, 1.0), (3, 1.0)]


def test_tf_of_item_zero_is_not_zeroed(counts):
    assert tf(counts).where("item_id = 0 and tf = 0").count() == 0


def test_tfidf(counts):
    found = {(i, w): v for i, w, v in rows(tfidf(counts), "item_id", "key_word", "tfidf")}
    assert found[(0, "red")] == round(0.4 * math.log10(2), 6)
    assert found[(3, "cow")] == 0.0


def test_top_words_are_the_same_from_counts_and_tfidf(counts):
    assert rows(hot_words(counts, 3)) == rows(hot_words(tfidf(counts), 3))
    assert rows(top_keywords(counts, 2)) == [("red",), ("éclair",)]


def test_inverse_index_leaves_out_zero_weights(counts):
    index = inverse_index(tfidf(counts))
    assert index.where("key_word = 'cow'").count() == 0
    assert rows(index_rows(index), "key_word", "item_id") == [
        ("barn", 0),
        ("door", 0),
        ("red", 0),
        ("éclair", 3),
    ]


def test_a_frequent_word_is_split_over_shards(spark):
    weights = spark.range(1000).select(
        F.col("id").alias("item_id"),
        F.when(F.col("id") % 3 == 0, "often").otherwise(F.concat(F.lit("w"), "id")).alias("key_word"),
        F.lit(0.5).alias("tfidf"),
    )
    index = inverse_index(weights, max_postings=50)
    assert index.where("key_word = 'often'").count() == 7
    assert index.where("key_word <> 'often' and shard <> 0").count() == 0
    assert rows(index_rows(index)) == rows(weights, "key_word", "item_id", "tfidf")


def test_item_text_feature_from_counts_and_tfidf(spark, counts):
    items = spark.createDataFrame([(0, "a"), (3, "b")], "id long, category string")
    for words in (counts, counts.drop("word_total"), tfidf(counts)):
        feature = item_text_feature(words, DAY, items, "b", k=2)
        assert rows(feature, "item_id", "key_word", "val") == [(3, "éclair", round(math.log10(2) / 3, 6))]


def test_many_stopwords_give_the_same_counts(spark, items, stopwords):
    more = spark.range(100_001).select(F.concat(F.lit("w"), "id").alias("key_word")).union(stopwords)
    for fields in (["name"], ["name", "description"]):
        few = word_count(items, fields, DAY, stopwords=stopwords)
        assert rows(word_count(items, fields, DAY, stopwords=more)) == rows(few)
        assert rows(word_count(items, fields, DAY, stopwords=stopwords, max_in_row=0)) == rows(few)


def test_words_are_the_runs_of_letters(spark):
    data = [("",), (None,), ("  ",), ("A b2a\tB",), ("-É1é\u0301x-",), ("\U00010400z 日本",), ("a",)]
    found = spark.createDataFrame(data, "t string").select("t", word_set(F.col("t")).alias("w"))
    matches = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("t", F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1)))
    assert found.where(F.col("w") != matches).count() == 0
    assert found.where(F.array_contains("w", "")).count() == 0
    stop = F.array(F.lit("b"), F.lit("z"))
    assert [r[0] for r in found.where("t like 'A%'").select(word_set(F.col("t"), stop)).collect()] == [["a"]]


def test_rounding_is_that_of_spark(spark):
    ties = [0.5e-6, 1.5e-6, 2.5e-6, 1.0000005, 0.1234565, -0.0000005, 1e-300, 1e12, 123456789.1234565, 4e15, 1e300]
    odd = [0.0, -0.0, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(x,) for x in ties + [-x for x in ties] + odd], "x double")
    many = spark.range(20_000).select(((F.xxhash64("id") / 9.2e18) * F.pow(F.lit(10.0), F.col("id") % 9)).alias("x"))
    for some in (df, many):
        pairs = some.select((rounded_double(F.col("x"), 6) + 0.0).alias("a"), (F.round("x", 6) + 0.0).alias("b"))
        assert pairs.where("not (a <=> b)").count() == 0


def test_the_most_frequent_words_are_broadcast_as_far_as_they_may_be(spark, monkeypatch):
    """A share of the rows let few words in where most are about as frequent."""
    data = [(i, f"w{w}", 1, 1, DAY) for w in range(20) for i in range(20 - w)]
    counts = spark.createDataFrame(data, "item_id int, key_word string, word_count int, word_total int, date string")
    whole = rows(tfidf(counts))
    for most, least in ((8, (14, False)), (1, (None, False)), (21, (1, True))):
        monkeypatch.setattr(text, "MAX_BROADCAST_WORDS", most)
        assert text._frequent_from(text.word_table(counts)) == least
        assert rows(tfidf(counts)) == whole
