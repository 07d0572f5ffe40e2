"""Word counts, TF-IDF, top words and the inverted index, all in long sparse form.

Item ids are unique in a snapshot, so the words of an item come from one row: counting them needs no
shuffle, and neither do term frequencies. A row that is not there stands for 0.

``tfidf`` and the features read the counts more than once; store counts that were costly to make
(``session.materialize`` or a daily table) before passing them on.

The built-in tokenizer takes runs of letters as words. Scripts written without spaces need a
segmenter: pass ``tokenizer``, a function from a text column to an array of words, such as that of
``segment.segmenter``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.functions import comparable, word_set
from recflow.operators.joins import lookup
from recflow.session import materialize

# Items of one word that share a row of the inverted index.
MAX_POSTINGS = 100_000
# Top words up to this number are broadcast.
MAX_BROADCAST_WORDS = 100_000
# Stop words up to this number are taken out inside the row, more of them by a join.
MAX_STOPWORDS_IN_ROW = 100_000


def _words(
    field: str, stop_words: Column | None, tokenizer: Callable[[Column], Column] | None
) -> Column:
    if tokenizer is None:
        return word_set(F.col(field), stop_words)
    words = tokenizer(F.col(field))
    return F.array_distinct(words) if stop_words is None else F.array_except(words, stop_words)


def word_count(
    df: DataFrame,
    fields: Sequence[str],
    run_date: str,
    id_col: str = "id",
    stopwords: DataFrame | None = None,
    tokenizer: Callable[[Column], Column] | None = None,
    max_in_row: int = MAX_STOPWORDS_IN_ROW,
) -> DataFrame:
    """(item_id, key_word, word_count, word_total, date): in how many fields the word occurs.

    A word counts once per field however often it is repeated there. Products count their name and
    description together; posts have one table for the title and one for the content. ``word_total``
    is the sum over the item.
    """
    stop, left_out = None, None
    if stopwords is not None:
        if stopwords.limit(max_in_row + 1).count() <= max_in_row:
            stop = stopwords.agg(F.collect_set("key_word").alias("words")).scalar()
        else:
            left_out = stopwords.select("key_word").distinct()
    sets = df.select(
        F.col(id_col).alias("item_id"),
        *[_words(f, stop, tokenizer).alias(f"_f{i}") for i, f in enumerate(fields)],
    )
    arrays = [F.col(f"_f{i}") for i in range(len(fields))]
    total = sum((F.size(a) for a in arrays), F.lit(0)).alias("word_total")

    def once(words: Column, n: int) -> Column:
        return F.transform(
            words, lambda w: F.struct(w.alias("key_word"), F.lit(n).alias("word_count"))
        )

    if left_out is not None:
        found = sets.select("item_id", F.explode(F.concat(*arrays)).alias("key_word"))
        counted = (
            lookup(found, left_out, ["key_word"], "left_anti")
            .groupBy("item_id", "key_word")
            .agg(F.count("*").cast("int").alias("word_count"))
        )
        totals = counted.groupBy("item_id").agg(F.sum("word_count").cast("int").alias("word_total"))
        counted = lookup(counted, totals, ["item_id"])
    elif len(fields) == 1:
        counted = sets.select("item_id", total, F.inline(once(arrays[0], 1)))
    elif len(fields) == 2:
        a, b = arrays
        both = F.concat(
            once(F.array_intersect(a, b), 2),
            once(F.array_except(a, b), 1),
            once(F.array_except(b, a), 1),
        )
        counted = sets.select("item_id", total, F.inline(both))
    else:
        counted = (
            sets.select("item_id", total, F.explode(F.concat(*arrays)).alias("key_word"))
            .groupBy("item_id", "word_total", "key_word")
            .agg(F.count("*").cast("int").alias("word_count"))
        )
    return counted.select("item_id", "key_word", "word_count", "word_total", F.lit(run_date).alias("date"))


def word_table(counts: DataFrame) -> DataFrame:
    """(key_word, item_num_has_word, tf_sum, item_num_all) of every word, from one pass over the counts.

    All items are those with at least one word. The shares of an item's words add up to 1, so the items
    are counted by the sum of all shares, and no item ids are shuffled. The table is written once, as it
    has a row per word and several readers.
    """
    share = F.sum(F.col("word_count") / F.col("word_total")).alias("tf_sum")
    words = _with_total(counts).groupBy("key_word").agg(F.count("*").alias("item_num_has_word"), share)
    words = materialize(words, "words")
    everything = words.agg(F.rint(F.sum("tf_sum")).cast("long").alias("n")).scalar()
    return words.withColumn("item_num_all", everything)


def _with_idf(words: DataFrame) -> DataFrame:
    return words.withColumn("idf", F.log10(F.col("item_num_all") / F.col("item_num_has_word")))


def idf(counts: DataFrame) -> DataFrame:
    """(key_word, item_num_has_word, item_num_all, idf) with idf = log10(all items / items with it)."""
    return _with_idf(word_table(counts)).select("key_word", "item_num_has_word", "item_num_all", "idf")


def _with_total(counts: DataFrame) -> DataFrame:
    if "word_total" in counts.columns:
        return counts
    totals = counts.groupBy("item_id").agg(F.sum("word_count").alias("word_total"))
    return lookup(counts, totals, ["item_id"])


def tf(counts: DataFrame) -> DataFrame:
    """(item_id, key_word, tf, date): the word's share of the item's counted words."""
    share = F.coalesce(F.try_divide(F.col("word_count"), F.col("word_total")), F.lit(0.0))
    return _with_total(counts).select("item_id", "key_word", share.alias("tf"), "date")


def _frequent_from(words: DataFrame) -> tuple[int | None, bool]:
    """(least number of items of the most frequent words, less than ``MAX_BROADCAST_WORDS``; if these are all words).

    Words of one number are taken together or not at all; None where those of the largest are too many.
    """
    numbers = words.groupBy("item_num_has_word").agg(F.count("*").alias("n"))
    # each number has a word, so no more of them can matter
    top = numbers.orderBy(F.desc("item_num_has_word")).limit(MAX_BROADCAST_WORDS).collect()
    least, taken = None, 0
    for row in top:
        taken += row.n
        if taken >= MAX_BROADCAST_WORDS:
            return least, False
        least = row.item_num_has_word
    return least, True


def tfidf(counts: DataFrame) -> DataFrame:
    """(item_id, key_word, tfidf, item_num_has_word, date).

    Frequent words hold most rows, so as many of the most frequent ones as are less than
    ``MAX_BROADCAST_WORDS`` are broadcast. Only the rows of the rare words are shuffled.
    """
    words = word_table(counts)
    weights = _with_idf(words).select("key_word", "item_num_has_word", "idf")
    least, everything = _frequent_from(words)
    shares = tf(counts)
    if least is None:
        found = lookup(shares, weights, ["key_word"])
    else:
        frequent = F.broadcast(weights.where(F.col("item_num_has_word") >= least))
        found = shares.join(frequent, "key_word")
        if not everything:
            rare = weights.where(F.col("item_num_has_word") < least)
            left = shares.join(frequent, "key_word", "left_anti")
            found = found.unionByName(lookup(left, rare, ["key_word"]))
    return found.select(
        "item_id", "key_word", (F.col("tf") * F.col("idf")).alias("tfidf"), "item_num_has_word", "date"
    )


def _word_weights(counts: DataFrame) -> DataFrame:
    """(key_word, weight, idf): the total tfidf of each word, straight from word counts.

    idf is the same for all rows of a word, so the total is idf times the summed tf, and the rows
    need not be joined with idf first.
    """
    found = _with_idf(word_table(counts))
    return found.select("key_word", (F.col("tf_sum") * F.col("idf")).alias("weight"), "idf")


def _top(totals: DataFrame, k: int) -> DataFrame:
    return totals.orderBy(comparable(F.col("weight")).desc(), "key_word").limit(k)


def hot_words(words: DataFrame, k: int) -> DataFrame:
    """The ``k`` words with the largest total tfidf, as (key_word, weight).

    ``words`` are word counts or tfidf rows; counts are cheaper, as no row is joined.
    """
    if "tfidf" not in words.columns:
        return _top(_word_weights(words), k).select("key_word", "weight")
    return _top(words.groupBy("key_word").agg(F.sum("tfidf").alias("weight")), k)


def top_keywords(words: DataFrame, k: int = 30) -> DataFrame:
    """The words that serve as text features."""
    return hot_words(words, k).select("key_word")


def inverse_index(weights: DataFrame, max_postings: int = MAX_POSTINGS) -> DataFrame:
    """(key_word, shard, postings): a map from item to weight, weights above 0 only.

    A word found in more than ``max_postings`` items has its map split over several rows by the
    item's hash, so no row and no task holds all items of a frequent word; every other word has the
    one shard 0. Adding the shards to a cache one after the other builds the full entry.
    """
    if "item_num_has_word" not in weights.columns:
        sizes = weights.groupBy("key_word").agg(F.count("*").alias("item_num_has_word"))
        weights = lookup(weights, sizes, ["key_word"])
    shards = F.ceil(F.col("item_num_has_word") / F.lit(max_postings))
    return (
        weights.where(F.col("tfidf") > 0)
        .withColumn("shard", F.pmod(F.xxhash64("item_id"), shards).cast("int"))
        # the join above leaves all rows of a word together, which would undo the shards
        .repartition("key_word", "shard")
        .groupBy("key_word", "shard")
        .agg(F.map_from_entries(F.collect_list(F.struct("item_id", "tfidf"))).alias("postings"))
    )


def index_rows(index: DataFrame) -> DataFrame:
    """The inverted index as rows (key_word, item_id, tfidf)."""
    return index.select("key_word", F.explode("postings").alias("item_id", "tfidf"))


def item_text_feature(
    words: DataFrame,
    run_date: str,
    items: DataFrame | None = None,
    category: str | None = None,
    k: int = 30,
) -> DataFrame:
    """(item_id, key_word, val, date): tfidf of the ``k`` top words, for the items of a category.

    From word counts, the top words are found by one aggregation and their rows by a broadcast of
    ``k`` words, so the counts themselves are never shuffled.
    """

    def keep(rows: DataFrame, top: DataFrame) -> DataFrame:
        if k <= MAX_BROADCAST_WORDS:
            return rows.join(F.broadcast(top), "key_word")
        return lookup(rows, top, ["key_word"])

    if "tfidf" in words.columns:
        kept = keep(words, top_keywords(words, k))
    else:
        kept = keep(_with_total(words), _top(_word_weights(words), k).select("key_word", "idf"))
        kept = kept.withColumn("tfidf", F.col("word_count") / F.col("word_total") * F.col("idf"))
    if items is not None:
        wanted = items if category is None else items.where(F.col("category") == category)
        kept = kept.join(wanted.select(F.col("id").alias("item_id")), "item_id", "left_semi")
    return kept.select("item_id", "key_word", F.col("tfidf").alias("val"), F.lit(run_date).alias("date"))
