"""Words of scripts that are written without spaces: a vocabulary learned from the texts, and best cuts by it.

A run is a stretch of letters, in lower case. A word is a sequence of letters that is frequent, whose parts
meet far more often than by chance (cohesion), and around which the letters vary (freedom). All counts are
aggregations over all texts. Runs are then cut into the words of least total cost, where a word costs the
bits by which it is rarer than a letter; ties take the shorter last word. The cut runs in an Arrow function over a
trie of the vocabulary, whose size is bounded, and each distinct run of a batch is cut once.

``segmenter`` returns what ``text.word_count`` takes as ``tokenizer``. Null and empty texts have no words.
A run is held whole by one task, some 50 bytes a letter; texts are counted in pieces, whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.operators.joins import lookup
from recflow.session import materialize, ship_functions

ship_functions(__name__)

MAX_LENGTH = 4
MIN_COUNT = 5
# Bits by which a word must exceed the product of its parts, and bits of the letter before and after it.
MIN_COHESION = 2.5
MIN_FREEDOM = 1.5
# Words of the vocabulary sent to every task, the most frequent ones.
MAX_WORDS = 200_000
# Costs are thousandths of a bit.
UNIT = 1000
DIGITS = 9
# Letters counted per piece of a text, and letters cut at a time.
PIECE = 4096
BATCH_LETTERS = 1 << 18

_FAR = np.int64(1) << 40
_CODE_BITS = 21


def runs(text: Column) -> Column:
    """The runs of letters of a text, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)"), 1)


def gram_counts(df: DataFrame, fields: Sequence[str], longest: int) -> DataFrame:
    """(gram, n): how often each sequence of up to ``longest`` letters stands in a run."""
    before = F.lit(" " * (longest - 1))
    texts = df.select(F.explode(F.array(*[F.lower(F.coalesce(f, F.lit(""))) for f in fields])).alias("text"))
    starts = F.sequence(F.lit(1), F.length("text"), F.lit(PIECE))
    pieces = texts.where("text <> ''").select(
        F.explode(
            F.transform(starts, lambda at: F.substring(F.concat("text", before), at, F.lit(PIECE + longest - 1)))
        ).alias("piece")
    )
    # the letters from each place on, of the places that are followed by enough to see them all
    from_here = F.regexp_extract_all("piece", F.lit(rf"(?s)(?=(\p{{L}}{{1,{longest}}}))(?=.{{{longest}}})"), 1)
    heads = F.transform(
        F.sequence(F.lit(1), F.length("rest")), lambda size: F.substring(F.col("rest"), F.lit(1), size)
    )
    # there are far fewer different sequences than places, so their heads are taken after a first count
    distinct = pieces.select(F.explode(from_here).alias("rest")).groupBy("rest").agg(F.count("*").alias("n"))
    return distinct.select("n", F.explode(heads).alias("gram")).groupBy("gram").agg(F.sum("n").alias("n"))


def learn_vocabulary(
    df: DataFrame,
    fields: Sequence[str],
    max_length: int = MAX_LENGTH,
    min_count: int = MIN_COUNT,
    min_cohesion: float = MIN_COHESION,
    min_freedom: float = MIN_FREEDOM,
) -> DataFrame:
    """(word, n, cohesion, freedom, cost), written once: the words of the texts, and all single letters.

    ``cohesion`` is the least of the bits by which the word is more frequent than two parts of it would be side
    by side. ``freedom`` is the smaller of the entropies of the letters before and after it, in bits; an end of a run
    counts as a letter of its own each time. Both are null for single letters. All grams are shuffled once, those seen
    twice or more also by both of their shorter ends; the joins are of the frequent ones only.
    """
    size = F.length("gram")
    # what is seen once is no word, and adds nothing to an entropy
    seen_twice = (F.col("n") > 1) | (size == 1)
    grams = materialize(gram_counts(df, fields, max_length + 1).where(seen_twice), "grams")
    total = grams.where(size == 1).agg(F.sum("n").cast("double")).scalar()
    frequent = grams.where((F.col("n") >= min_count) & (size <= max_length))
    ends = grams.where(size >= 3).select(
        "n",
        F.inline(
            F.array(
                F.struct(F.substring("gram", F.lit(1), size - 1).alias("word"), F.lit(True).alias("after")),
                F.struct(F.substring("gram", F.lit(2), size - 1).alias("word"), F.lit(False).alias("after")),
            )
        ),
    )
    weighted = F.col("n") * F.log2("n")
    seen = ends.groupBy("word").agg(
        F.greatest(*[F.sum(F.when(F.col("after") == side, weighted).otherwise(0.0)) for side in (True, False)]).alias("most")
    )
    freedom = F.log2("n") - F.coalesce("most", F.lit(0.0)) / F.col("n")
    free = (
        frequent.where(size >= 2)
        .select(F.col("gram").alias("word"), "n")
        .join(seen, "word", "left")
        .select("word", "n", F.round(freedom, DIGITS).alias("freedom"))
        .where(F.col("freedom") >= min_freedom)
    )
    length = F.length("word")
    cuts = F.transform(
        F.sequence(F.lit(1), length - 1),
        lambda at: F.struct(
            F.substring(F.col("word"), F.lit(1), at).alias("head"), F.substring(F.col("word"), at + 1, length).alias("tail")
        ),
    )
    parts = free.select("word", "n", "freedom", F.inline(cuts))
    for part in ("head", "tail"):
        parts = lookup(parts, frequent.select(F.col("gram").alias(part), F.col("n").alias(f"{part}_n")), [part])
    chance = F.log2("n") - F.log2("head_n") - F.log2("tail_n")
    held = (
        parts.groupBy("word", "n", "freedom")
        .agg(F.min(chance).alias("least"))
        .select("word", "n", F.round(F.col("least") + F.log2(total), DIGITS).alias("cohesion"), "freedom")
        .where(F.col("cohesion") >= min_cohesion)
    )
    nothing = F.lit(None).cast("double")
    letters = grams.where(size == 1).select(
        F.col("gram").alias("word"), "n", nothing.alias("cohesion"), nothing.alias("freedom")
    )
    cost = F.round((F.log2(total) - F.log2("n")) * UNIT).cast("long").alias("cost")
    return materialize(held.unionByName(letters).select("*", cost), "vocabulary")


def trie(words: Sequence[str], costs: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges in order: node and letter, the node each leads to, the cost of the word each node ends or -1)."""
    nodes: dict[int, int] = {}
    cost = [-1]
    for word, price in zip(words, costs):
        at = 0
        for letter in word:
            key = at << _CODE_BITS | ord(letter)
            if key not in nodes:
                nodes[key] = len(cost)
                cost.append(-1)
            at = nodes[key]
        cost[at] = int(price)
    edges = np.fromiter(nodes, np.int64, len(nodes))
    order = np.argsort(edges)
    return edges[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order], np.array(cost, np.int64)


def _prices(
    codes: np.ndarray, left: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray, np.ndarray], longest: int, unknown: int
) -> np.ndarray:
    """(length - 1, place): the cost of the word of that length that begins there; a letter always has one."""
    edges, child, cost = lexicon
    out = np.full((longest, len(codes)), _FAR)
    out[0] = unknown
    at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    for size in range(1, longest + 1):
        inside = left[at] >= size
        at, node = at[inside], node[inside]
        if not len(edges) or not len(at):
            break
        key = node << _CODE_BITS | codes[at + size - 1]
        edge = np.minimum(np.searchsorted(edges, key), len(edges) - 1)
        found = edges[edge] == key
        at, node = at[found], child[edge[found]]
        word = cost[node] >= 0
        out[size - 1, at[word]] = cost[node[word]]
    return out


def cut(some: Sequence[str], lexicon: tuple, longest: int, unknown: int) -> list[list[str]]:
    """The words of least total cost of each run; all runs advance together, a letter a step."""
    sizes = np.fromiter(map(len, some), np.int64, len(some))
    text = "".join(some)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    left = np.repeat(first + sizes, sizes) - np.arange(len(codes))
    prices = _prices(codes, left, lexicon, longest, unknown)
    # the least cost up to each place of a run, one more place than letters
    begin = first + np.arange(len(some))
    cost, back = np.zeros(len(codes) + len(some), np.int64), np.ones(len(codes) + len(some), np.int64)
    order = np.argsort(-sizes, kind="stable")
    longer = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0)) + 1), "right")
    for step in range(1, len(longer)):
        own = order[: longer[step]]
        end, start = begin[own] + step, first[own] + step
        best, size = cost[end - 1] + prices[0, start - 1], np.ones(len(own), np.int64)
        for k in range(2, min(step, longest) + 1):
            other = cost[end - k] + prices[k - 1, start - k]
            less = other < best
            best[less], size[less] = other[less], k
        cost[end], back[end] = best, size
    begins = np.zeros(len(codes) + 1, bool)
    at, own = sizes.copy(), np.flatnonzero(sizes)
    while len(own):
        at[own] -= back[begin[own] + at[own]]
        begins[first[own] + at[own]] = True
        own = own[at[own] > 0]
    places = np.flatnonzero(begins).tolist()
    words = [text[a:b] for a, b in zip(places, [*places[1:], len(text)])]
    ends = np.searchsorted(places, first + sizes).tolist()
    return [words[a:b] for a, b in zip([0, *ends], ends)]


def _cut_all(found: pa.ListArray, lexicon: tuple, longest: int, unknown: int) -> pa.ListArray:
    """The words of each list of runs, in order."""
    flat = found.flatten().dictionary_encode()
    distinct, words, at = flat.dictionary.to_pylist(), [], 0
    # runs of like lengths together, as those cut at a time take as many steps as the longest has letters
    order = sorted(range(len(distinct)), key=lambda i: len(distinct[i]))
    while at < len(order):
        until, letters = at, 0
        while until < len(order) and (until == at or letters + len(distinct[order[until]]) <= BATCH_LETTERS):
            letters += len(distinct[order[until]])
            until += 1
        words += cut([distinct[i] for i in order[at:until]], lexicon, longest, unknown)
        at = until
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    per_run = pa.array(words, pa.list_(pa.string())).take(pa.array(back[flat.indices.to_numpy()]))
    ends = np.concatenate([[0], np.cumsum(per_run.value_lengths().to_numpy(zero_copy_only=False))])
    sizes = found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    bounds = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), per_run.flatten())


def segmenter(vocabulary: DataFrame, max_words: int = MAX_WORDS) -> Callable[[Column], Column]:
    """A function from a text column to its words in order, for a vocabulary (word, n, cost).

    The ``max_words`` most frequent words are sent to every task. A letter without an entry costs one bit more
    than the dearest one of these.
    """
    spark = vocabulary.sparkSession
    top = vocabulary.orderBy(F.desc("n"), "word").limit(max_words).select("word", "cost").toArrow()
    words, costs = top["word"].to_pylist(), top["cost"].to_pylist()
    longest = max(map(len, words), default=1)
    unknown = max(costs, default=0) + UNIT
    shared = spark.sparkContext.broadcast(trie(words, costs))

    def in_batch(found: pa.Array) -> pa.Array:
        return _cut_all(found, shared.value, longest, unknown)

    in_batch.__annotations__ = {"found": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(in_batch, "array<string>")
    return lambda text: udf(runs(text))
