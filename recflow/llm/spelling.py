"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are counted over all documents. Two words one insertion, deletion or replacement apart share a prefix and
a suffix that together reach the longer length minus one, so one of the two reaches half of that length.
Words are therefore tiled by the first half and by the last half of their letters. The words of a tile
are cut in blocks, blocks are padded matrices of code points, and every pair of blocks of a tile is compared in a task
of its own: the common prefixes and suffixes of all word pairs at once. A task returns one row per word
and pair of blocks, never the pairs.

Rules: a null text has no words; a null doc_id reads as the empty text in the rule that alters words; repeated
rows count each; of near words with equal counts the one first in code-point order is the form; words of any
length are compared, in fewer rows at a time; other columns are ignored; an empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import map_batches, parts, raw
from recflow.operators.joins import lookup
from recflow.session import materialize

# Words of a block, and code points compared at a time.
BLOCK = 256
CELLS = 1 << 22
# Distinct words a task counts before it hands them on.
COUNTED = 1 << 18
LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form occurs at least so many times as often.
RATIO = 5
DAMAGED = 199


def length(word: bytes) -> int:
    """Code points of UTF-8 letters up to U+00FF."""
    return len(word) - word.count(b"\xc3")


def altered(word: bytes, doc_id: bytes) -> bytes:
    """The word, one code point less if its checksum under this document is a multiple of 199."""
    h = zlib.crc32(word, zlib.crc32(doc_id + b":"))
    if h % DAMAGED:
        return word
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counts(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # runs of enough letters; lower-casing bytes changes A-Z alone
    runs = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for part in parts([batch]):
                ids = part.column("doc_id").to_pylist()
                for doc_id, text in zip(ids, raw(part)):
                    name = b"" if doc_id is None else str(doc_id).encode()
                    for word, n in Counter(runs.findall((text or b"").lower())).items():
                        word = altered(word, name)
                        if len(word) >= least and length(word) >= least:
                            total[word] += n
                if len(total) >= COUNTED:
                    yield out()
                    total.clear()
        if total:
            yield out()

    return run


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of enough letters that occur often enough in all documents."""
    found = map_batches(docs.select("doc_id", "text"), _counts(least_length), "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def matrix(words: list[str], width: int, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with zeros at their end or, ``right``, at their beginning; lengths."""
    sizes = np.array([len(w) for w in words], np.int32)
    pad = str.rjust if right else str.ljust
    joined = "".join(pad(w, width, "\0") for w in words)
    return np.frombuffer(joined.encode("utf-32-le"), "<u4").reshape(len(words), width), sizes


def _common(a: np.ndarray, b: np.ndarray, from_right: bool) -> np.ndarray:
    """Length of the common beginning (end) of every row of ``a`` with every row of ``b``, padding included."""
    same = a[:, None, :] == b[None, :, :]
    if from_right:
        same = same[:, :, ::-1]
    first = np.argmin(same, axis=2)
    return np.where(same.all(axis=2), a.shape[1], first)


def near(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Indices (i, j) of word pairs one edit apart, and their common prefix and suffix lengths."""
    width = max(map(len, left + right), default=0)
    a, size_a = matrix(left, width, False)
    b, size_b = matrix(right, width, False)
    a_end, b_end = matrix(left, width, True)[0], matrix(right, width, True)[0]
    tall = max(1, min(len(right), CELLS // max(1, width)))
    wide = max(1, CELLS // max(1, width * tall))
    found = []
    for i in range(0, len(left), wide):
        for j in range(0, len(right), tall):
            rows, columns = slice(i, i + wide), slice(j, j + tall)
            short = np.minimum(size_a[rows, None], size_b[None, columns])
            long = np.maximum(size_a[rows, None], size_b[None, columns])
            prefix = np.minimum(_common(a[rows], b[columns], False), short)
            suffix = np.minimum(_common(a_end[rows], b_end[columns], True), short)
            same = (prefix == long) & (short == long)
            x, y = np.nonzero((long - short <= 1) & (prefix + suffix >= long - 1) & ~same)
            found.append((x + i, y + j, prefix[x, y], suffix[x, y]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int),) * 4


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, n, other) for each word of a pair of blocks; ``other`` is its near word of largest count."""
    for batch in batches:
        out: list[tuple[str, int, int, str]] = []
        columns = [batch.column(c).to_pylist() for c in ("size", "ends", "left", "right")]
        for size, ends, left, right in zip(*columns):
            alone = right is None
            right = left if alone else right
            words, others = [w["word"] for w in left], [w["word"] for w in right]
            half, best = size // 2, {}
            for i, j, prefix, suffix in zip(*(x.tolist() for x in near(words, others))):
                if alone and j <= i or max(len(words[i]), len(others[j])) != size:
                    continue
                # a pair with both halves in common is taken by its beginning
                if (prefix if not ends else suffix) < half or ends and prefix >= half:
                    continue
                for one, two in ((left[i], right[j]), (right[j], left[i])):
                    entry = best.setdefault(one["word"], [0, 0, ""])
                    entry[0] += 1
                    if (-two["n"], two["word"]) < (-entry[1], entry[2]):
                        entry[1:] = two["n"], two["word"]
            out += [(w, *entry) for w, entry in best.items()]
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "n", "other"])


def nearest(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form_n, form) for the words (word, n) that have a near word; ``form`` is the most frequent."""
    size = F.char_length("word")
    keys = []
    for longer in (size, size + 1):  # as one of the longer or as the shorter word of a pair
        half = F.floor(longer / 2).cast("int")
        for ends in (False, True):
            letters = F.right("word", half) if ends else F.left("word", half)
            keys.append(F.struct(longer.alias("size"), F.lit(ends).alias("ends"), letters.alias("half")))
    tile = ["size", "ends", "half"]
    placed = words.select("word", "n", F.inline(F.array(*keys)))
    counts = placed.groupBy(*tile).agg(F.count("*").alias("in_tile")).where(F.col("in_tile") > 1)
    blocks = F.ceil(F.col("in_tile") / block).cast("int")
    placed = lookup(placed, counts, tile).withColumn("blocks", blocks)
    placed = placed.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    # every pair of blocks once: a block meets itself and all others
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    word = F.struct("word", "n")
    sides = pairs.groupBy(*tile, "low", "high").agg(
        F.collect_list(F.when(F.col("own") == F.col("low"), word)).alias("left"),
        F.collect_list(F.when(F.col("own") == F.col("high"), word)).alias("right"),
    )
    right = F.when(F.col("low") != F.col("high"), F.col("right"))
    met = sides.select("size", "ends", "left", right.alias("right")).where(
        (F.size("left") > 0) & F.coalesce(F.size("right") > 0, F.size("left") > 1)
    )
    found = map_batches(met, _compared, "word string, n_near bigint, n bigint, other string")
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col("other").alias("word"))).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select(
        "word", "n_near", (-F.col("first.n")).alias("form_n"), F.col("first.word").alias("form")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last. The distance doubles with every round."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = lookup(now, ahead, ["root"], "left")
        moved = F.col("further").isNotNull()
        root = F.coalesce("further", "root").alias("root")
        step = materialize(step.select("word", root, moved.alias("moved")), "roots")
        now = step.drop("moved")
        if not step.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word, its form and the last form it leads to.

    The form is the near word of largest count if that is at least five times the word's own, else null.
    """
    words = materialize(vocabulary(docs, least_length, least_count), "words")
    found = materialize(lookup(words, nearest(words, block), ["word"], "left"), "near-words")
    has_form = F.col("form_n") >= RATIO * F.col("n")
    formed = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(has_form, F.col(c)).alias(c) for c in ("form", "form_n")],
    )
    last = roots(formed.where(F.col("form").isNotNull()))
    return lookup(formed, last, ["word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
