"""Token ids in ORC files.

Rows are range-partitioned and sorted by document, so each file holds one range of ids. The writer cuts a
file into stripes, packs the integers as runs, keeps a row index of the smallest and largest value of every
column for each group of rows, and a Bloom filter on the document ids. A reader opens stripes in parallel
and skips those whose index or filter rules out the ids it was asked for.

A document without tokens, so one of null or empty text, has its end id only. Null ids sort first. Rows of equal
ids follow a hash of their texts, so that many of them can be split over files too; repeated rows are all written.
A text is encoded whole in one task, whatever its length. Only doc_id and text are read; a table without rows
gives files without rows.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from array import array as pack
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recflow.llm.common import keyed, lists, map_batches, parts, per_batch, raw, texts_of, worker_state
from recflow.session import scratch_path

SCHEMA = "doc_id bigint, ids array<int>, n_tokens bigint, part int, row bigint"
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000
# Words that a Python worker keeps the ids of, and half as many runs of their letters; twice as many at most.
KEPT_WORDS = 600_000
# Text that a task encodes at a time.
BATCH_BYTES = 4 << 20


class Recent:
    """A mapping of bounded size that forgets what was not asked for lately."""

    def __init__(self, size: int) -> None:
        self.size, self.new, self.old = size, {}, {}

    def get(self, key: object) -> bytes | None:
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key: object, value: bytes) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


# The steps before the merges of the tokenizers whose words can be encoded one by one.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def by_words(tokenizer) -> bool:
    """Whether the tokenizer lower-cases and splits as ``WordTable`` does, changes nothing after its merges, and has
    no added token that takes part in that or reaches over white space."""

    def state(part) -> dict | None:
        return part and json.loads(part.__getstate__())

    tokens = tokenizer.get_added_tokens_decoder().values()
    return (
        state(tokenizer.normalizer) == NORMALIZER
        and state(tokenizer.pre_tokenizer) == SPLITTER
        and tokenizer.post_processor is None
        and tokenizer.truncation is None
        and tokenizer.padding is None
        and not getattr(tokenizer.model, "dropout", None)
        and not any(t.lstrip or t.rstrip or t.normalized or t.single_word or len(t.content.split()) != 1 for t in tokens)
    )


class WordTable:
    """Ids of the words between white space, as bytes of 32-bit integers.

    The tokenizer drops white space and merges nothing across it, so words can be encoded one by one. Words
    of ASCII and Latin-1 letters fall into runs of letters, single digits and runs of other marks, the same
    as the tokenizer's own; only its merges are left to do, once for each distinct run. Any other word takes
    the tokenizer's whole way. With a tokenizer of other rules (see ``by_words``) every text takes it whole.
    """

    # The tokenizer's splitting pattern, for plain words in lower case.
    _RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str, size: int = KEPT_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.whole = not by_words(self.tokenizer)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a word that may hold a special token takes the whole way too
        ranges = ((0x21, 0x7F), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x100))
        plain = {chr(c) for a, b in ranges for c in range(a, b)} - {t[0] for t in added if t}
        self.plain = re.compile(f"[{re.escape(''.join(sorted(plain)))}]+").fullmatch
        self.model = self.tokenizer.model
        by_byte = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: by_byte.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.words, self.runs = Recent(size), Recent(size // 2)

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            mapped = run if run.isascii() else run.translate(self.letters)
            ids = pack("i", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            self.runs.put(run, ids)
        return ids

    def ids(self, word: bytes) -> bytes:
        """The ids of one word."""
        found = self.words.get(word)
        if found is None:
            text = word.decode("utf-8", "replace")
            if text.isascii() and text.isalpha():
                found = self._run(text.lower())
            elif self.plain(text):
                found = b"".join(map(self._run, self._RUNS.findall(text.lower())))
            else:
                found = pack("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            self.words.put(word, found)
        return found

    def encode(self, texts: list[bytes], end_id: int) -> pa.ListArray:
        """The ids of each text and the end id."""
        end, joined = pack("i", [end_id]).tobytes(), []
        if self.whole:
            decoded = [t.decode("utf-8", "replace") for t in texts]
            found = self.tokenizer.encode_batch_fast(decoded, add_special_tokens=False)
            joined = [pack("i", f.ids).tobytes() + end for f in found]
            return self._lists(joined)
        # there are no cycles here, and the collector would walk all that is kept
        gc.disable()
        try:
            for text in texts:
                words = text.split()
                found = list(map(self.words.new.get, words))
                if None in found:
                    found = [self.ids(w) if ids is None else ids for w, ids in zip(words, found)]
                joined.append(b"".join(found) + end)
        finally:
            gc.enable()
        return self._lists(joined)

    @staticmethod
    def _lists(joined: list[bytes]) -> pa.ListArray:
        sizes = np.fromiter(map(len, joined), np.int32, len(joined)) // 4
        return lists(np.frombuffer(b"".join(joined), "<i4"), sizes)


def encode(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, ids): the tokens of each text and the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = worker_state("word tables")
        if tokenizer_path not in tables:
            tables[tokenizer_path] = WordTable(tokenizer_path)
        for batch in parts(batches, limit=BATCH_BYTES):
            ids = tables[tokenizer_path].encode(raw(batch), end_id)
            yield pa.RecordBatch.from_pydict(keyed(batch) | {"ids": ids})

    return per_batch(texts_of(docs), run, "ids array<int>")


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write the ids of all documents as ORC, files and rows in ascending order of doc_id."""
    order = ["doc_id", F.xxhash64("text")]
    ordered = texts_of(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    (
        encode(ordered, tokenizer_path, end_id)
        .select(
            "doc_id",
            "ids",
            F.size("ids").cast("long").alias("n_tokens"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        )
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("compression", "snappy")
        .orc(path)
    )


def read(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The stored rows, all or those of some documents; the choice reaches the files' indexes."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def with_crc(rows: DataFrame) -> DataFrame:
    """``n_tokens`` and the crc32 of the ids as little-endian 32-bit integers, instead of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            ends = column.offsets.to_numpy()
            ids = memoryview(column.values.to_numpy().astype("<u4").tobytes())
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            new = {
                "n_tokens": pa.array(np.diff(ends), pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(keyed(batch, "ids") | new)

    kept = [c for c in rows.columns if c not in ("ids", "n_tokens")]
    schema = ", ".join(f"`{c}` {dict(rows.dtypes)[c]}" for c in kept)
    return map_batches(rows.select(*kept, "ids"), run, f"{schema}, n_tokens bigint, ids_crc32 bigint")


def offsets(rows: DataFrame) -> DataFrame:
    """(part, before): the ids in all files before each file, from the stored lengths alone."""
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
    # one row for each file
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("before"))


def token_index(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the files and return (doc_id, start, n_tokens, ids_crc32) as read back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write(docs, path, tokenizer_path, end_id)
    rows = read(spark, path)
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return (
        with_crc(rows)
        .join(F.broadcast(offsets(rows)), "part")
        .select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
    )
