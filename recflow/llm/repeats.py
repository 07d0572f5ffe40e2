"""Removal of repeated passages, with a count-min prefilter over all windows of words.

First pass: every task counts the hashes of its windows into two rows of cells and sends what it found, cell
by cell; the cells of all tasks are added up slice by slice. A cell never counts less than any window in it.
Second pass: only windows whose two cells both counted twice or more are grouped, by 96 bits of hash, for the
smallest document that has each. Third pass: a document keeps the first place of a window it is the smallest
for, and loses the words of all its other repeated windows. No repeated window is lost on the way; one that
passes the filter by chance is alone in its group and stays.

The number of cells follows the size of the texts up to ``MOST_CELLS``, which bounds what a task holds and
the driver sends (an eighth of a byte a cell and row). Beyond, more windows pass to the exact grouping.

Null and empty texts have no words. Documents without an id come last in the order, among each other by a hash
of their text. Rows of one place in the order, those that share an id or lack one and share the text, each keep
the first place of their windows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from recflow.llm.common import map_batches, parts, raw, texts_of, worker_state
from recflow.operators.joins import lookup
from recflow.operators.ranking import rank_within
from recflow.session import materialize

WINDOW = 20
ROWS = 2
MOST_CELLS = 1 << 29
LEAST_CELLS = 1 << 16
SLICE_BITS = 20
# Windows whose cells a task gathers before it sends them; the closer the cells, the shorter they are.
SENT_WINDOWS = 1 << 22
# Bytes of cells that a task sends in one batch; a slice is never cut.
SENT_BYTES = 2 << 20
# Cells that one merging task counts.
MERGE_CELLS = 1 << 24
# Where documents without an id begin; ids must be smaller.
AFTER_IDS = 1 << 62
# Text whose windows a task has at hand; each needs some dozen numbers.
BATCH_BYTES = 1 << 20

# Odd multipliers of the two window hashes, and of the final mixing.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Windows:
    """The windows of a batch of texts: owner, place in the joined words, two hashes each."""

    def __init__(self, cut: list[list[bytes]], window: int) -> None:
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        total = int(sizes.sum())
        digest = xxhash.xxh3_64_intdigest
        words = np.fromiter((digest(w) for w in chain.from_iterable(cut)), np.uint64, total)
        owner = np.repeat(np.arange(len(cut)), sizes)
        self.total, self.window = total, window
        self.n = max(0, total - window + 1)
        self.at = np.flatnonzero(owner[: self.n] == owner[window - 1 :]) if self.n else np.zeros(0, np.int64)
        self.owner = owner[self.at]
        self.first, self.second = (self._hash(words, window, f)[self.at] for f in _FACTORS)

    def _hash(self, words: np.ndarray, window: int, factor: int) -> np.ndarray:
        """A polynomial over the words of each window, put together from spans of doubling length."""
        out, width = np.zeros(len(words) + 1, np.uint64), 0
        span, step, power = words, 1, factor  # hashes of `step` words, and the factor to that power
        if not self.n:
            return out[:0]
        with np.errstate(over="ignore"):
            while step <= window:
                if window & step:
                    n = len(span) - width
                    out, width = out[:n] * np.uint64(power) + span[width:], width + step
                if 2 * step <= window:
                    span = span[:-step] * np.uint64(power) + span[step:]
                step, power = 2 * step, power * power % (1 << 64)
            out = (out ^ (out >> np.uint64(32))) * _MIX
            return out ^ (out >> np.uint64(29))

    def cells(self, bits: int) -> list[np.ndarray]:
        return [(h >> np.uint64(64 - bits)).astype(np.uint32) for h in (self.first, self.second)]


def _sketch_rows(gathered: list[list[np.ndarray]]) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(row, slice, cells, whether each counts twice): cells as differences, their bytes in planes.

    What was gathered is let go row by row, and a slice is worked on at a time.
    """
    for row, own in enumerate(gathered):
        all_cells = np.concatenate(own)
        own.clear()
        all_cells.sort()
        last = int(all_cells[-1]) >> SLICE_BITS if len(all_cells) else -1
        # the cells of a slice end where the next one's would begin
        ends = np.searchsorted(all_cells, (np.arange(last + 2, dtype=np.uint64) << SLICE_BITS).astype(np.uint32))
        ends[-1] = len(all_cells)
        for part, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
            if b > a:
                cells = all_cells[a:b]
                new = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
                twice = np.diff(np.append(new, len(cells))) > 1
                inside = cells[new] & np.uint32((1 << SLICE_BITS) - 1)
                steps = np.diff(inside, prepend=np.uint32(0)).astype("<u4")
                planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4)[:, :3].T).tobytes()
                yield row, part, planes, np.packbits(twice).tobytes()


def _cells_of(planes: bytes) -> np.ndarray:
    steps = np.zeros((len(planes) // 3, 4), np.uint8)
    steps[:, :3] = np.frombuffer(planes, np.uint8).reshape(3, -1).T
    return np.cumsum(steps.view("<u4").reshape(-1))


def cells_for(docs: DataFrame, most: int) -> int:
    """The bits of a cell number: about four cells a window, a power of two."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return (min(max(size // 2, LEAST_CELLS), most) - 1).bit_length()


def sketch(docs: DataFrame, window: int, bits: int) -> list[tuple[int, int, bytes]]:
    """(row, slice, bits) of the count-min sketch: a bit for each cell that counts twice or more, compressed."""

    kinds = {"line": pa.int32(), "slice": pa.int32(), "cells": pa.binary(), "twice": pa.binary()}

    def sent(gathered: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in _sketch_rows(gathered):
            rows.append(row)
            size += len(row[2])
            if size >= SENT_BYTES:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def batch_of(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(kinds.items())}
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a worker may still hold the sketch of an earlier job
        worker_state("sketches").clear()
        gathered: list[list[np.ndarray]] = [[] for _ in range(ROWS)]
        for batch in parts(batches, limit=BATCH_BYTES):
            for own, cells in zip(gathered, Windows([t.split() for t in raw(batch)], window).cells(bits)):
                own.append(cells)
            if sum(map(len, gathered[0])) >= SENT_WINDOWS:
                yield from sent(gathered)
                gathered = [[] for _ in range(ROWS)]
        if gathered[0]:
            yield from sent(gathered)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for line, part, planes, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if (line, part) not in counts:
                    counts[line, part] = np.zeros(1 << SLICE_BITS, np.uint8)
                own, cells = counts[line, part], _cells_of(planes)
                more = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(cells))
                own[cells] = np.minimum(own[cells] + 1 + more, 2)
        for (line, part), own in counts.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "line": pa.array([line], pa.int32()),
                    "slice": pa.array([part], pa.int32()),
                    # few cells count twice, so the bits compress well
                    "bits": pa.array([zlib.compress(np.packbits(own > 1).tobytes(), 1)], pa.binary()),
                }
            )

    tasks = max(1, (ROWS << bits) // MERGE_CELLS)
    found = map_batches(docs.select("text"), count, "line int, slice int, cells binary, twice binary")
    merged = map_batches(found.repartition(tasks, "line", "slice"), merge, "line int, slice int, bits binary")
    # a bounded number of slices
    return [(r.line, r["slice"], bytes(r.bits)) for r in merged.collect()]


def _unpacked(sent: Broadcast, name: str, bits: int) -> np.ndarray:
    """The rows of the sketch that a broadcast holds, unpacked once in each Python worker."""
    state = worker_state("sketches")
    if name not in state:
        state.clear()
        rows = np.zeros((ROWS, (1 << bits) // 8), np.uint8)
        for line, part, packed in sent.value:
            at = part << (SLICE_BITS - 3)
            own = np.frombuffer(zlib.decompress(packed), np.uint8)[: rows.shape[1]]
            rows[line, at : at + len(own)] = own
        state[name] = rows
        # the worker would keep the packed value too
        vars(sent).pop("_value", None)
    return state[name]


def _repeated(windows: Windows, counted: np.ndarray, bits: int) -> np.ndarray:
    """Windows whose cells all count twice or more."""
    out = np.ones(len(windows.at), bool)
    for row, cells in zip(counted, windows.cells(bits)):
        out &= (row[cells >> np.uint32(3)] >> (np.uint8(7) - (cells & np.uint32(7)).astype(np.uint8)) & np.uint8(1)) > 0
    return out


def _firsts(windows: Windows, some: np.ndarray) -> np.ndarray:
    """Of the windows numbered ``some``, the first of each hash in its text."""
    order = some[np.lexsort((some, windows.first[some], windows.owner[some]))]
    if not len(order):
        return order
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(windows.owner[order]) != 0) | (np.diff(windows.first[order]) != 0)
    return order[new]


def smallest(docs: DataFrame, window: int, counted: Broadcast, name: str, bits: int) -> DataFrame:
    """(place, first): for each document, the hashes of the repeated windows it is the smallest for."""

    def asked(batch: pa.RecordBatch) -> pa.RecordBatch:
        windows = Windows([t.split() for t in raw(batch)], window)
        own = _firsts(windows, np.flatnonzero(_repeated(windows, _unpacked(counted, name, bits), bits)))
        place = batch.column("place").to_numpy()[windows.owner[own]]
        return pa.RecordBatch.from_pydict(
            {
                "first": pa.array(windows.first[own].view(np.int64)),
                "second": pa.array(windows.second[own].astype(np.uint32).view(np.int32)),
                "place": pa.array(place, pa.int64()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, limit=BATCH_BYTES):
            yield asked(batch)

    seen = map_batches(docs.select("place", "text"), run, "first bigint, second int, place bigint")
    return seen.groupBy("first", "second").agg(F.min("place").alias("place")).select("place", "first")


def _gone(windows: Windows, mine: pa.ListArray, counted: np.ndarray, bits: int) -> np.ndarray:
    """For each word, whether a window covers it that starts earlier, too; ``mine`` are each text's own windows."""
    again = _repeated(windows, counted, bits)
    first = _firsts(windows, np.flatnonzero(again))
    ends = np.cumsum(np.bincount(windows.owner[first], minlength=len(mine)))
    for k, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
        if b > a and mine[k].is_valid:
            some = first[a:b]
            again[some[np.isin(windows.first[some].view(np.int64), mine[k].values.to_numpy())]] = False
    change = np.zeros(windows.total + 1, np.int64)
    change[windows.at[again]] += 1
    change[windows.at[again] + windows.window] -= 1
    return np.cumsum(change[:-1]) > 0


def _placed(texts: DataFrame) -> DataFrame:
    """The texts with their ``place``, by which one is earlier: the id, or the rank of an id that is no whole number.

    Rows without an id come last.
    """
    by_text = F.lit(AFTER_IDS) + F.xxhash64("text").bitwiseAND(AFTER_IDS - 1)
    if isinstance(texts.schema["doc_id"].dataType, IntegralType):
        return texts.withColumn("place", F.coalesce(F.col("doc_id").cast("long"), by_text))
    ids = texts.select("doc_id").where("doc_id is not null").distinct()
    ranks = materialize(rank_within(ids, [], ["doc_id"], "_rank"), "ranks")
    ranked = lookup(texts, ranks.select("doc_id", "_rank"), ["doc_id"], "left")
    return ranked.select("doc_id", "text", F.coalesce(F.col("_rank").cast("long"), by_text).alias("place"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, most_cells: int = MOST_CELLS) -> DataFrame:
    """(doc_id, n_words, n_removed, text): each document without repeated passages, words joined by spaces."""
    spark = docs.sparkSession
    texts = _placed(texts_of(docs))
    bits = cells_for(texts, most_cells)
    counted = spark.sparkContext.broadcast(sketch(texts, window, bits))
    name = uuid.uuid4().hex
    own = smallest(texts, window, counted, name, bits).groupBy("place").agg(F.collect_list("first").alias("firsts"))

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut = [t.split() for t in raw(batch)]
        gone = _gone(Windows(cut, window), batch.column("firsts"), _unpacked(counted, name, bits), bits)
        left, removed, at = [], [], 0
        for words in cut:
            own = gone[at : at + len(words)]
            at += len(words)
            n = int(np.count_nonzero(own))
            removed.append(n)
            left.append(b" ".join(words if not n else [w for w, g in zip(words, own.tolist()) if not g]))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(list(map(len, cut)), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "text": pa.array(left, pa.binary()).cast(pa.string()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, limit=BATCH_BYTES):
            yield kept(batch)

    kind = texts.schema["doc_id"].dataType.simpleString()
    joined = lookup(texts, own, ["place"], "left").select("doc_id", "text", "firsts")
    return map_batches(joined, run, f"doc_id {kind}, n_words bigint, n_removed bigint, text string")
