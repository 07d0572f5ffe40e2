"""Benchmark decontamination with an FM-index of each shard of the documents.

A shard is a batch of documents as sequences of word numbers. Words that no test phrase has cannot be in an
occurrence; they end a run, and runs shorter than the shortest phrase are left out. Over the runs a task
builds a suffix array, its Burrows-Wheeler transform and a wavelet matrix for ranks. All phrases are searched
backwards at the same time; the rows of each found phrase are walked to the next sampled suffix, which gives
the place. Overlapping places are merged into spans of words to remove.

The phrases are a stated query set, taken in blocks of bounded size and sent to every task. Null and empty
texts, of documents or items, have no words. Items of fewer words than a phrase are one phrase. Repeated rows
are searched each by itself. Items without an id are searched and removed like all others, but have no place in
the list of items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from recflow.llm.common import keyed, map_batches, others, parts, quoted, raw
from recflow.session import materialize

WINDOW = 10
# Bytes of item texts that are searched in one pass over the documents.
BLOCK_BYTES = 2 << 20
SAMPLE = 8

# Bytes up to 127 other than digits and letters part words; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Ranks:
    """A wavelet matrix: how often a symbol occurs before a place, for many questions at once."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            zeros_before = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(~ones, out=zeros_before[1:])
            self.levels.append((bit, zeros_before))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def __call__(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        begin, end = np.zeros_like(place), place
        for bit, zeros in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            b, e = zeros[begin], zeros[end]
            begin = np.where(one, zeros[-1] + begin - b, b)
            end = np.where(one, zeros[-1] + end - e, e)
        return end - begin


class FMIndex:
    """Over a sequence of symbols from 1 to ``top``, with 0 between runs and at the end."""

    def __init__(self, text: np.ndarray, top: int) -> None:
        n = len(text)
        gaps = np.flatnonzero(text == 0)
        # every gap is a symbol of its own, so that suffixes differ at the end of their run at the latest
        rank = text + len(gaps) - 1
        rank[gaps] = np.arange(len(gaps))
        longest = int(np.diff(np.concatenate([[-1], gaps])).max())
        width, order = 1, np.argsort(rank, kind="stable")
        while width < longest:
            after = np.full(n, -1, np.int64)
            after[: n - width] = rank[width:]
            key = rank * (n + len(gaps) + top + 2) + after + 1
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
            width *= 2
        self.transform = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.ranks = Ranks(self.transform, top)
        # the first place of every run is sampled too, so no walk has to cross a gap
        sampled = (order % SAMPLE == 0) | (self.transform == 0)
        self.sampled = sampled
        self.nth = np.cumsum(sampled) - 1
        self.places = order[sampled]

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) that begin with each phrase; one phrase a line, filled up with zeros."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.transform))
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((step < sizes) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, sizes[live] - 1 - step]
            low[live] = self.before[symbol] + self.ranks(symbol, low[live])
            high[live] = self.before[symbol] + self.ranks(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes of these rows."""
        out, walked = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        left, row = np.arange(len(rows)), rows.copy()
        while len(left):
            known = self.sampled[row]
            out[left[known]] = self.places[self.nth[row[known]]] + walked[left[known]]
            left, row = left[~known], row[~known]
            walked[left] += 1
            symbol = self.transform[row]
            row = self.before[symbol] + self.ranks(symbol, row)
        return out


class Phrases:
    """The distinct phrases of some items: numbers of their words, and the items that have each."""

    def __init__(self, items: Sequence[tuple[object, bytes]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[object]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                own = found.setdefault(tuple(ids[i : i + window]), set())
                if item is not None:
                    own.add(item)
        self.sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.shortest = int(self.sizes.min()) if found else 0
        self.symbols = np.zeros((len(found), window), np.int64)
        for i, phrase in enumerate(found):
            self.symbols[i, : len(phrase)] = phrase
        self.items = [sorted(x) for x in found.values()]

    def hits(self, texts: list[list[bytes]]) -> Iterator[tuple[int, int, int, int]]:
        """(text number, first word, end, phrase number) of every occurrence."""
        if not self.items:
            return
        number = self.number
        ids = np.fromiter(
            chain.from_iterable([*(number.get(w, 0) for w in t), 0] for t in texts),
            np.int64,
            sum(map(len, texts)) + len(texts),
        )
        gaps = np.concatenate([[-1], np.flatnonzero(ids == 0)])
        runs = np.flatnonzero(np.diff(gaps) > self.shortest)
        if not len(runs):
            return
        begin, size = gaps[runs] + 1, np.diff(gaps)[runs]
        moved = np.cumsum(size) - size
        text = ids[np.repeat(begin - moved, size) + np.arange(size.sum())]
        index = FMIndex(text, len(number))
        low, high = index.search(self.symbols, self.sizes)
        count = high - low
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
        place = index.locate(rows)
        run = np.searchsorted(moved, place, side="right") - 1
        place = begin[run] + place - moved[run]
        ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(ends, place, side="right")
        start = place - np.concatenate([[0], ends])[owner]
        yield from zip(owner.tolist(), start.tolist(), (start + self.sizes[phrase]).tolist(), phrase.tolist())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for start, end in spans:
        out.append(text[done : places[start][0]])
        done = places[end - 1][1]
    return b"".join([*out, text[done:]])


# The columns that a scan adds; a document's own ones of these names are replaced.
ADDED = ("n_words", "spans", "items")


def _block(rows: DataFrame, k: int, n: int) -> list[tuple[object, bytes]]:
    """The ``k``-th of ``n`` blocks of the items, as (item_id, text)."""
    some = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
    return [(r.item_id, r.text.encode()) for r in some.collect()]


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, remove: bool = False
) -> DataFrame:
    """The columns of ``docs`` with ``n_words``, ``spans`` of hit words (start, end), and ``items``, sorted.

    The text is left out, or comes without the hit words if ``remove`` is set; a null text stays null. With
    several blocks the passes follow each other and the spans are merged; what a pass leaves is written, so that
    the driver and a task hold the phrases of one block. Ids of items may be of any type.
    """
    out = docs.select(*others(docs, "text", *ADDED), "text")
    rows = items.where("text is not null").select("item_id", "text")
    kind = items.schema["item_id"].dataType
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = total // block_bytes + 1
    for k in range(n):
        out = _scan(out, Phrases(_block(rows, k, n), window), kind, first=k == 0, last=k == n - 1, remove=remove)
        if k < n - 1:
            out = materialize(out, "scanned")
    return out


def _scan(docs: DataFrame, book: Phrases, item: DataType, first: bool, last: bool, remove: bool) -> DataFrame:
    ids = pa.list_(to_arrow_type(item))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    keep_text = not last or remove

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            given = raw(batch)
            cut = [words(t or b"") for t in given]
            if first:
                spans, items = [[] for _ in cut], [set() for _ in cut]
            else:
                spans = [[(s["start"], s["end"]) for s in x] for x in batch.column("spans").to_pylist()]
                items = [set(x) for x in batch.column("items").to_pylist()]
            for k, start, end, phrase in book.hits(cut):
                spans[k].append((start, end))
                items[k].update(book.items[phrase])
            spans = [merged(x) for x in spans]
            columns = {n: c for n, c in keyed(batch).items() if n not in ("n_words", "spans", "items")}
            columns["n_words"] = pa.array([len(x) for x in cut], pa.int64())
            columns["spans"] = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], span)
            columns["items"] = pa.array([sorted(x) for x in items], ids)
            if keep_text:
                new = [without(t, x) if last and x else t for t, x in zip(given, spans)]
                columns["text"] = pa.array(new, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    rest = [f for f in docs.schema if f.name not in ("text", *ADDED)]
    plain = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rest)
    result = f"n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<{item.simpleString()}>"
    schema = ", ".join(x for x in (plain, result, "text string" if keep_text else "") if x)
    return map_batches(docs, run, schema)
