"""Statistics of documents, counted in one pass over the texts.

A null text counts as the empty text; a text without words has zeros everywhere. Whole texts are counted,
whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recflow.llm.common import UPPER, keyed, parts, per_batch, raw, texts_of

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = UPPER.encode()
_INSIDE = bytes(range(0x80, 0xC0))

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_ends",
    "longest_word",
)
SCHEMA = ", ".join(f"{c} bigint" for c in COUNTS)


def _number(text: bytes, wanted: bytes) -> int:
    return len(text) - len(text.translate(None, wanted))


def repeated_words(cut: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """For each text, the words inside windows that occur twice or more in it."""
    sizes = np.fromiter(map(len, cut), np.int64, len(cut))
    total = int(sizes.sum())
    out = np.zeros(len(cut), np.int64)
    if total < window:
        return out
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in chain.from_iterable(cut)), np.int64, total)
    owner = np.repeat(np.arange(len(cut)), sizes)
    # the window's words and its text, hashed; equal hashes are compared word by word below
    with np.errstate(over="ignore"):
        key = owner[: total - window + 1].astype(np.uint64)
        for j in range(window):
            key = (key ^ ids[j : total - window + 1 + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    inside = np.flatnonzero(owner[: total - window + 1] == owner[window - 1 :])
    order = inside[np.argsort(key[inside], kind="stable")]
    first, second = order[:-1], order[1:]
    same = np.flatnonzero((key[first] == key[second]) & (owner[first] == owner[second]))
    first, second = first[same], second[same]
    for j in range(window):
        equal = ids[first + j] == ids[second + j]
        first, second = first[equal], second[equal]
    change = np.zeros(total + 1, np.int64)
    starts = np.unique(np.concatenate([first, second]))
    change[starts] += 1
    np.subtract.at(change, starts + window, 1)
    covered = np.cumsum(change[:-1]) > 0
    np.add.at(out, owner[covered], 1)
    return out


def counts(texts: list[bytes]) -> np.ndarray:
    """A row for each text, a column for each of ``COUNTS``."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    cut = [t.split() for t in texts]
    for row, text, found in zip(out, texts, cut):
        if not found:
            row[2] = _number(text, SYMBOLS)
            continue
        lines = [x for x in text.split(b"\n") if x.strip()]
        letters = text.translate(None, _UPPER)
        row[:] = (
            len(found),
            len(text.translate(None, _SPACE + _INSIDE)),
            _number(text, SYMBOLS),
            len(lines) - len(set(lines)),
            0,
            len(lines),
            len(set(found)),
            len(text) - len(letters),
            _number(text, b"0123456789"),
            _number(text, b"!?"),
            _number(text, b".,;:"),
            len(max(found, key=len)),
        )
    out[:, COUNTS.index("n_repeat_words")] = repeated_words(cut)
    return out


def document_stats(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, the columns ``more``, the counts) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = counts(raw(batch))
            columns = {c: pa.array(found[:, i]) for i, c in enumerate(COUNTS)}
            yield pa.RecordBatch.from_pydict(keyed(batch) | columns)

    return per_batch(texts_of(docs, *more), run, SCHEMA)
