"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary has a white-space marker behind another character, so no merge crosses the
place before a run of markers. A text falls into chunks, each a run of markers and the characters up to
the next; every distinct chunk of a batch is segmented once, and the ids are joined back by position.
The model must have an identity normalizer and a dummy prefix, and must keep extra white space.

Null and empty texts have no ids; texts of white space only, very long texts and repeated rows take the
same way as all others. Extra columns are kept, columns called like the result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import keyed, lists, others, parts, per_batch, strings

MARK = "▁"
_CHUNKS = re.compile(" *[^ ]+| +$")


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker, markers as spaces."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c[1:] for c in _CHUNKS.findall(" " + text)]


def check_vocabulary(model: sentencepiece.SentencePieceProcessor) -> None:
    """Refuse a model that the distinct-chunk table would segment differently."""
    for i in range(model.vocab_size()):
        if MARK in model.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a white-space marker")
    if model.decode(model.encode("  a  b ")) != "  a  b " or model.encode("a")[:1] != model.encode("a b")[:1]:
        raise ValueError("the model changes white space")


class ChunkTable:
    """The ids of distinct chunks, segmented by the library, for one batch of texts at a time."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.mark = [self.model.piece_to_id(MARK)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [chunks(t) for t in texts]
        distinct = list(dict.fromkeys(chain.from_iterable(cut)))
        ids = dict(zip(distinct, self.model.encode(distinct, num_threads=1)))
        if "" in ids:  # a single marker at the end of a text; the library adds none to an empty text
            ids[""] = self.mark
        return [list(chain.from_iterable([ids[c] for c in cs])) for cs in cut]


def encode(docs: DataFrame, model_path: str, decoded: bool = False) -> DataFrame:
    """The documents with ``ids``, instead of their texts; with ``decoded``, the text that the ids decode to."""
    check_vocabulary(sentencepiece.SentencePieceProcessor(model_file=model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model_path)
        for batch in parts(batches):
            found = table.encode(strings(batch))
            sizes = np.fromiter(map(len, found), np.int32, len(found))
            values = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            columns = keyed(batch) | {"ids": lists(values, sizes)}
            if decoded:
                columns["text"] = pa.array([table.model.decode(x) if x else "" for x in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    texts = docs.select(*others(docs, "text", "ids"), F.coalesce("text", F.lit("")).alias("text"))
    return per_batch(texts, run, "ids array<int>" + ", text string" * decoded)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """The frame with ``text``, the library's decoding of ``ids``; null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [model.decode(x) if x else "" for x in map(_ints, part.column("ids"))]
                yield pa.RecordBatch.from_pydict(keyed(part) | {"text": pa.array(texts, pa.string())})

    return per_batch(encoded.select(*others(encoded, "text")), run, "text string")


def _ints(value: pa.ListScalar) -> list[int]:
    return value.values.to_numpy(zero_copy_only=False).tolist() if value.is_valid else []
