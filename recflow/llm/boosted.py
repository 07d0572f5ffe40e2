"""Quality rules: fixed limits, then gradient-boosted trees over document statistics.

The trees are fitted with the logistic loss on a bounded sample of labelled documents, on binned features
and with the sign of the effect fixed for chosen features: more symbols, repetition or capitals never make a
document look better. A fitted model is four node arrays; scoring walks all rows of a batch down one tree
level at a time.

A text without words has zeros in all statistics and fails the base rule. Documents with several labels
count once for each. Without both classes in the labels, the trees keep every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import keyed, map_batches, parts, per_batch, raw, texts_of
from recflow.llm.stats import COUNTS, document_stats
from recflow.llm.stats import counts as counts_of

LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
# The labelled documents that the trees are fitted on, at most; the first by the hash of their id.
SAMPLE_ROWS = 20_000
KEEP_SCORE = 0.5
TREES, DEPTH, RATE, BINS, LEAST_ROWS, PENALTY = 60, 3, 0.2, 32, 20, 1.0

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Feature and the sign its effect must have, 0 for none.
FEATURES = (
    ("words", 0),
    ("word_length", 0),
    ("longest_word", 0),
    ("symbol_share", -1),
    ("upper_share", -1),
    ("digit_share", 0),
    ("mark_share", -1),
    ("end_share", 0),
    ("duplicate_line_share", -1),
    ("repeated_word_share", -1),
    ("distinct_share", 0),
)


def features(counts: np.ndarray) -> np.ndarray:
    """The values of ``FEATURES``, a row for each row of ``stats.counts``."""
    c = dict(zip(COUNTS, counts.T.astype(float)))
    words, chars, lines = (np.maximum(c[n], 1.0) for n in ("n_words", "word_chars", "n_lines"))
    return np.stack(
        [
            c["n_words"],
            c["word_chars"] / words,
            c["longest_word"],
            c["n_symbols"] / chars,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_marks"] / chars,
            c["n_ends"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_distinct_words"] / words,
        ],
        axis=1,
    )


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Too few words, or too many of them inside repeated windows."""
    n, repeated = (counts[:, COUNTS.index(c)] for c in ("n_words", "n_repeat_words"))
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


@dataclass(frozen=True)
class Trees:
    """All trees in four arrays of (tree, node); node n has the children 2n + 1 and 2n + 2.

    A node without a split has feature 0 and an infinite limit, and hands its value to the left.
    """

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - len(feature)]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -500.0, 500.0)))


class _Grower:
    """Fits one tree at a time to gradients and curvatures of binned rows."""

    def __init__(self, x: np.ndarray, signs: np.ndarray) -> None:
        self.signs = signs
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        # a feature that is mostly one value still gets limits inside its tail
        for i, c in enumerate(x.T):
            tail = c[(c != np.median(c))]
            if len(tail):
                cuts[i] = np.unique(np.concatenate([cuts[i], np.quantile(tail, np.linspace(0, 1, 9)[:-1])]))
        self.width = max(map(len, cuts)) + 1
        self.limits = np.full((x.shape[1], self.width), np.inf)
        for i, c in enumerate(cuts):
            self.limits[i, : len(c)] = c
        self.bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)

    def _split(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        """The best (gain, feature, bin, left value, right value) within the bounds of the node."""
        d = self.bins.shape[1]
        flat = (self.bins[rows] + np.arange(d) * self.width).reshape(-1)
        count = lambda w: np.bincount(flat, np.repeat(w, d), d * self.width).reshape(d, -1).cumsum(axis=1)
        gl, hl, nl = count(g[rows]), count(h[rows]), count(np.ones(len(rows)))
        gr, hr, nr = gl[:, -1:] - gl, hl[:, -1:] - hl, nl[:, -1:] - nl
        left = np.clip(-gl / (hl + PENALTY), low, high)
        right = np.clip(-gr / (hr + PENALTY), low, high)
        loss = lambda g, h, v: g * v + 0.5 * (h + PENALTY) * v * v
        whole = np.clip(-gl[:, -1:] / (hl[:, -1:] + PENALTY), low, high)
        gain = loss(gl[:, -1:], hl[:, -1:], whole) - loss(gl, hl, left) - loss(gr, hr, right)
        allowed = (nl >= LEAST_ROWS) & (nr >= LEAST_ROWS) & np.isfinite(self.limits)
        allowed &= (right - left) * self.signs[:, None] >= 0
        gain = np.where(allowed, gain, -np.inf)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        return gain[f, b], f, b, left[f, b], right[f, b]

    def tree(self, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        inner = (1 << DEPTH) - 1
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        value = np.zeros(inner + 1)
        out = np.empty(len(g))

        def grow(node: int, rows: np.ndarray, own: float, low: float, high: float) -> None:
            if node >= inner:
                value[node - inner] = own * RATE
                out[rows] = own * RATE
                return
            best = self._split(rows, g, h, low, high) if len(rows) >= 2 * LEAST_ROWS else (0.0,) * 5
            if best[0] <= 1e-9:
                grow(2 * node + 1, rows, own, own, own)
                return
            _, f, b, left, right = best
            feature[node], limit[node] = f, self.limits[f, b]
            goes_left = self.bins[rows, f] <= b
            middle = (left + right) / 2
            # children of a split on a signed feature stay on their side of its middle
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(
                int(self.signs[f]), ((low, high), (low, high))
            )
            grow(2 * node + 1, rows[goes_left], left, *bounds[0])
            grow(2 * node + 2, rows[~goes_left], right, *bounds[1])

        grow(0, np.arange(len(g)), float(-g.sum() / (h.sum() + PENALTY)), -np.inf, np.inf)
        return feature, limit, value, out


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    inner = (1 << DEPTH) - 1
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 1.0)
    bias = float(np.log(y.mean() / (1 - y.mean())))
    grower = _Grower(x, np.array([s for _, s in FEATURES]))
    total, grown = np.full(len(y), bias), []
    for _ in range(TREES):
        p = 1.0 / (1.0 + np.exp(-total))
        *nodes, step = grower.tree(p - y, p * (1 - p))
        total += step
        grown.append(nodes)
    feature, limit, value = (np.array(a) for a in zip(*grown))
    return Trees(feature, limit, value, bias)


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most`` labelled documents; only their texts are counted."""
    known = labels.select("doc_id", F.col(label).alias("label")).where("label in (0, 1)").distinct()
    order = [F.xxhash64("doc_id"), "doc_id", "label"]
    chosen = docs.select("doc_id").distinct().join(known, "doc_id").orderBy(*order).limit(most)
    counted = document_stats(docs.join(F.broadcast(chosen), "doc_id"), "label")
    # an id may have several rows, so the bound is applied to the rows too
    rows = counted.orderBy(*order, *COUNTS).limit(most).select("label", *COUNTS).collect()
    found = np.array([tuple(r) for r in rows], dtype=np.int64).reshape(len(rows), 1 + len(COUNTS))
    return features(found[:, 1:]), found[:, 0].astype(float)


def _model(docs: DataFrame, labels: DataFrame, label: str, most: int) -> Trees:
    return fit(*sample(docs, labels, label, most))


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, the base counts, base_failed, score, kept) of every document, in one pass over the texts."""
    trees = _model(docs, labels, label, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            counts = counts_of(raw(batch))
            failed, score = base_failed(counts), trees.scores(features(counts))
            new = {c: pa.array(counts[:, COUNTS.index(c)]) for c in BASE}
            new |= {"base_failed": pa.array(failed), "score": pa.array(score)}
            new["kept"] = pa.array(~failed & (score >= KEEP_SCORE))
            yield pa.RecordBatch.from_pydict(keyed(batch) | new)

    counts = "".join(f"{c} bigint, " for c in BASE)
    return per_batch(texts_of(docs), run, f"{counts}base_failed boolean, score double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    trees = _model(docs, labels, label, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            counts = counts_of([t or b"" for t in raw(batch)])
            good = ~base_failed(counts) & (trees.scores(features(counts)) >= KEEP_SCORE)
            yield batch.filter(pa.array(good))

    return map_batches(docs, run, docs.schema)
