"""Quality classifier: regularised quadratic discriminant analysis on document statistics.

The statistics are transformed to logarithms and shares of bounded range. One aggregation gives each
class's count, means and products; the class covariances are shrunk towards the pooled covariance and
a multiple of the identity. A score is the difference of the two log-densities, whose Mahalanobis
distances use the Cholesky factors that the model carries.

Only labelled rows outside the held-out fifth are learned from, all of them. A text without words has
statistics like any other and gets a score. Rows without a label of 0 or 1 are not learned from; a
document with several labels counts once for each. Without both classes every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm import stats
from recflow.llm.common import map_batches

from recflow.session import materialize

THRESHOLD = 0.3
SHRINK = 0.1
RIDGE = 1e-3
# Log-density differences are divided by this, so that scores keep apart near 0 and 1.
TEMPERATURE = 4.0


def features() -> list[Column]:
    """The transformed statistics; all finite for any counts."""
    c = {n: F.col(n).cast("double") for n in stats.COUNTS}
    words, chars, lines = (F.greatest(c[n], F.lit(1.0)) for n in ("n_words", "word_chars", "n_lines"))
    share = lambda a, b: F.sqrt(c[a] / b)
    return [
        F.log1p(c["n_words"]),
        F.log1p(c["word_chars"] / words),
        F.log1p(c["longest_word"]),
        F.log1p(c["n_words"] / lines),
        share("n_symbols", chars),
        share("n_upper", chars),
        share("n_digits", chars),
        share("n_marks", chars),
        share("n_ends", words),
        share("n_dup_lines", lines),
        share("n_repeat_words", words),
        share("n_distinct_words", words),
    ]


@dataclass(frozen=True)
class Model:
    """Means, inverses of the Cholesky factors, and constants of the two log-densities."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.means):
            return np.full(len(x), 0.5)
        log = [
            k - 0.5 * np.square((x - m) @ f.T).sum(axis=1)
            for m, f, k in zip(self.means, self.factors, self.constants)
        ]
        return 1.0 / (1.0 + np.exp(np.clip((log[0] - log[1]) / TEMPERATURE, -700.0, 700.0)))


def fit(rows: DataFrame, shrink: float = SHRINK, ridge: float = RIDGE) -> Model:
    """The model of ``x`` (an array) and ``label``, from one aggregation over all rows."""
    d = len(features())
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("label").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(a) for a in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"),
    )
    found = {r.label: r for r in sums.collect()}
    if set(found) != {0, 1}:
        return Model(np.empty((0, d)), np.empty((0, d, d)), np.empty(0))
    means, spreads, sizes = [], [], []
    for label in (0, 1):
        r = found[label]
        mean = np.array(r.s) / r.n
        product = np.zeros((d, d))
        for (i, j), v in zip(pairs, r.p):
            product[i, j] = product[j, i] = v / r.n
        means.append(mean)
        spreads.append(product - np.outer(mean, mean))
        sizes.append(r.n)
    total = sum(sizes)
    pooled = reduce(add, (s * n / total for s, n in zip(spreads, sizes)))
    factors, constants = [], []
    for spread, n in zip(spreads, sizes):
        shrunk = (1 - shrink) * spread + shrink * pooled + ridge * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(factor))
        constants.append(np.log(n / total) - np.log(np.diag(factor)).sum())
    return Model(np.array(means), np.array(factors), np.array(constants))


def held_out(folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id's digits leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    found = stats.document_stats(docs).select("doc_id", F.array(*features()).alias("x"))
    found = materialize(found, "statistics")
    known = labels.select("doc_id", F.col(label).alias("label")).where("label in (0, 1)")
    model = fit(found.where(~held_out()).join(known, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(model.scores(x))})

    kind = found.schema["doc_id"].dataType.simpleString()
    return map_batches(found, run, f"doc_id {kind}, score double").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
