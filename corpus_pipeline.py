"""From raw documents to token ids: quality, near duplicates, benchmark passages, secrets, encoding.

Each stage takes the documents that the one before left and returns them with its decision carried out; the
last one encodes them. A null text stays null until it is encoded as the empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm import boosted, fmindex, secret_scan, simhash
from recflow.llm.common import apart, put_back, table
from recflow.llm.queries import piece_digests
from recflow.session import materialize


def _documents(changed: DataFrame, like: DataFrame, moved: dict[str, str]) -> DataFrame:
    """The columns of documents, with the length of the changed text."""
    if "n_chars" in like.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(like.schema["n_chars"].dataType))
    return put_back(changed, like.columns, moved)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return boosted.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs, words=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words inside benchmark passages."""
    own, moved = apart(docs, *fmindex.ADDED)
    found = fmindex.contamination(own, table(spark, sf_dir, "benchmark"), remove=True)
    return _documents(found, docs, moved)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a placeholder for every secret."""
    own, moved = apart(docs, "spans")
    return _documents(secret_scan.find(own, redact=True), docs, moved)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of its decoding."""
    return piece_digests(docs.select("doc_id", "text"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]

# The trees and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each leaves is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
