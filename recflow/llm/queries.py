"""The numbered queries over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.llm import (
    boosted,
    fmindex,
    jaccard,
    licenses,
    mixing,
    pieces,
    quadratic,
    repeats,
    secret_scan,
    simhash,
    spelling,
    tokenfile,
    turns,
)
from recflow.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def piece_digests(docs: DataFrame) -> DataFrame:
    """Encode, decode, and digest both."""
    return pieces.encode(docs, PIECES, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_index(table(spark, sf_dir, "documents"), WORDS, END_ID)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_counts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def secret_counts(docs: DataFrame) -> DataFrame:
    kinds = [r.kind for r in secret_scan.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return (
        secret_scan.find(docs)
        .withColumn("base", base)
        .select(
            "doc_id",
            *[count(k).alias(f"n_{k}") for k in kinds],
            F.sha2(secret_scan.digest("base"), 256).alias("base_sha256"),
            secret_scan.digest("spans").alias("spans"),
        )
    )


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination_digests(fmindex.contamination(docs, table(spark, sf_dir, "benchmark")))


def contamination_digests(found: DataFrame) -> DataFrame:
    lengths = F.transform("spans", lambda s: s["end"] - s["start"])
    return found.withColumn("n_hit", F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op1_licenses"] = licenses.duckdb_sql()


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quadratic.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = boosted.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", *boosted.BASE, "base_failed", "kept", "score")


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"), across=True)


@query
def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.clusters(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    damaged = turns.damage(conversations)
    return turns.report(damaged, turns.repair(damaged), conversations)


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
