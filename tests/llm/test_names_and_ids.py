"""Ids that are no whole numbers, and columns whose names hold dots or differ in case from an added one."""

import pytest
from pyspark.sql import functions as F
from test_simhash import slow_fingerprint, slow_groups

import corpus_pipeline
from recflow.llm import fmindex, pieces, queries, repeats, secret_scan, simhash

PASSAGE = " ".join(f"word{i}" for i in range(30))
TEXTS = {
    "b": f"{PASSAGE} one",
    "a": f"two {PASSAGE}",
    "d": "the same text in two rows of the table",
    "c": "the same text in two rows of the table",
    "e": "password = abcdefgh123 stands here",
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, 1, f"own {k}", "x") for k, t in TEXTS.items()] + [(None, None, 2, None, None)]
    return spark.createDataFrame(rows, "doc_id string, text string, `a.b` int, FP string, `t``k` string")


def test_smallest_string_id_stays_and_all_columns(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = {r[0]: tuple(r) for r in kept.collect()}
    groups = slow_groups({k: slow_fingerprint(t) for k, t in TEXTS.items()})
    assert set(found) == set(groups.values()) | {None} and len(found) < len(TEXTS)
    assert found["c"] == ("c", TEXTS["c"], 1, "own c", "x") and found[None] == (None, None, 2, None, None)


def test_repeats_by_the_order_of_string_ids(docs):
    found = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    assert found["a"].n_removed == 0 and found["b"].n_removed == 30 and found["b"].text == "one"
    assert found[None].n_words == 0 and len(found) == 6


@pytest.mark.parametrize("block_bytes", [1 << 20, 10])
def test_items_of_string_ids(spark, docs, block_bytes):
    items = spark.createDataFrame([("q2", PASSAGE), ("q1", PASSAGE), (None, TEXTS["d"])], "item_id string, text string")
    found = {r.doc_id: r for r in fmindex.contamination(docs, items, block_bytes=block_bytes).collect()}
    assert found["b"]["items"] == ["q1", "q2"] and found["b"]["a.b"] == 1 and found["b"].FP == "own b"
    assert found["e"]["items"] == [] and not found["e"].spans
    assert not found["d"]["items"] and [tuple(s) for s in found["d"].spans] == [(0, 9)]


def test_odd_names_are_carried(docs):
    for found in (secret_scan.find(docs, redact=True), pieces.encode(docs, queries.PIECES, decoded=True)):
        assert {"a.b", "FP", "t`k"} <= set(found.columns)
        assert {r["a.b"] for r in found.collect()} == {1, 2}


def test_a_column_in_another_case_is_replaced_or_carried(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, 8)], "doc_id long, text string, SPANS int, _own_spans int")
    assert secret_scan.find(docs).columns == ["doc_id", "_own_spans", "spans"]
    kept = simhash.keep_one(docs.withColumnsRenamed({"SPANS": "Fp", "_own_spans": "_own_Fp"}))
    assert kept.columns == ["doc_id", "text", "Fp", "_own_Fp"] and tuple(kept.first()) == (1, "a b c", 7, 8)


def test_pipeline_stages_keep_odd_columns(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(300)
    docs = docs.withColumn("a.b", F.lit(1)).withColumn("Spans", F.lit("s")).withColumn("_own_Spans", F.lit("t"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, data)
        assert left.columns == docs.columns
        assert {(r["a.b"], r["Spans"], r["_own_Spans"]) for r in left.collect()} == {(1, "s", "t")}
