import hashlib

import sentencepiece
from pyspark.sql import functions as F
from test_fmindex import cut
from test_simhash import slow_fingerprint, slow_groups

import corpus_pipeline
from recflow.llm import fmindex, queries, secret_scan, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def as_rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_equal_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = as_rows(docs)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        out[name] = as_rows(docs)
        if name != "encoding":
            assert docs.columns == COLUMNS

    kept = {r.doc_id for r in queries.op6_quality_rules(spark, data).collect() if r.kept}
    assert set(out["quality"]) == kept and len(kept) < len(before)
    assert all(out["quality"][d] == before[d] for d in kept)

    groups = slow_groups({d: slow_fingerprint(r.text) for d, r in out["quality"].items()})
    assert set(out["near_duplicates"]) == set(groups.values()) and len(set(groups.values())) < len(groups)

    phrases = set()
    for r in spark.read.parquet(f"{data}/benchmark.parquet").collect():
        ws = cut(r.text)
        phrases |= {tuple(ws[i : i + 10]) for i in range(max(1, len(ws) - 9))} if ws else set()
    changed = 0
    for d, r in out["near_duplicates"].items():
        ws, hit = cut(r.text), set()
        for n in {len(p) for p in phrases}:
            hit |= {i + j for i in range(len(ws) - n + 1) if tuple(ws[i : i + n]) in phrases for j in range(n)}
        left = out["decontamination"][d]
        assert cut(left.text) == [w for i, w in enumerate(ws) if i not in hit]
        assert left.n_chars == len(left.text) and (hit or left.text == r.text)
        changed += bool(hit)
    assert changed

    scanner = secret_scan.SecretScanner()
    for d, r in out["decontamination"].items():
        text = r.text.encode()
        assert out["secrets"][d].text == secret_scan.redacted(text, scanner.spans([text])[0]).decode()

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    assert set(out["encoding"]) == set(out["secrets"])
    for d, r in out["secrets"].items():
        ids = sp.encode(r.text)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert (out["encoding"][d].n_tokens, out["encoding"][d].ids_sha256) == (len(ids), digest)

    assert as_rows(corpus_pipeline.run(spark, data)) == out["encoding"]


def test_rows_without_ids_and_with_equal_ids(spark):
    same = "a b c d e f g h"
    rows = [(None, same, 1), (5, same, 2), (5, same, 3), (9, same, 4), (None, "other words in here", 5), (7, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    left = simhash.keep_one(docs).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, "other words in here"), (5, same), (7, "")]
    assert simhash.keep_one(docs.where("fp > 10")).collect() == []
    assert fmindex.merged([(3, 5), (0, 2), (2, 3)]) == [(0, 5)]


def test_empty_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < -1")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        assert docs.collect() == []


def test_columns_called_like_results_are_carried(spark, data):
    names = ("fp", "_row", "_place", "spans", "items", "n_words", "kept", "score", "ids")
    docs = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 60")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), "doc_id"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, data)
        assert docs.columns == columns
    found = docs.collect()
    assert found and all(r[n] == f"{n}{r.doc_id}" for r in found for n in names)
