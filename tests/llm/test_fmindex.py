import hashlib
import random

import numpy as np

from recflow.llm import fmindex, queries


def slow_words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127 else " " for c in text).split(" ")


def cut(text):
    return [w for w in slow_words(text) if w]


def slow(docs, items, window=10):
    phrases = {}
    for item, text in items:
        ws = cut(text)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            phrases.setdefault(tuple(ws[i : i + window]), set()).add(item)
    sizes = {len(p) for p in phrases}
    out = []
    for doc, text in docs:
        ws, hit, found = cut(text), set(), set()
        for size in sizes:
            for i in range(len(ws) - size + 1):
                if own := phrases.get(tuple(ws[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= own
        joined = ",".join(sorted(map(str, found)))
        out.append((doc, len(ws), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return out


def test_query_equals_brute_force(spark, data):
    read = lambda name: [tuple(r) for r in spark.read.parquet(f"{data}/{name}.parquet").collect()]
    docs = [(r[0], r[1]) for r in read("documents")]
    got = sorted(tuple(r) for r in queries.op10_decontaminate(spark, data).collect())
    assert got == sorted(slow(docs, read("benchmark")))
    assert any(r[-1] for r in got)


def random_case(seed):
    pick = random.Random(seed)
    vocabulary = ["a", "B", "cc", "é", "7", "d-d", "Ü"]
    text = lambda most: " ".join(pick.choice(vocabulary) for _ in range(pick.randint(0, most)))
    items = [(i, text(6)) for i in range(12)] + [(12, None), (13, ""), (14, "a a a a a a"), (15, "zz"), (3, "a b")]
    docs = [(i, text(60)) for i in range(40)] + [(40, None), (41, ""), (42, "a " * 200), (42, "a " * 200), (None, "zz")]
    return docs, items


def test_random_texts_in_one_and_many_blocks(spark):
    for seed in (1, 2):
        docs, items = random_case(seed)
        frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, items string, spans int")
        questions = spark.createDataFrame(items, "item_id long, text string")
        key = lambda r: (r[0] or -1, *r[1:])
        expected = sorted(slow(docs, items, 4), key=key)
        for block_bytes in (1 << 20, 20):
            found = fmindex.contamination(frame, questions, window=4, block_bytes=block_bytes)
            got = queries.contamination_digests(found).collect()
            assert sorted((tuple(r) for r in got), key=key) == expected


def test_index_counts_and_places():
    pick = np.random.default_rng(3)
    text = np.append(pick.integers(0, 4, 500), 0)
    index = fmindex.FMIndex(text, 5)
    phrases = np.array([[1, 2, 0], [3, 0, 0], [1, 1, 1], [2, 3, 1], [5, 1, 0]])
    sizes = np.array([2, 1, 3, 3, 2])
    low, high = index.search(phrases, sizes)
    for p, n, a, b in zip(phrases, sizes, low, high):
        expected = [i for i in range(len(text) - n) if (text[i : i + n] == p[:n]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def test_removal(spark):
    items = spark.createDataFrame([(1, "b c d"), (2, "d e")], "item_id long, text string")
    rows = [(1, "A, B c-d; e! f"), (2, None), (3, "x"), (4, "b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in fmindex.contamination(docs, items, remove=True).collect()}
    assert out == {1: "A, ! f", 2: None, 3: "x", 4: ""}


def test_items_without_an_id_count_as_hits_and_are_removed(spark):
    items = spark.createDataFrame([(None, "b c d"), (None, "x y"), (2, "d e")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d f"), (2, "q d e"), (3, "x y"), (4, "b c")], "doc_id long, text string")
    for block_bytes in (1 << 20, 3):
        found = fmindex.contamination(docs, items, block_bytes=block_bytes)
        got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in queries.contamination_digests(found).collect()}
        assert got == {1: (3, 0, True), 2: (2, 1, True), 3: (2, 0, True), 4: (0, 0, False)}
        left = fmindex.contamination(docs, items, block_bytes=block_bytes, remove=True)
        assert {r.doc_id: r.text.split() for r in left.collect()} == {1: ["a", "f"], 2: ["q"], 3: [], 4: ["b", "c"]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.n_hit for r in queries.contamination_digests(fmindex.contamination(docs, none)).collect()] == [0]
    assert fmindex.contamination(docs.where("doc_id > 5"), none).collect() == []
