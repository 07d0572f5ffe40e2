import hashlib
import random

import numpy as np

from recflow.llm import queries, repeats


def slow(docs, window=20):
    """docs: (doc_id, text) in any order; rows of equal id share their place."""
    cut = [((t or "").encode().split(), d) for d, t in docs]
    least = {}
    for words, d in cut:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            least[key] = min(d, least.get(key, d))
    out = []
    for words, d in cut:
        gone, seen = set(), set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if least[key] != d or key in seen:
                gone |= set(range(i, i + window))
            seen.add(key)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def digests(rows):
    return sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in rows)


def test_query_equals_brute_force(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op8_substring_dedup(spark, data).collect())
    assert got == slow(docs)
    assert any(r[2] for r in got)


def random_docs(seed):
    pick = random.Random(seed)
    passage = [pick.choice("abcdefgh") * pick.randint(1, 3) for _ in range(40)]
    docs = []
    for i in range(60):
        words = [pick.choice("xyzé") * pick.randint(1, 9) for _ in range(pick.randint(0, 30))]
        for _ in range(pick.randint(0, 2)):
            a = pick.randint(0, 30)
            words += passage[a : a + pick.randint(1, 15)]
        docs.append((i, pick.choice([" ", "\n", "\t "]).join(words)))
    return docs + [(60, None), (61, ""), (62, "q " * 300), (62, "q " * 300), (5, docs[9][1]), (63, docs[3][1])]


def test_small_windows_and_any_sketch_size(spark):
    for window, most in ((4, 1 << 29), (5, 1 << 16), (1, 1 << 16), (7, 8)):
        docs = random_docs(window)
        rows = [(d, t, 1, "x") for d, t in docs]
        frame = spark.createDataFrame(rows, "doc_id long, text string, place int, first string").repartition(5)
        assert digests(repeats.remove_repeats(frame, window, most).collect()) == slow(docs, window)


def test_sketch_never_undercounts():
    cut = [t.encode().split() for _, t in random_docs(3) if t]
    for bits in (16, 22):
        rows = list(repeats._sketch_rows([[c] for c in repeats.Windows(cut, 4).cells(bits)]))
        seen = [set(), set()]
        for line, part, planes, _ in rows:
            seen[line] |= {(part << repeats.SLICE_BITS) + int(c) for c in repeats._cells_of(planes)}
        assert [set(c.tolist()) for c in repeats.Windows(cut, 4).cells(bits)] == seen


def test_hashes_are_polynomials_of_any_width():
    words = [[bytes([c]) for c in b"abcabcabcd"]]
    for window in range(1, 11):
        found = repeats.Windows(words, window)
        texts = [b"".join(words[0][i : i + window]) for i in range(11 - window)]
        same = [[a == b for a in texts] for b in texts]
        assert (np.equal.outer(found.first, found.first) == same).all()
        assert (np.equal.outer(found.second, found.second) == same).all()
    assert len(repeats.Windows(words, 11).first) == 0


def test_missing_ids_come_last_and_empty_table(spark):
    text = " ".join(map(str, range(25)))
    docs = spark.createDataFrame([(None, text), (None, text), (7, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in repeats.remove_repeats(docs).collect())
    assert got == [(0, 25), (0, 25), (7, 0)]
    assert repeats.remove_repeats(docs.where("doc_id = 1")).collect() == []


def test_sketch_rows_hold_a_slice_at_a_time_and_let_go_what_was_gathered(spark, monkeypatch):
    pick = np.random.default_rng(2)
    cells = pick.integers(0, 3 << repeats.SLICE_BITS, 5000).astype(np.uint32)
    cells[100:200] = cells[:100]
    gathered = [[cells[:3000].copy(), cells[3000:].copy()], [np.zeros(0, np.uint32)]]
    rows = list(repeats._sketch_rows(gathered))
    assert gathered == [[], []]
    values, counts = np.unique(cells, return_counts=True)
    assert [(line, part) for line, part, _, _ in rows] == [(0, 0), (0, 1), (0, 2)]
    found = np.concatenate([repeats._cells_of(planes) + (part << repeats.SLICE_BITS) for _, part, planes, _ in rows])
    assert found.tolist() == values.tolist()
    twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(p) // 3) for _, _, p, t in rows]
    assert np.concatenate(twice).tolist() == (counts > 1).astype(int).tolist()
    # batches of one slice each give the same sketch
    docs = spark.createDataFrame([(" ".join(f"w{(i * j) % 40}" for j in range(60)),) for i in range(30)], "text string")
    whole = repeats.sketch(docs, 5, 22)
    monkeypatch.setattr(repeats, "SENT_BYTES", 1)
    assert sorted(repeats.sketch(docs, 5, 22)) == sorted(whole)
