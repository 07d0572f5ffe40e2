import random

import numpy as np
import pytest

from recflow.llm import jaccard, queries


def slow_set(text, words=5):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    found = [w for w in text.split(" ") if w]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def slow_clusters(docs, words=5, percent=80):
    """doc_id -> (set size, smallest doc_id reachable); all pairs of distinct sets that share a shingle."""
    sets = {d: slow_set(t, words) for d, t in docs}
    classes = {}
    for d in sorted(sets, key=lambda d: (d is None, d or 0)):
        if sets[d]:
            classes.setdefault(sets[d], []).append(d)
    holders, parent = {}, {s: s for s in classes}

    def top(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for a in classes:
        for b in {b for g in a for b in holders.get(g, ())}:
            if 100 * len(a & b) >= percent * len(a | b):
                parent[top(a)] = top(b)
        for g in a:
            holders.setdefault(g, []).append(a)
    least = {}
    for s, ids in classes.items():
        for d in ids:
            if d is not None:
                least[top(s)] = min(d, least.get(top(s), d))
    return {d: (len(s), least.get(top(s)) if s else d) for d, s in sets.items()}


def as_dict(df):
    rows = df.collect()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    expected = slow_clusters(docs)
    assert any(d != c for d, (_, c) in expected.items())
    assert as_dict(queries.op11_ngram_jaccard(spark, data)) == expected


def variants(seed, count):
    """Copies of a few texts with some words changed, on both sides of the limit, and shared passages."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(4))
    passages = [[word() for _ in range(60)] for _ in range(3)]
    bases = [[word() for _ in range(pick.randint(1, 90))] for _ in range(6)]
    bases += [pick.choice(passages) + [word() for _ in range(k)] for k in (2, 8, 15, 40)]
    docs = []
    for i in range(count):
        words = list(pick.choice(bases))
        for _ in range(pick.randint(0, 1 + len(words) // 30)):
            at = pick.randrange(len(words))
            words[at : at + pick.randint(0, 2)] = [word() for _ in range(pick.randint(0, 2))]
        if pick.random() < 0.2:
            words = pick.choice(passages) + words
        docs.append((i, pick.choice([" ", "\n", "  "]).join(words)))
    return docs


@pytest.mark.parametrize("seed, often, percent", [(1, 32, 80), (2, 2, 80), (5, 3, 60)])
def test_copies_and_passages(spark, seed, often, percent):
    docs = variants(seed, 260)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    expected = slow_clusters(docs, percent=percent)
    assert 3 < len({c for _, c in expected.values()}) < 200
    assert as_dict(jaccard.clusters(frame, percent=percent, often=often)) == expected


def test_texts_looked_up_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LOOKED_UP", 0)
    monkeypatch.setattr(jaccard, "FREQUENT", 5)
    docs = variants(9, 80)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert as_dict(jaccard.clusters(frame, often=3)) == slow_clusters(docs)


def test_stars_are_few(spark):
    """A group of near copies gives some pairs a member and shingle list, not all pairs."""
    base = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(600):
        words = list(base)
        words[(i * 7) % 400] = f"x{i}"
        docs.append((i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    join = jaccard.Join(frame, 5, 80, 32)
    assert join.stars().distinct().count() < 600 * 40
    now = join.roots()
    assert now.select("root").distinct().count() == 1
    assert join.rest(now).count() == 0


def test_prefixes_meet():
    pick = np.random.default_rng(1)
    values = pick.integers(0, 1 << 63, 120).astype(np.uint64)
    for _ in range(300):
        frequent = jaccard.Frequent([values[:20], values[20:30]], [np.arange(20), np.arange(10)])
        a = np.unique(pick.choice(values, pick.integers(1, 60), replace=False))
        b = np.unique(np.r_[a[pick.random(len(a)) < 0.95], pick.choice(values, 2)])
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert set(jaccard.prefix(a, frequent, 80)[0].tolist()) & set(jaccard.prefix(b, frequent, 80)[0].tolist())


def test_nulls_short_long_repeats_other_columns_and_empty_table(spark):
    schema = "doc_id long, text string, class string, grp int, `a.b` int"
    long = " ".join(f"t{i % 50_000}" for i in range(900_000))
    texts = [(5, None), (4, ""), (3, " \n"), (9, "one"), (8, "ONE"), (7, "one two"), (6, long), (2, long + " end"), (None, "q r s t u"), (None, "q r s t u"), (11, "À b c d e"), (12, "à b c d e")]
    frame = spark.createDataFrame([(*t, "c", 1, 2) for t in texts + [(9, "one")]], schema)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.clusters(frame).collect())
    assert got == [(0, 1, None), (0, 1, None), (2, 50_001, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 50_000, 2), (7, 1, 7), (8, 1, 8), (9, 1, 8), (9, 1, 8), (11, 1, 11), (12, 1, 12)]
    assert jaccard.clusters(spark.createDataFrame([], schema)).collect() == []
    named = spark.createDataFrame([("b", "1 2 3 4 5"), ("a", "1 2 3 4 5")], "doc_id string, text string")
    assert {r.component_id for r in jaccard.clusters(named).collect()} == {"a"}
