import random
import re
import zlib
from collections import Counter

import pytest

from recflow.llm import queries, spelling

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def slow_words(docs, least_length=6, least_count=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def edits(word, letters):
    """All words one deletion, replacement or insertion away."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cuts if b}
    for c in letters:
        out |= {a + c + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts}
    return out - {word}


def slow_variants(words):
    letters = sorted(set("".join(words)))
    forms, out = {}, {}
    near = {w: [x for x in edits(w, letters) if x in words] for w in words}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            forms[w] = best
    for w in words:
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (forms.get(w), root, words[w], len(near[w]), words[forms[w]] if w in forms else None)
    return out


def as_dict(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark, data):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    expected = slow_variants(slow_words(docs))
    assert sum(v[0] is not None for v in expected.values()) > 5
    assert as_dict(queries.op12_spelling(spark, data)) == expected


@pytest.mark.parametrize("block", [1, 3, 256])
def test_crowded_tiles(spark, block):
    """Many words of one beginning and end, chains of forms, equal counts, non-ASCII letters."""
    pick = random.Random(block)
    words = Counter()
    while len(words) < 150:
        middle = "".join(pick.choice("abé") for _ in range(pick.randint(0, 5)))
        words["xyz" + middle + "zyx"] = pick.choice([5, 5, 6, 30, 160, 900])
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = slow_variants(words)
    got = {r.word: (r.n_near, r.form_n, r.form) for r in spelling.nearest(frame, block).collect()}
    assert {w: g[0] for w, g in got.items()} == {w: v[3] for w, v in expected.items() if v[3]}
    letters = sorted(set("".join(words)))
    for word, (_, n, form) in got.items():
        assert (-n, form) == min((-words[x], x) for x in edits(word, letters) if x in words)


def test_near_pairs():
    words = ["aaaaaa", "aaaaaaa", "aaaaab", "baaaaa", "aabaaa", "abcdef", "abcdeg", "bcdefa", "aaaaaaaa", "abcef", "abcdef"]
    i, j, _, _ = spelling.near(words, words)
    letters = "abcdefg"
    expected = {(a, b) for a, x in enumerate(words) for b, y in enumerate(words) if y in edits(x, letters)}
    assert set(zip(i.tolist(), j.tolist())) == expected and len(i) == len(expected)


def test_roots_of_long_chains(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()
    assert {r.word: r.root for r in got} == {w: "w040" for w, _ in chain}


def test_nulls_case_long_words_repeats_and_empty_table(spark):
    long = "ab" * 30_000
    docs = [(None, None), (None, "Wonder " * 30), (1, ""), (1, "wonder ÀÉÎõüß\n" * 9), (2, "wondur wondur wondur wondur wondur"),
            (2, "wondur,wonder'Wonders"), (3, f"{long} " * 6), (4, f"{long[1:]} " * 40), (5, "short words 123456 _______"), (6, "x " * 3_000_000 + "wonder")]
    schema = "doc_id long, text string, word string, n int"
    frame = spark.createDataFrame([(*d, "w", 1) for d in docs + docs[1:2]], schema)
    words = slow_words(docs + docs[1:2])
    got = as_dict(spelling.variants(frame))
    assert got[long] == (long[1:], long[1:], 6, 1, 40)
    short = {w: n for w, n in words.items() if len(w) < 100}
    assert {w: g for w, g in got.items() if len(w) < 100} == slow_variants(short)
    assert spelling.variants(spark.createDataFrame([], schema)).collect() == []
