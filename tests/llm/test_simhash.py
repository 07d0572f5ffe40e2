import random

import xxhash

from recflow.llm import queries, simhash
from recflow.llm.components import components


def slow_fingerprint(text, words=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    found = [w for w in text.split(" ") if w]
    if not found:
        return 0
    grams = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, radius=2):
    """doc -> smallest doc reachable, by union of all pairs of distinct fingerprints."""
    first = {}
    for d in sorted(prints):
        first.setdefault(prints[d], d)
    parent = {f: f for f in first}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    values = list(first)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[top(a)] = top(b)
    least = {}
    for f, d in first.items():
        least[top(f)] = min(d, least.get(top(f), d))
    return {d: least[top(f)] for d, f in prints.items()}


def test_query_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: slow_fingerprint(r.text) for r in docs}
    groups = slow_groups(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, data).collect()}
    assert got == {d: (f"{f:016x}", groups[d]) for d, f in prints.items()}


def test_short_empty_and_odd_texts():
    for text in ["", " \n", "one", "one Two", "ÀÉ x y z", "a b c", "x " * 700_000, "é b c d"]:
        assert simhash.fingerprint(text.encode(), 3) & (1 << 64) - 1 == slow_fingerprint(text)


def test_masks_cover_every_pair_of_bits():
    masks = simhash.masks(2)
    for a in range(64):
        for b in range(64):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_of_crowded_buckets(spark):
    pick = random.Random(5)
    base = pick.getrandbits(64)
    values = {base}
    while len(values) < 400:  # a crowd around one value, chains of single bits, and others
        near = pick.choice(list(values)) if pick.random() < 0.3 else base
        for _ in range(pick.randint(1, 5)):
            near ^= 1 << pick.randrange(64)
        values.add(near)
    values |= {pick.getrandbits(64) for _ in range(50)}
    expected = slow_groups(dict(enumerate(values)))
    number = {signed(v): i for i, v in enumerate(values)}
    frame = spark.createDataFrame([(v,) for v in number], "fp long")
    edges = simhash.links(frame, 2)
    assert all(((r.u ^ r.v) & (1 << 64) - 1).bit_count() <= 2 for r in edges.collect())
    root = {r.node: r.root for r in components(edges).collect()}
    groups = {}
    for v, i in number.items():
        groups.setdefault(root.get(v, v), []).append(i)
    assert {i: min(g) for g in groups.values() for i in g} == expected


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    hub = [(7, i) for i in range(1000, 1400)]
    frame = spark.createDataFrame(chain + hub + [(5, 5), (1400, 7), (1400, 7)], "u long, v long")
    rows = components(frame).collect()
    got = {r.node: r.root for r in rows}
    assert len(rows) == len(got)
    assert got == {i: 100 for i in range(100, 181)} | {i: 7 for i in [7, *range(1000, 1401)]}


def test_nulls_repeats_and_empty_table(spark):
    schema = "doc_id long, text string, fp string, component_id int"
    rows = [(4, None, "x", 1), (2, "", None, 2), (None, " ", None, None), (3, "a b c", "", 0), (3, "a b c", "", 0)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 2), (2, 2), (3, 3), (3, 3), (4, 2)]
    alone = spark.createDataFrame([(None, "q r s t")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(alone).collect()] == [None]
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).collect() == []
