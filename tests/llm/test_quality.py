import re
import zlib

import numpy as np

from recflow.llm import boosted, quadratic, queries, stats


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    again = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(5)}
    n, repeated = len(words), len(again)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        repeated,
        n < 10 or 100 * repeated > 20 * n,
    )


HARD = [None, "", " \n\t", "a", "a b c d e " * 3, "x\nx\n \nx \r\n", "é ü # $%&", "a " * 5000, "1 2 3 4 5 1 2 3 4 6 2 3 4 5 1"]


def test_rules_base_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op6_quality_rules(spark, data).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == {r.doc_id: slow_counts(r.text) for r in docs}
    assert not any(r.kept and r.base_failed for r in rows)


def test_counts_of_hard_texts():
    found = stats.counts([(t or "").encode() for t in HARD])
    for row, text in zip(found, HARD):
        assert tuple(row[:5]) == slow_counts(text)[:5]
    assert stats.counts([]).shape == (0, len(stats.COUNTS))


def labelled(spark, data):
    return {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").where("quality is not null").collect()}


def test_rules_separate_good_from_bad(spark, data):
    quality = labelled(spark, data)
    rows = [r for r in queries.op6_quality_rules(spark, data).collect() if r.doc_id in quality]
    good = [r.kept for r in rows if quality[r.doc_id] == 1 and not r.base_failed]
    bad = [r.kept for r in rows if quality[r.doc_id] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


def area(scores, labels):
    """The share of pairs of a good and a bad document in the right order."""
    good, bad = np.array(scores)[np.array(labels) == 1], np.array(scores)[np.array(labels) == 0]
    return np.mean(good[:, None] > bad) + np.mean(good[:, None] == bad) / 2


def test_classifier_on_held_out_documents(spark, data):
    quality = labelled(spark, data.replace("sf0.001", "sf0.01"))
    rows = queries.op5_quality_classifier(spark, data.replace("sf0.001", "sf0.01")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    assert area([r.score for r in held], [quality[r.doc_id] for r in held]) > 0.95


def test_held_out_labels_and_other_columns_do_not_matter(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    held = "crc32(cast(doc_id as string)) % 5 = 0"
    changed = labels.selectExpr("doc_id", f"if({held}, 1 - quality, quality) as quality")
    one = {r.doc_id: round(r.score, 9) for r in quadratic.classify(docs, labels).collect()}
    other = docs.selectExpr("doc_id", "text", "'x' as lang", "1 as score", "2 as x", "3 as n_words")
    two = {r.doc_id: round(r.score, 9) for r in quadratic.classify(other, changed).collect()}
    assert one == two


def frame(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(HARD)] + [(3, "a", "x", 1), (None, "b c", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, x string, score int")


def test_without_labels_nulls_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    bare = quadratic.classify(frame(spark), none).collect()
    assert len(bare) == len(HARD) + 2 and {r.score for r in bare} == {0.5}
    kept = boosted.judge(frame(spark), none).collect()
    assert len(kept) == len(HARD) + 2 and all(r.kept == (not r.base_failed) for r in kept)
    odd = spark.createDataFrame([(1, None), (1, 0), (1, 1), (None, 1), (2, 1), (4, 0)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quadratic.classify(frame(spark), odd).collect())
    assert boosted.judge(frame(spark), odd).count() == len(HARD) + 2
    assert quadratic.classify(frame(spark).where("doc_id > 99"), odd).collect() == []
    assert boosted.judge(frame(spark).where("doc_id > 99"), odd).collect() == []


def test_moments_give_the_direct_discriminant(spark):
    pick = np.random.default_rng(1)
    d = len(quadratic.features())
    x = np.concatenate([pick.normal(0, 1, (60, d)), pick.normal(1, 2, (90, d))])
    y = np.array([0] * 60 + [1] * 90)
    rows = [(int(a), b.tolist()) for a, b in zip(y, x)]
    model = quadratic.fit(spark.createDataFrame(rows, "label int, x array<double>").repartition(3))
    spread = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    pooled = 0.4 * spread[0] + 0.6 * spread[1]
    log = []
    for c, share in ((0, 0.4), (1, 0.6)):
        s = 0.9 * spread[c] + 0.1 * pooled + 1e-3 * np.eye(d)
        z = x - x[y == c].mean(axis=0)
        log.append(np.log(share) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (z @ np.linalg.inv(s) * z).sum(axis=1))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp((log[0] - log[1]) / quadratic.TEMPERATURE)))


def test_trees_are_monotonic_where_asked():
    pick = np.random.default_rng(2)
    d = len(boosted.FEATURES)
    x = pick.random((3000, d))
    # the labels rise with a feature whose effect must not rise
    y = (pick.random(3000) < 0.3 + 0.4 * (x[:, 3] > 0.5) * (x[:, 0] > 0.3) + 0.2 * (x[:, 9] < 0.4)).astype(float)
    trees = boosted.fit(x, y)
    probe = pick.random((200, d))
    for k, (_, sign) in enumerate(boosted.FEATURES):
        if sign:
            low, high = probe.copy(), probe.copy()
            low[:, k] = pick.random(200) * 0.5
            high[:, k] = low[:, k] + pick.random(200) * 0.5
            assert (sign * (trees.scores(high) - trees.scores(low)) >= -1e-12).all()
    right = trees.scores(x) > 0.5
    assert np.mean(right == y) > 0.55


def test_flattened_trees_score_like_the_grown_ones():
    pick = np.random.default_rng(4)
    x = pick.random((500, len(boosted.FEATURES)))
    grower = boosted._Grower(x, np.zeros(len(boosted.FEATURES)))
    feature, limit, value, out = grower.tree(pick.normal(size=500), np.full(500, 0.25))
    trees = boosted.Trees(feature[None], limit[None], value[None], 0.0)
    assert np.allclose(trees.scores(x), 1 / (1 + np.exp(-out)))
