import re

import duckdb
import pytest

from recflow.llm import licenses, queries


def sql_rows(docs):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    return con.execute(queries.ORACLES["op1_licenses"]).fetchall()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def slow_base(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) if w]
    found = []
    for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")):
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return (
        len(words),
        len(found),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({x for _, x in found})),
    )


NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
HARD = [
    (1, None),
    (2, ""),
    (3, "MIT License"),
    (4, "the mit\nlicense mit mit license. MIT-License!"),
    (5, "Released under the MIT License. Licensed under the Apache License, Version 2.0"),
    (6, NOTICE),
    (7, NOTICE.replace("person", "user").replace("copy", "clone")),
    (8, NOTICE.replace("charge", "cost")),
    (9, "GNU Lesser General Public License; gnu general  public license"),
    (10, "ümit license mit licensé GENERAL PUBLIC"),
    (11, "license " * 500 + "mit license " * 300),
    (12, "x " * 30000 + "apache license"),
    (13, "general public license"),
    (14, "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    (15, "mit license"),
]


def test_hard_texts_equal_sql_and_brute_force(spark):
    docs = spark.createDataFrame([(*d, "a", 1) for d in HARD], "doc_id long, text string, labels string, row int")
    got = licenses.scan(docs.repartition(3)).collect()
    assert ordered(got) == ordered(sql_rows(HARD))
    base = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got}
    assert base == {d: slow_base(t) for d, t in HARD}
    labels = {r.doc_id: r.labels for r in got}
    assert labels[6] == labels[7] == "mit" and labels[8] == "" and labels[9] == "gpl,lgpl"
    score = {r.doc_id: r.score for r in got}
    assert score[1] == 0.0 and score[3] == 0.5 and score[6] == 1.0 and 0.6 <= score[7] < 1.0


def slow_labels(text, weights):
    """(label, start) of every template found by trying it at every place."""
    words = [w for w in re.split(licenses.SEPARATORS, (text or "").lower()) if w]
    found = set()
    for t in licenses.TEMPLATES:
        own, needed = t.text.split(), licenses._key_offsets(t)
        for start in range(-len(own), len(words)):
            if any(not 0 <= start + i < len(words) or words[start + i] != own[i] for i in needed):
                continue
            slack = [0 if i in needed else licenses.SLACK for i in range(len(own))]
            near = [words[max(0, start + i - k) : max(0, start + i + k + 1)] for i, k in enumerate(slack)]
            part = sum(weights[w] for w, some in zip(own, near) if w in some)
            if not t.keys or 100 * part >= licenses.LEAST_SHARE * sum(weights[w] for w in own):
                found.add(t.label)
    return ",".join(sorted(found))


def weights_of(texts):
    cut = [set(re.split(licenses.SEPARATORS, (t or "").lower())) for t in texts]
    words = {w for t in licenses.TEMPLATES for w in t.text.split()}
    return {w: licenses.weight(len(cut), sum(w in c for c in cut)) for w in words}


def check_labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights = weights_of(texts)
    got = licenses.scan(docs.repartition(3)).collect()
    assert {r.doc_id: r.labels for r in got} == {i: slow_labels(t, weights) for i, t in enumerate(texts)}
    assert ordered(got) == ordered(sql_rows(list(enumerate(texts))))
    return {r.doc_id: r.labels.split(",") for r in got}


def test_a_notice_is_found_whichever_word_of_it_was_changed(spark):
    cases = []
    for t in licenses.TEMPLATES:
        words, needed = t.text.split(), licenses._key_offsets(t)
        cases += [(t.label, words[:i] + ["other"] + words[i + 1 :]) for i in range(len(words)) if i not in needed]
    assert len(cases) > 150
    # among other texts, as the words of a notice that all texts have would weigh next to nothing
    texts = [" ".join(["so", *words, "on"]) for _, words in cases] + ["plain text"] * 2000
    found = check_labels(spark, texts)
    assert [words for k, (label, words) in enumerate(cases) if label not in found[k]] == []


def test_words_put_in_or_left_out_and_places_that_agree_in_part(spark):
    long = licenses.TEMPLATES[-1].text
    notice = "you can redistribute it and or modify it under the terms of the gnu general public license".split()
    texts = [" ".join(notice[:i] + ["x"] + notice[i:]) for i in range(len(notice) + 1)]
    texts += [" ".join(notice[:i] + notice[i + 1 :]) for i in range(len(notice))]
    texts += ["license mit", "public general license", "general general public public license license", f"{long} {long}"]
    texts += ["SPDX-License-Identifier: MIT", "BSD 3-Clause License", "the the GNU General Public License", "CC0 1.0 Universal"]
    found = check_labels(spark, texts + ["plain text"] * 500)
    assert found[len(texts) - 4] == ["mit"] and found[len(texts) - 3] == ["bsd"] and found[len(texts) - 1] == ["cc0"]
    # one more word, before the last three
    assert all("gpl" in found[i] for i in range(len(notice) - 3))


def test_one_text_above_a_batch(spark):
    text = "some other words here " * 250_000 + "mit license " * 2_000
    assert len(text) > 5 << 20
    docs = spark.createDataFrame([(1, text), (2, "mit license")], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs).collect()}
    assert got[1] == (1_004_000, 2_000, 1_000_000, 1_003_998, "mit", "mit", 0.5)
    assert got[2] == (2, 1, 0, 0, "mit", "mit", 0.5)


def test_query_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:6] for r in queries.op1_licenses(spark, data).collect()}
    assert got == {r.doc_id: slow_base(r.text) for r in docs}


def test_no_python_in_the_plan(spark, data):
    plan = queries.op1_licenses(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_repeated_rows_missing_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "mit license")] * 2 + [(None, "mit license")], "doc_id long, text string")
    assert [r.n_base for r in licenses.scan(docs).collect()] == [1, 1, 1]
    assert licenses.scan(docs.where("doc_id = 9")).collect() == []


def test_weights_are_positive():
    assert licenses.weight(0, 0) == 1 and licenses.weight(10, 10) == 1
    assert licenses.weight(100, 1) > licenses.weight(100, 2)
    with pytest.raises(StopIteration):
        licenses._key_offsets(licenses.Template("x", "a b", ("c",)))
