"""License scans by a positional index of rare tokens.

The index posts every template, a short key phrase or a longer notice, under the few rarest of its mandatory
words: those of the highest inverse document frequency over all documents. Each word of a file that the index
knows gives, by its offset in the template, the place where the template would start; the postings of a template
are intersected by that place, and only places that all of them name are looked at further. There the
mandatory key phrases must stand word by word. The other words of a notice may be missing, if their weight is
low, or a few places off, as where a word was put in or left out. Mandatory words are in every match, so it
does not matter which of them are rare: no match is lost by the choice.

All steps are DataFrame functions. The words of a text are cut once; what the templates can use of them is
stored, and texts are not read again. A text is one row while its words are cut, whatever its length; a
candidate carries the words around it only. Null and empty texts have no words, no labels and score 0. Repeated
rows, and rows without an id, are scanned each by itself. Columns but doc_id and text are not returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import UPPER, lowered
from recflow.session import materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The share of a notice's weight that must be found, in per cent.
LEAST_SHARE = 60
# Places by which a word of a notice that is not mandatory may be off.
SLACK = 2
# Postings of a template.
POSTINGS = 3


@dataclass(frozen=True)
class Template:
    """A template without ``keys`` is a key phrase; ``keys`` are the phrases that a notice must have."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# The key phrases of the scan, and words of public license notices and identifiers.
BASE = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)
MORE = (
    Template("agpl", "gnu affero general public license"),
    Template("bsd", "bsd license"),
    Template("cc", "creative commons"),
    Template("isc", "isc license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mpl", "mozilla public license"),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        ("hereby granted free of charge",),
    ),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("source and binary forms",),
    ),
    Template(
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
        ("general public license",),
    ),
    Template("cc", "this work is licensed under a creative commons attribution", ("creative commons",)),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license",
        ("mozilla public license",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose",
        ("copy modify and or distribute",),
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("public domain",)),
    Template("boost", "boost software license"),
    Template("bsd", "bsd 2 clause license"),
    Template("bsd", "bsd 3 clause license"),
    Template("cc0", "cc0 1 0 universal"),
    Template("epl", "eclipse public license"),
    Template("wtfpl", "do what the fuck you want to public license"),
    Template("zlib", "zlib license"),
    Template(
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software",
        ("copies or substantial portions",),
    ),
    Template(
        "apache",
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("www apache org licenses license",),
    ),
    Template(
        "bsd",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
        ("binary form must reproduce",),
    ),
    Template(
        "boost",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license",
        ("person or organization obtaining a copy",),
    ),
    Template(
        "zlib",
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        ("must not be misrepresented",),
    ),
    Template(
        "epl",
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
        ("eclipse public license",),
    ),
    *(
        Template(label, f"spdx license identifier {label}")
        for label in ("agpl", "apache", "bsd", "cc0", "epl", "gpl", "isc", "lgpl", "mit", "mpl", "unlicense", "wtfpl", "zlib")
    ),
    Template("boost", "spdx license identifier bsl"),
    Template("cc", "spdx license identifier cc"),
)
TEMPLATES = BASE + MORE


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), SEPARATORS), "")


def weight(documents: int, having: int) -> int:
    """Inverse document frequency in thousandths, at least 1."""
    return int(1000 * log((1 + documents) / (1 + having)) + 0.5) + 1


def _key_offsets(template: Template) -> list[int]:
    """The offsets of the words that must be there."""
    words = template.text.split()
    if not template.keys:
        return list(range(len(words)))
    found: set[int] = set()
    for key in template.keys:
        own = key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
        found.update(range(at, at + len(own)))
    return sorted(found)


def _index(templates: Sequence[Template], weights: dict[str, int], docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, templates): the rarest mandatory words of each template with their offsets, and all it must match."""
    postings, bodies = [], []
    for n, t in enumerate(templates):
        words, needed = t.text.split(), _key_offsets(t)
        rare = sorted(needed, key=lambda i: (-weights[words[i]], i))[:POSTINGS]
        postings += [(n, words[i], i, i == rare[0], len(rare)) for i in rare]
        body = [(i, w, weights[w], 0 if i in needed else SLACK) for i, w in enumerate(words)]
        bodies.append((n, t.label, t.base, bool(t.keys), body, needed))
    spark = docs.sparkSession
    schema = (
        "template int, label string, base boolean, notice boolean, "
        "body array<struct<offset:int,word:string,weight:bigint,slack:int>>, keys array<int>"
    )
    return (
        spark.createDataFrame(postings, "template int, word string, offset int, rarest boolean, postings int"),
        spark.createDataFrame(bodies, schema),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def scan(docs: DataFrame, templates: Iterable[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    ``score`` is the largest found share of a notice's weight, or 0.5 where only key phrases were found.
    """
    templates = tuple(templates)
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    longest = max(len(t.text.split()) for t in templates)

    cut = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    known = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))),
        lambda s: s["word"].isin(vocabulary),
    )
    stored = cut.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        known.alias("hits"),
        F.monotonically_increasing_id().alias("row"),
    )
    stored = materialize(stored, "license-words")

    having = stored.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").count()
    counted = {r["word"]: r["count"] for r in having.collect()}  # a row for each word of the templates
    documents = stored.count()
    weights = {w: weight(documents, counted.get(w, 0)) for w in vocabulary}

    postings, bodies = _index(templates, weights, docs)
    posted = sorted({r.word for r in postings.select("word").collect()})
    # the words around a place are among as many hits on either side as a template has words, or is off
    reach = longest + SLACK
    around = F.slice("hits", F.greatest(F.col("at") + 2 - reach, F.lit(1)), F.lit(2 * reach))
    looked = (
        stored.select("row", "hits", F.posexplode("hits").alias("at", "hit"))
        .where(F.col("hit.word").isin(posted))
        .select("row", F.col("hit.pos").alias("pos"), F.col("hit.word").alias("word"), around.alias("around"))
    )
    # a template and place that all its postings agree on; the words around come with the rarest one
    placed = (
        looked.join(F.broadcast(postings), "word")
        .groupBy("row", "template", (F.col("pos") - F.col("offset")).alias("start"))
        .agg(
            F.count("*").alias("agree"),
            F.first("postings").alias("postings"),
            F.first(F.when(F.col("rarest"), F.col("around")), ignorenulls=True).alias("around"),
        )
        .where(F.col("agree") == F.col("postings"))
        .join(F.broadcast(bodies), "template")
    )
    matched = F.filter(
        "body",
        lambda b: F.exists(
            "around",
            lambda h: (h["word"] == b["word"]) & (F.abs(h["pos"] - F.col("start") - b["offset"]) <= b["slack"]),
        ),
    )
    whole = _sum(F.transform("body", lambda b: b["weight"]))
    found = (
        placed.withColumn("matched", matched)
        .where(F.size(F.array_except("keys", "matched.offset")) == 0)
        .withColumn("part", _sum(F.col("matched.weight")))
        .withColumn("whole", whole)
        .where(~F.col("notice") | (100 * F.col("part") >= LEAST_SHARE * F.col("whole")))
    )
    score = F.when(F.col("notice"), F.col("part") / F.col("whole")).otherwise(F.lit(0.5))
    own = F.when(F.col("base"), F.col("start").cast("long"))
    per_row = found.groupBy("row").agg(
        F.count(own).alias("n_base"),
        F.min(own).alias("first_word"),
        F.max(own).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"),
        F.max(score).alias("score"),
    )
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit("")).alias(c)
    return stored.drop("hits").join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        joined("base_labels"),
        joined("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def duckdb_sql(templates: Iterable[Template] = TEMPLATES) -> str:
    """The same rows in DuckDB's SQL, from the table ``documents``."""
    values = []
    for n, t in enumerate(templates):
        for i, w in enumerate(t.text.split()):
            values.append(f"({n},'{t.label}',{t.base},{bool(t.keys)},{i},'{w}',{i in _key_offsets(t)})")
    return f"""
WITH body(template, label, base, notice, pos, word, needed) AS (VALUES {", ".join(values)}),
docs AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '{WORD}') AS words FROM documents),
hits AS (SELECT doc, pos - 1 AS pos, word FROM (SELECT doc, unnest(words) AS word, generate_subscripts(words, 1) AS pos
    FROM docs) WHERE word IN (SELECT word FROM body)),
weights AS (SELECT word, CAST(floor(1000 * ln((1 + (SELECT count(*) FROM docs)) / (1 + count(DISTINCT doc))) + 0.5)
    AS BIGINT) + 1 AS weight FROM (SELECT DISTINCT word FROM body) LEFT JOIN hits USING (word) GROUP BY word),
full_body AS (SELECT * FROM body JOIN weights USING (word)),
whole AS (SELECT template, sum(weight) AS whole, count(*) FILTER (WHERE needed) AS needed FROM full_body
    GROUP BY template),
starts AS (SELECT doc, template, h.pos - b.pos AS start FROM hits h JOIN full_body b USING (word) WHERE b.needed
    GROUP BY doc, template, start HAVING count(*) = (SELECT needed FROM whole w WHERE w.template = b.template)),
matched AS (SELECT DISTINCT doc, s.template, start, b.pos, weight
    FROM starts s JOIN full_body b ON b.template = s.template
    JOIN hits h USING (doc) WHERE h.word = b.word
    AND abs(h.pos - s.start - b.pos) <= CASE WHEN b.needed THEN 0 ELSE {SLACK} END),
found AS (SELECT doc, m.template, start, any_value(label) AS label, any_value(base) AS base,
    any_value(notice) AS notice, any_value(part) AS part, any_value(whole) AS whole
    FROM (SELECT doc, template, start, sum(weight) AS part FROM matched GROUP BY doc, template, start) m
    JOIN whole USING (template) JOIN body USING (template)
    GROUP BY doc, m.template, start
    HAVING NOT any_value(notice) OR 100 * any_value(part) >= {LEAST_SHARE} * any_value(whole)),
per_doc AS (SELECT doc, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
    max(start) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
    max(CASE WHEN notice THEN CAST(part AS DOUBLE) / CAST(whole AS DOUBLE) ELSE 0.5 END) AS score
    FROM found GROUP BY doc)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
    CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN per_doc USING (doc)
"""
