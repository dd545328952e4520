"""License scan: fixed phrases plus an exact containment join against templates.

A text block is any stretch of consecutive words, over line ends and comment
leaders alike, as long as the template and what may stand between its words
(``len / threshold`` words). A template is found when a block holds at least
``threshold`` of its different words, its distinguishing words among them. The
join is exact: template words get a global order by document frequency (rarest
first, counted over all documents); a block that reaches the threshold must
hold one of the first ``|T| - need + 1`` words (prefix filter), its document at
least ``need`` template words and the distinguishing ones (length filter), and a
block that opens with a template word must have enough of them from there on
(positional filter); what is left is verified word by word. Texts are split into
words once; only documents that pass the length filter hand their words on, and
nothing is shuffled but counts. All in the JVM.

Defined cases: null text has no words, no places and score 0; repeated rows get
equal results; an empty table gives an empty result; a text of any length is
searched whole; extra columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, cut, let, prefixed, read, text_of

# Phrases with their labels.
PHRASES = [("cc-by", ["cc", "by"]), ("gpl", ["general", "public", "license"]), ("reserved", ["all", "rights", "reserved"])]
# Templates (label, distinguishing words, text of a public license or notice in lower-case words).
TEMPLATES = [
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "licensed under the mit license"),
    ("mit", "permission granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    (
        "mit", "sublicense noninfringement",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without "
        "restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
        "software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract "
        "tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "isc", "granted fee",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ),
    ("apache", "apache license", "released under the apache license"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("apache", "compliance license", "you may not use this file except in compliance with the license"),
    (
        "apache", "apache license",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without "
        "warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    ("bsd", "bsd license", "released under the bsd license"),
    ("bsd", "redistribution binary", "redistribution and use in source and binary forms with or without modification are permitted"),
    (
        "bsd", "redistributions binary",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must "
        "retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and "
        "contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    ),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    (
        "gpl", "gnu general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied "
        "warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details",
    ),
    ("lgpl", "lesser license", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "affero license", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("unlicense", "unencumbered domain", "this is free and unencumbered software released into the public domain"),
    ("zlib", "altered misrepresented", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("cc0", "cc0", "released under cc0 1 0 universal"),
    ("cc-by", "creative commons attribution", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc sa", "licensed under cc by sa 4 0"),
    ("reserved", "all rights reserved", "all rights reserved"),
]
THRESHOLD = 0.8
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def words(c: Column) -> Column:
    return F.array_remove(F.split(c, SEPARATOR + "+", -1), "")


def _literal(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def places(w: Column) -> Column:
    """``array<struct<word, label>>`` of all places of the phrases, given the words of a text."""

    def here(i: Column, phrase: list[str]) -> Column:
        hit = F.get(w, i) == phrase[0]
        for k, x in enumerate(phrase[1:], 1):
            hit = hit & F.coalesce(F.get(w, i + k) == x, F.lit(False))
        return hit

    def of(label: str, phrase: list[str]) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: here(i, phrase))
        return F.transform(starts, lambda i: F.struct(i.cast("long").alias("word"), F.lit(label).alias("label")))

    return F.concat(*[of(*p) for p in PHRASES])


class Template:
    """A template as a set of words: how many a block needs, which it must hold, and how long it may be."""

    def __init__(self, label: str, marks: str, text: str, threshold: float):
        listed = text.split()
        self.label, self.marks, self.tokens = label, sorted(set(marks.split())), sorted(set(listed))
        self.need = max(1, ceil(threshold * len(self.tokens) - 1e-9))
        self.span = ceil(len(listed) / threshold - 1e-9) if threshold > 0 else len(listed)

    def prefix(self, rank: dict[str, int]) -> list[str]:
        return sorted(self.tokens, key=rank.get)[: len(self.tokens) - self.need + 1]


def _may_hold(held: Column, t: Template) -> Column:
    """Length filter: enough template words in the whole text, the distinguishing ones among them."""
    marks = F.lit(True)
    for m in t.marks:
        marks = marks & F.array_contains(held, m)
    return marks & (F.size(F.array_intersect(held, _literal(t.tokens))) >= t.need)


def _score(w: Column, held: Column, t: Template, rank: dict[str, int]) -> Column:
    """The largest share of the template in a block that reaches its threshold, or null."""
    tokens, marks = _literal(t.tokens), [t.tokens.index(m) + 1 for m in t.marks]
    hits = F.filter(F.transform(w, lambda x, i: F.struct(i.alias("i"), F.array_position(tokens, x).cast("int").alias("k"))), lambda p: p["k"] > 0)

    def opened(h: Column) -> Column:
        def block(p: Column, at: Column) -> Column:
            after = F.slice(h, at + 1, F.lit(t.span))  # a block has no more words than that
            inside = F.filter(after, lambda q: q["i"] < p["i"] + t.span)
            distinct = F.array_distinct(F.transform(inside, lambda q: q["k"]))
            whole = lambda d: F.size(F.array_intersect(d, _literal(marks))) == len(marks)
            return F.when(F.size(after) >= t.need, let(distinct, lambda d: F.when((F.size(d) >= t.need) & whole(d), F.size(d))))

        return F.array_max(F.transform(h, block))

    rare = F.arrays_overlap(held, _literal(t.prefix(rank)))  # prefix filter
    return F.when(rare & _may_hold(held, t), let(hits, opened) / float(len(t.tokens)))


def token_order(held: DataFrame, vocabulary: list[str]) -> list[str]:
    """Template words, rarest first: document frequencies over all documents, ties by the word."""
    n = {r["w"]: r["count"] for r in held.select(F.explode("held").alias("w")).groupBy("w").count().collect()}  # at most one row a template word
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def license_scan(docs: DataFrame, threshold: float = THRESHOLD, templates=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, base, found``: phrase places, and found labels, each with its best template's score, as ``array<struct<label, score>>``."""
    listed = [Template(*t, threshold) for t in (TEMPLATES if templates is None else templates)]
    vocabulary = sorted({w for t in listed for w in t.tokens})
    rows = prefixed(docs, doc_id=F.col(id_col), text=text_of(text_col))
    rows = rows.select("doc_id", words(ascii_lower(F.col("text"))).alias("w"))
    rows = rows.select("doc_id", "w", F.array_intersect(_literal(vocabulary) if vocabulary else F.array().cast("array<string>"), F.col("w")).alias("held"))
    phrase = F.lit(False)
    for _, p in PHRASES:
        phrase = phrase | (F.size(F.array_intersect("held", _literal(p))) == len(set(p))) if set(p) <= set(vocabulary) else F.lit(True)
    candidate = F.lit(False)
    for t in listed:
        candidate = candidate | _may_hold(F.col("held"), t)
    none = F.array().cast("array<struct<word:bigint,label:string>>")
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), F.when(phrase & (F.size("w") > 0), places(F.col("w"))).otherwise(none).alias("base"), "held", F.when(candidate, F.col("w")).alias("w"))
    rows = cut(rows, "words")
    rank = {w: i for i, w in enumerate(token_order(rows, vocabulary))}
    scores = {label: [_score(F.col("w"), F.col("held"), t, rank) for t in listed if t.label == label] for label in sorted({t.label for t in listed})}
    best = [F.struct(F.lit(label).alias("label"), (F.greatest(*s) if len(s) > 1 else s[0]).alias("score")) for label, s in scores.items()]
    nothing = F.array().cast("array<struct<label:string,score:double>>")
    found = F.when(F.col("w").isNotNull(), F.filter(F.array(*best), lambda f: f["score"].isNotNull())).otherwise(nothing) if best else nothing
    return rows.select("doc_id", "n_words", "base", found.alias("found"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan(read(spark, sf_dir))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    labels, starts = F.transform("base", lambda b: b["label"]), F.transform("base", lambda b: b["word"])
    score = F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)))
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(labels).alias("base_labels"), joined(F.concat(labels, F.transform("found", lambda f: f["label"]))).alias("labels"), score.alias("score"),
    )


_SQL = [(i, t.label, t.tokens, t.marks, t.need, t.span) for i, t in enumerate(Template(*t, THRESHOLD) for t in TEMPLATES)]
_SQL_TEMPLATES = ", ".join(f"({i}, '{label}', {tokens!r}::VARCHAR[], {marks!r}::VARCHAR[], {need}, {span})" for i, label, tokens, marks, need, span in _SQL)
ORACLE_SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (
  SELECT doc_id, i - 1 AS word, CASE WHEN w[i] = 'cc' AND w[i + 1] = 'by' THEN 'cc-by'
    WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl'
    WHEN w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved' THEN 'reserved' END AS label
  FROM w, unnest(range(1, len(w) + 1)) AS u(i)
), b AS (
  SELECT doc_id, count(*) AS n, min(word) AS lo, max(word) AS hi FROM p WHERE label IS NOT NULL GROUP BY doc_id
), t(t, label, tokens, marks, need, span) AS (VALUES {_SQL_TEMPLATES}
), v AS (SELECT t, label, need, span, len(tokens) AS n_tokens, len(marks) AS n_marks, list_contains(marks, token) AS mark, token FROM (SELECT *, unnest(tokens) AS token FROM t)
), hit AS (
  SELECT doc_id, t, label, need, span, n_tokens, n_marks, i, token, mark FROM (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS i FROM w) JOIN v USING (token)
), enough AS (
  SELECT doc_id, t FROM hit GROUP BY doc_id, t HAVING count(DISTINCT token) >= any_value(need) AND count(DISTINCT token) FILTER (WHERE mark) = any_value(n_marks)
), block AS (
  SELECT a.doc_id, a.t, a.label, a.need, a.n_tokens, a.n_marks, a.i, count(DISTINCT b.token) AS n, count(DISTINCT b.token) FILTER (WHERE b.mark) AS marks
  FROM hit a JOIN enough USING (doc_id, t) JOIN hit b ON a.doc_id = b.doc_id AND a.t = b.t AND b.i >= a.i AND b.i < a.i + a.span GROUP BY ALL
), g AS (
  SELECT doc_id, label, max(n / n_tokens) AS score FROM block WHERE n >= need AND marks = n_marks GROUP BY doc_id, label
), l AS (
  SELECT doc_id, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label, true AS base FROM p WHERE label IS NOT NULL UNION ALL SELECT doc_id, label, false FROM g) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  greatest(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END, coalesce((SELECT max(score) FROM g WHERE g.doc_id = w.doc_id), 0.0))::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""
