"""License scans with a positional index of rare words, in built-in expressions alone.

The licence words of the templates are ranked by how many documents of the corpus hold them. For each file and
template, the file's rarest words of that template are looked up; every place of such a word names the places
where the template would start, and the starts of all of them are intersected by counting how many words agree
on one. A template is accepted where at least two words agree and its mandatory key phrases stand in the file.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # of words, once A-Z is lowered
RARE_WORDS = 6  # looked up for a file and template
AGREE = 2  # of them that must agree on the template's start

# Phrases of the base search and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """``text`` as it stands in files; all ``phrases`` are mandatory."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return words_of(self.text)


def words_of(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.translate(str.maketrans(UPPER, LOWER)))


# Wording of published licences and of the notices that name them.
TEMPLATES = [
    Template("agpl-3.0", "licensed under the GNU Affero General Public License version 3", ("affero general public license", "version 3")),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met", ("redistribution and use in source and binary forms", "conditions are met")),
    Template("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission",
             ("endorse or promote products derived from this software",)),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
             ("waived all copyright and related or neighboring rights",)),
    Template("epl-2.0", "made available under the terms of the Eclipse Public License 2.0", ("eclipse public license 2 0",)),
    Template("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
             "Software Foundation, either version 3 of the License, or (at your option) any later version",
             ("gnu general public license as published by the free software foundation", "either version 3 of the license")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify and", "for any purpose with or without fee is hereby granted")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             ("gnu lesser general public license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files, to deal in the Software without restriction",
             ("permission is hereby granted free of charge to any person", "in the software without restriction")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software released into the public domain",)),
]


def bare(text: Column) -> Column:
    """The words of a text with two spaces between them.

    ``lower`` also lowers letters beyond ASCII, which no phrase holds; the Kelvin sign, the one letter of which
    that would make an ASCII letter, is replaced by another letter first.
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.trim(F.regexp_replace(lowered, SEPARATORS, "  "))


def padded(bare_text: Column) -> Column:
    """Each word between two spaces of its own; empty without a word."""
    return F.when(bare_text == "", "").otherwise(F.concat(F.lit(" "), bare_text, F.lit(" ")))


def words_in(bare_text: Column) -> Column:
    """The words as an array; null without a word."""
    return F.when(bare_text != "", F.split(bare_text, "  "))


def pattern(phrase: str) -> str:
    """What :func:`padded` makes of a phrase: found there exactly where the words stand consecutively."""
    return " " + "  ".join(phrase.split()) + " "


def occurrences(text: Column, part: str) -> Column:
    """How often an ASCII string occurs: bytes that go when it goes."""
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def word_count(padded_text: Column) -> Column:
    """Every word brings two spaces."""
    return (occurrences(padded_text, " ") / 2).cast("long")


def licence_words(templates: list[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def by_rarity(words: DataFrame, templates: list[Template]) -> list[str]:
    """The licence words, those in fewest documents first, ties by the word; ``words`` has a column of that name."""
    every = licence_words(templates)
    held = F.array_intersect(F.array(*map(F.lit, every)), F.col("words"))
    df = {r.word: r.n for r in words.select(F.explode(held).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(every, key=lambda w: (df.get(w, 0), w))


def longest_run(values: Column) -> Column:
    """How often the most frequent value of an array occurs; 0 for an empty one."""
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(state: Column, value: Column) -> Column:
        run = F.when(state["last"].eqNullSafe(value), state["run"] + 1).otherwise(F.lit(1))
        return F.struct(value.alias("last"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    return F.aggregate(F.array_sort(values), start, step, lambda s: s["best"])


def agreement(template: Template, ranked: list[str]) -> Column:
    """``agree, of``: how many of the file's rarest words of the template agree on its start, of how many looked up.

    Needs the columns ``words`` (all words of the file in order) and ``held`` (its licence words).
    """
    at: dict[str, list[int]] = {}
    for i, w in enumerate(template.words):
        at.setdefault(w, []).append(i)
    own = [w for w in ranked if w in at]
    postings = F.create_map(*[x for w in own for x in (F.lit(w), F.array(*map(F.lit, at[w])))])
    rare = F.slice(F.array_intersect(F.array(*map(F.lit, own)), F.col("held")), 1, RARE_WORDS)
    numbered = F.filter(F.transform(F.col("words"), lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains(rare, x["w"]))
    starts = F.flatten(F.transform(numbered, lambda x: F.transform(
        F.element_at(postings, x["w"]), lambda p: F.struct(x["w"].alias("w"), (x["i"] - p).alias("start")))))
    return F.struct(longest_run(F.transform(F.array_distinct(starts), lambda s: s["start"])).alias("agree"), F.size(rare).alias("of"))


def scan(docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the smallest and largest word
    number at which one starts (null without one). ``labels`` adds those of the accepted templates; ``score`` is the
    largest share of a template's looked-up words that agree on its start, 0 if none is accepted. Labels are
    distinct, sorted and joined by commas, empty if there are none.

    Null and empty texts have no words. Every row is scanned whole by itself: repeated rows and null ids stay,
    other columns are left out, an empty table gives an empty result.
    """
    templates = TEMPLATES if templates is None else templates
    texts = docs.select(F.col(id_col).alias("_id"), bare(F.col(text_col)).alias("bare"))  # a step of its own: used more than once
    ranked = by_rarity(texts.select(words_in(F.col("bare")).alias("words")), templates)

    words = texts.select("_id", padded(F.col("bare")).alias("padded"), words_in(F.col("bare")).alias("words"))
    held = words.withColumn("held", F.array_intersect(F.array(*map(F.lit, ranked)), F.col("words")))

    def there(phrase: str) -> Column:
        return F.contains("padded", F.lit(pattern(phrase)))

    def aligned(t: Template) -> Column:
        """``agree, of`` where the file holds every word of the key phrases."""
        needed = sorted({w for p in t.phrases for w in p.split()})
        return F.when(F.size(F.array_intersect(F.array(*map(F.lit, needed)), F.col("held"))) == len(needed), agreement(t, ranked))

    def share(k: int, t: Template) -> Column:
        """Share of the agreeing words, null where the template is not accepted."""
        verified = F.col(f"t{k}.agree") >= AGREE
        for p in t.phrases:
            verified = verified & there(p)
        return F.when(verified, F.col(f"t{k}.agree") / F.col(f"t{k}.of"))

    found = held.select("_id", "padded", word_count(F.col("padded")).alias("n_words"), *[there(p).alias(f"b{k}") for k, p in enumerate(BASE_PHRASES)],
                        *[aligned(t).alias(f"t{k}") for k, t in enumerate(templates)])
    found = found.select("*", *[share(k, t).alias(f"s{k}") for k, t in enumerate(templates)])
    base = [(F.col(f"b{k}"), p, label) for k, (p, label) in enumerate(BASE_PHRASES.items())]
    n_base = [F.when(has, occurrences(F.col("padded"), pattern(p))).otherwise(0) for has, p, _ in base]
    first = [F.when(has, word_count(F.substring_index("padded", pattern(p), 1))) for has, p, _ in base]
    last = [F.when(has, F.col("n_words") - len(p.split()) - word_count(F.substring_index("padded", pattern(p), -1))) for has, p, _ in base]
    base_labels = [F.when(has, F.lit(label)) for has, _, label in base]
    shares = [F.col(f"s{k}") for k in range(len(templates))]
    labels = [F.when(s.isNotNull(), F.lit(t.label)) for t, s in zip(templates, shares)]

    def joined(of: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*of)))), ",")

    return found.select(
        F.col("_id").alias(id_col), "n_words", sum(n_base, F.lit(0).cast("long")).alias("n_base"),
        F.least(*first).alias("first_word"), F.greatest(*last).alias("last_word"), joined(base_labels).alias("base_labels"),
        joined([*base_labels, *labels]).alias("labels"), F.greatest(F.lit(0.0), *shares).alias("score"))


def oracle_sql(templates: list[Template] | None = None) -> str:
    """The same scan in DuckDB SQL, one row per occurrence instead of arrays."""
    templates = TEMPLATES if templates is None else templates
    quoted = lambda values: ", ".join(values)
    base = quoted(f"('{p}', '{label}', {len(p.split())})" for p, label in BASE_PHRASES.items())
    words = quoted(f"({k}, '{w}', {i})" for k, t in enumerate(templates) for i, w in enumerate(t.words))
    named = quoted(f"({k}, '{t.label}', '{p}')" for k, t in enumerate(templates) for p in t.phrases)
    return rf"""
WITH base(phrase, label, n) AS (VALUES {base}), template(t, word, place) AS (VALUES {words}), phrase(t, label, phrase) AS (VALUES {named}
), texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), padded AS (SELECT doc_id, ' ' || array_to_string(w, '  ') || ' ' AS p FROM texts
), words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts
), hits AS (
  SELECT x.doc_id, b.label, x.i FROM words x JOIN base b ON x.word = split_part(b.phrase, ' ', 1) JOIN texts t ON t.doc_id = x.doc_id
  WHERE array_to_string(t.w[x.i + 1:x.i + b.n], ' ') = b.phrase
), rarity AS (
  SELECT word, count(DISTINCT doc_id) AS df FROM words WHERE word IN (SELECT word FROM template) GROUP BY word
), rare AS (
  SELECT doc_id, t, word FROM (
    SELECT doc_id, t, word, row_number() OVER (PARTITION BY doc_id, t ORDER BY df, word) AS r FROM (
      SELECT DISTINCT x.doc_id, m.t, m.word, f.df FROM words x JOIN template m USING (word) JOIN rarity f USING (word)))
  WHERE r <= {RARE_WORDS}
), looked AS (SELECT doc_id, t, count(*) AS n FROM rare GROUP BY 1, 2
), agreeing AS (
  SELECT doc_id, t, max(n) AS agree FROM (
    SELECT r.doc_id, r.t, x.i - m.place AS start, count(DISTINCT r.word) AS n FROM rare r
    JOIN words x ON x.doc_id = r.doc_id AND x.word = r.word JOIN template m ON m.t = r.t AND m.word = r.word GROUP BY 1, 2, 3) GROUP BY 1, 2
), verified AS (
  SELECT d.doc_id, f.t, f.label FROM padded d CROSS JOIN phrase f GROUP BY 1, 2, 3
  HAVING bool_and(contains(d.p, ' ' || replace(f.phrase, ' ', '  ') || ' '))
), accepted AS (
  SELECT v.doc_id, v.label, a.agree / l.n AS share FROM verified v JOIN agreeing a USING (doc_id, t) JOIN looked l USING (doc_id, t) WHERE a.agree >= {AGREE}
), named AS (SELECT doc_id, label FROM hits UNION SELECT doc_id, label FROM accepted)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, (SELECT count(*) FROM hits h WHERE h.doc_id = t.doc_id) AS n_base,
  CAST((SELECT min(i) FROM hits h WHERE h.doc_id = t.doc_id) AS BIGINT) AS first_word,
  CAST((SELECT max(i) FROM hits h WHERE h.doc_id = t.doc_id) AS BIGINT) AS last_word,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM hits h WHERE h.doc_id = t.doc_id), '') AS base_labels,
  coalesce((SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM named h WHERE h.doc_id = t.doc_id), '') AS labels,
  coalesce((SELECT max(share) FROM accepted a WHERE a.doc_id = t.doc_id), 0.0) AS score
FROM texts t
"""
