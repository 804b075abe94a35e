"""License scans by a positional index of rare words. DataFrame functions only.

Base: the phrases of BASE, wherever their words stand consecutively.

Method: the words of licence texts (TEMPLATES), but for function words, are postings (template, position). Each document's licence words
are found with their positions; of them the RARE ones with the highest inverse document frequency (counted over all documents; ties by
the word) are looked up. A hit and a posting differ by a relative position; hits of one template that agree in it, within a band of
2 * DRIFT, align. A template whose postings align by MATCH of their number, and by LEAST (or all that it has) at least, is verified: all
of its key phrases have to stand in the document. The label's score is the aligned share; a base label scores 1.

Words are runs of characters that are no ASCII white space, punctuation or controls; only A-Z are lower-cased. Texts are taken apart in
pieces of PIECE characters that end where words end, so that no array of all words of a long text is held. Null texts are empty: no words,
no labels, score 0. Repeated rows give repeated results, rows without an id are scanned as others are. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .secret_scan import _let, running
from .shared import cut, documents

#: The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, a part of the licence's text or its usual notice, and what has to stand there word by word.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ("permission is hereby granted free of charge", "without restriction")),
    ("mit", "Released under the MIT License", ("the mit license",)),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND", ("except in compliance with the license",)),
    ("apache", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ("gnu general public license", "free software foundation")),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version", ("gnu lesser general public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", ("redistribution and use in source and binary forms",)),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ("with or without fee is hereby granted",)),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", ("mozilla public license",)),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", ("free and unencumbered software",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0 international",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
)
#: Words that are no postings.
FUNCTION_WORDS = "a all an and any are as at by can either for if in is it not of on or the this to was with you your".split()
RARE = 64
DRIFT = 8
MATCH = 0.5
LEAST = 3
PIECE = 1 << 16

_WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words_of(text: str) -> list[str]:
    """The words of one of the texts above."""
    return re.findall("[0-9a-z]+", text.lower())


def phrase_pattern(*phrases: str) -> str:
    """A pattern of phrases, as the first group: their words, with whatever is no word between them. Case matters for letters other than A-Z."""
    return f"(?i)(?<!{_WORD})(" + "|".join(f"{_GAP}+".join(p.split()) for p in phrases) + f")(?!{_WORD})"


def count_words(text: Column) -> Column:
    """How many words a text has. Each becomes one letter, so that no array of them is needed."""
    return F.when(text.rlike(_WORD), F.length(F.regexp_replace(text, f"{_GAP}*+{_WORD}++{_GAP}*+", "w"))).otherwise(0).cast("long")


def postings(templates=TEMPLATES) -> list[tuple[str, int, int]]:
    """(word, template, position) of all templates."""
    return [(w, k, at) for k, (_, text, _) in enumerate(templates) for at, w in enumerate(words_of(text)) if w not in FUNCTION_WORDS]


def _parts(text: Column, known: list[str]) -> Column:
    """array<struct<n, hits>> of a text's pieces: how many words, and (word, position) of those that are known."""

    def part(piece: Column) -> Column:
        hit = lambda w, i: F.when(F.lower(w).isin(known), F.struct(F.lower(w).alias("word"), i.cast("long").alias("at")))
        return _let(F.regexp_extract_all(piece, F.lit(f"({_WORD}+)")), lambda w: F.struct(F.size(w).alias("n"), F.array_compact(F.transform(w, hit)).alias("hits")))

    pieces = F.when(F.length(text) <= PIECE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"((?s:.{{1,{PIECE}}}+){_WORD}*+)")))
    return F.transform(pieces, part)


def _placed(parts: Column) -> Column:
    """array<struct<word, at>>: the hits of all pieces, by position in the text."""
    moved = lambda hits, n: F.transform(hits, lambda h: F.struct(h["word"].alias("word"), (h["at"] + n).alias("at")))
    ends = running(F.transform(parts, lambda p: p["n"]), lambda a, b: a + b)
    many = _let(ends, lambda e: F.flatten(F.transform(parts, lambda p, k: moved(p["hits"], F.get(e, k) - p["n"]))))
    return F.when(F.size(parts) == 1, F.get(parts, 0)["hits"]).otherwise(many)


def scanned(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n_words, n_base, first_word, last_word, base_labels, hits, verified): one pass over the texts. verified are the templates whose key phrases are there."""
    known = sorted({w for w, _, _ in postings(templates)})
    base = phrase_pattern(*(p for p, _ in BASE))
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    text = F.col("__text")
    docs = docs.withColumn("parts", _parts(text, known))
    docs = docs.withColumns({"n_words": F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["n"]), "hits": _placed(F.col("parts"))}).drop("parts")
    # Most texts have no licence's word, and end here.
    found = F.when((F.size("hits") > 0) & text.rlike("(?i)license"), F.regexp_extract_all(text, F.lit(base))).otherwise(F.array().cast("array<string>"))
    docs = docs.withColumn("found", found)
    some = F.size("found") > 0
    gaps = F.when(some, F.split(text, base, -1))
    label = lambda p: F.coalesce(*(F.when(F.lower(F.substring(p, 1, 1)) == q[0], F.lit(name)) for q, name in BASE))
    size = F.when(label(F.element_at("found", -1)) == "gpl", 3).otherwise(2)
    verified = F.array_compact(F.array(*(F.when(_all(text.rlike(phrase_pattern(p)) for p in phrases), F.lit(k)) for k, (_, _, phrases) in enumerate(templates))))
    # Templates that can align have so many words at least.
    verified = F.when(F.size(F.array_distinct(F.transform("hits", lambda h: h["word"]))) >= min(LEAST, *(len(words_of(t)) for _, t, _ in templates)), verified)
    return docs.select(
        "row", id_col, "n_words", F.size("found").cast("long").alias("n_base"), F.when(some, count_words(F.element_at(gaps, 1))).alias("first_word"), F.when(some, F.col("n_words") - count_words(F.element_at(gaps, -1)) - size).alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("found", label))).alias("base_labels"), "hits", F.coalesce(verified, F.array().cast("array<int>")).alias("verified"),
    )


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def aligned(scan: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(row, template, share) of each template that aligns with a document of a scan and is verified."""
    spark = scan.sparkSession
    index = postings(templates)
    sizes = [sum(k == t for _, t, _ in index) for k in range(len(templates))]
    words = F.transform("hits", lambda h: h["word"])
    with_hits = scan.filter(F.size("hits") > 0)
    # A row for each of the templates' words at most.
    counts = {r.word: r.n for r in with_hits.select(F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return spark.createDataFrame([], "row long, template int, share double")
    # The fewer documents, the higher the inverse document frequency.
    order = F.array(*(F.lit(w) for w, _ in sorted(counts.items(), key=lambda x: (x[1], x[0]))))
    ranked = F.filter(order, lambda w: F.array_contains(F.col("words"), w))
    rare = with_hits.filter(F.size("verified") > 0).withColumn("words", F.array_distinct(words)).withColumn("rare", F.slice(ranked, 1, RARE))
    looked = rare.select("row", "verified", F.explode(F.filter("hits", lambda h: F.array_contains("rare", h["word"]))).alias("h")).select("row", "verified", F.col("h.word").alias("word"), F.col("h.at").alias("at"))
    table = F.broadcast(spark.createDataFrame(index, "word string, template int, position int"))
    offset = F.floor((F.col("at") - F.col("position")) / DRIFT)
    met = looked.join(table, "word").filter(F.array_contains("verified", F.col("template"))).select("row", "template", "position", F.explode(F.array(offset, offset - 1)).alias("band"))
    agree = met.groupBy("row", "template", "band").agg(F.count_distinct("position").alias("n"))
    size = F.get(F.array(*(F.lit(n) for n in sizes)), F.col("template"))
    enough = (F.col("n") >= F.least(F.lit(LEAST), size)) & (F.col("n") >= MATCH * size)
    return agree.filter(enough).groupBy("row", "template").agg(F.max(F.col("n") / size).alias("share"))


def licenses(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels (sorted, comma-joined), score."""
    scan = cut(scanned(docs, templates, id_col, text_col), "licenses")
    names = F.array(*(F.lit(label) for label, _, _ in templates))
    found = aligned(scan, templates).groupBy("row").agg(F.collect_set(F.get(names, F.col("template"))).alias("more"), F.max("share").alias("share"))
    every = scan.select("row", id_col, "n_words", "n_base", "first_word", "last_word", "base_labels").join(found, "row", "left")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.size("base_labels") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return every.select(id_col, "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(documents(spark, sf_dir))


def _oracle(templates=TEMPLATES) -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    index = postings(templates)
    posts = ", ".join(f"({text(w)}, {k}, {at})" for w, k, at in index)
    kinds = ", ".join(f"({k}, {text(label)}, {sum(t == k for _, t, _ in index)}, [{', '.join(text(f' {p} ') for p in phrases)}])" for k, (label, _, phrases) in enumerate(templates))
    base = ", ".join(f"([{', '.join(map(text, p.split()))}], {text(label)})" for p, label in BASE)
    return f"""with d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
w as (select r, unnest(w) word, unnest(range(len(w))) wpos from d),
base as (select * from (values {base}) b(p, label)),
places as (select w.r, w.wpos, label from w join base on w.word = p[1] join d on d.r = w.r where d.w[w.wpos + 1 : w.wpos + len(p)] = p),
b as (select r, count(*) n_base, min(wpos) first_word, max(wpos) last_word, string_agg(distinct label, ',' order by label) base_labels, list(distinct label) labels from places group by 1),
post as (select * from (values {posts}) x(word, k, pos)),
kind as (select * from (values {kinds}) x(k, label, size, phrases)),
hits as (select r, wpos, word from w where word in (select word from post)),
df as (select word, count(distinct r) n from hits group by 1),
ranked as (select r, word, row_number() over (partition by r order by n, word) place from (select distinct r, word from hits) join df using (word)),
met as (select h.r, post.k, pos, floor((wpos - pos) / {DRIFT}.0) - o band from hits h join ranked g on g.r = h.r and g.word = h.word and place <= {RARE} join post on post.word = h.word, (values (0), (1)) v(o)),
agree as (select r, k, band, count(distinct pos) n from met group by all),
found as (select r, label, max(n / size) share from agree join kind using (k) join d using (r)
    where n >= least({LEAST}, size) and n >= {MATCH} * size and list_bool_and(list_transform(phrases, lambda p: contains(' ' || array_to_string(w, ' ') || ' ', p))) group by all),
f as (select r, list(distinct label) labels, max(share) share from found group by 1)
select doc_id, len(w)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word, last_word, coalesce(base_labels, '') base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') labels, case when n_base > 0 then 1.0 else coalesce(share, 0) end::double score from d left join b using (r) left join f using (r)"""


ORACLE = _oracle()
