"""Licence scans: texts against licence templates by word-bigram Dice.

Lines, and paragraphs of several lines, are normalised (lower case, letters
and digits only) and compared with every template whose size allows the
threshold: two sets of a and b bigrams can only reach a Dice coefficient of
t if b lies between a * t / (2 - t) and a * (2 - t) / t. Notices within longer
lines and passages within longer paragraphs are found by windows of the whole
text, as many words long as the template: a window that reaches t holds
b * t / (2 - t) of the template's bigrams, hence one of any larger rest of
them, its anchors. Native functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents, staged

PERCENT = 80

# Notices (fixed values): how a notice is worded, and the licences' names.
NOTICES = (
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "This work is licensed under the {}.",
    "Distributed under the terms of the {}.",
)
NAMES = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL version 2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL version 3"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "MPL-2.0": ("Mozilla Public License, Version 2.0",),
    "ISC": ("ISC License",),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Zero 1.0 Universal"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0",
                     "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",
                     "Creative Commons Attribution-NonCommercial 4.0 International License"),
}
# Passages of the licences themselves (fixed values).
PASSAGES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
            "and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted, provided that the above copyright notice and "
            "this permission notice appear in all copies."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License. You may obtain a copy of "
                   "the License at http://www.apache.org/licenses/LICENSE-2.0"),
)

# Passages of longer licences (fixed values); the SQL does not know them. BSD
# texts of three clauses have the two-clause passage as well.
TEXTS = (
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors "
                     "may be used to endorse or promote products derived from this software "
                     "without specific prior written permission."),
    ("GPL-2.0", "The licenses for most software are designed to take away your freedom to share "
                "and change it. By contrast, the GNU General Public License is intended to "
                "guarantee your freedom to share and change free software"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation; either version 2 of the License, or (at your option) any later "
                "version."),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and "
                "other kinds of works."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms "
                 "and conditions of version 3 of the GNU General Public License, supplemented by "
                 "the additional permissions listed below."),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software "
                 "and other kinds of works, specifically designed to ensure cooperation with the "
                 "community in the case of network server software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain "
                "one at"),
    ("CC0-1.0", "The laws of most jurisdictions throughout the world automatically confer "
                "exclusive Copyright and Related Rights (defined below) upon the creator and "
                "subsequent owner(s)"),
    *((licence, "By exercising the Licensed Rights (defined below), You accept and agree to be "
                f"bound by the terms and conditions of this Creative Commons {name} 4.0 "
                "International Public License")
      for licence, name in (("CC-BY-4.0", "Attribution"),
                            ("CC-BY-SA-4.0", "Attribution-ShareAlike"),
                            ("CC-BY-NC-4.0", "Attribution-NonCommercial"))),
)


def templates() -> list[tuple[str, str]]:
    """(licence, text) of all templates."""
    notices = [(licence, form.format(name)) for licence, names in NAMES.items()
               for name in names for form in NOTICES]
    return notices + list(PASSAGES)


def _words(text: Column) -> Column:
    """Array of normalised words; a text without any has one empty word."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.transform(
        F.slice(words, 2, F.size(words)), lambda w, i: F.concat(words[i], F.lit(" "), w)))


def _segments(text: Column) -> Column:
    """Lines, and paragraphs that have several lines."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(
        F.lit("line").alias("kind"), i.alias("number"), x.alias("segment")))
    paragraphs = F.transform(F.split(text, r"\n[ \t\r]*\n"), lambda x, i: F.struct(
        F.lit("paragraph").alias("kind"), i.alias("number"), x.alias("segment")))
    return F.concat(lines, F.filter(paragraphs, lambda p: F.contains(p["segment"], F.lit("\n"))))


def _once(column: Column) -> Column:
    """The column as a generated one: filters on it are not pushed below, which
    would evaluate it again, inside lambdas for every element."""
    return F.explode(F.array(column))


def _hashes(words: Column) -> Column:
    """Hash of the bigram at every word but the last."""
    return F.transform(F.slice(words, 2, F.size(words)),
                       lambda w, i: F.xxhash64(F.concat(words[i], F.lit(" "), w)))


def _windows(docs: DataFrame, matched: DataFrame, known: list[tuple[str, str]],
             percent: int) -> DataFrame:
    """Matches of template-sized windows outside the ``matched`` segments:
    the most similar of those that overlap (ties: more common bigrams, name,
    place). ``number`` is the window's first word (from 0)."""
    listed = docs.sparkSession.createDataFrame(known, "license string, template string").select(
        "license", _words(F.col("template")).alias("w")).where(F.size("w") > 1)
    b = F.size("g")
    # Long bigrams are rare ones.
    listed = listed.select("license", "w", _bigrams(F.col("w")).alias("g")).select(
        "license", (F.size("w") - 1).alias("m"), F.transform("g", lambda g: F.xxhash64(g)).alias("theirs"),
        F.explode(F.slice(F.transform(
            F.array_sort(F.transform("g", lambda g: F.struct((-F.length(g)).alias("n"), g.alias("g")))),
            lambda x: F.xxhash64(x["g"])), 1,
            b - F.ceil(b * percent / (200 - percent)).cast("int") + 1)).alias("a")).collect()
    listed_rows = [(r.license, r.m, r.theirs, r.a) for r in listed]
    anchors = F.lit(sorted({r.a for r in listed})).cast("array<bigint>")
    longest = max(r.m for r in listed)
    anchored = staged(docs.select("key", "t", "text", _once(_words(F.col("text"))).alias("w"))
                      .select("key", "t", "text", _once(_hashes(F.col("w"))).alias("h"))
                      .where(F.arrays_overlap("h", anchors)), "license-anchored")
    # Each anchor with the bigrams that a window around it may hold.
    at = anchored.select("key", "t", "h", F.inline(F.filter(
        F.transform("h", lambda x, i: F.struct(i.alias("i"), x.alias("a"))),
        lambda e: F.array_contains(anchors, e["a"]))))
    low = F.greatest(F.lit(0), F.col("i") - (longest - 1))
    at = at.select("key", "t", "i", "a", F.size("h").alias("n"), low.alias("low"),
                   F.slice("h", low + 1, F.lit(2 * longest)).alias("near"))
    pairs = at.join(F.broadcast(docs.sparkSession.createDataFrame(
        listed_rows, "license string, m int, theirs array<bigint>, a bigint")), "a")
    pairs = pairs.withColumn("per", F.least("m", "n"))
    pairs = pairs.withColumn("sets", F.transform(
        F.sequence(F.greatest(F.lit(0), F.col("i") - F.col("per") + 1),
                   F.least(F.col("i"), F.col("n") - F.col("per"))),
        lambda s: F.struct(s.alias("start"), F.array_distinct(
            F.slice("near", s - F.col("low") + 1, F.col("per"))).alias("ours"))))
    found = pairs.select("key", "t", "license", "per", F.size("theirs").alias("b"), F.inline(
        F.transform("sets", lambda x: F.struct(
            x["start"].alias("start"), F.size(x["ours"]).alias("a"),
            F.size(F.array_intersect(x["ours"], F.col("theirs"))).alias("common")))))
    both = F.col("a") + F.col("b")
    found = found.where(F.col("common") * 200 >= both * percent).select(
        "key", "t", "license", "start", (F.col("start") + F.col("per")).alias("last"), "common",
        F.round(F.col("common") * 2 / both, 6).alias("dice")).distinct()
    # The words of the matched segments.
    counts = [F.transform(F.split("text", cut), lambda x: F.size(F.filter(
        _words(x), lambda w: w != ""))).alias(kind)
        for kind, cut in (("line", "\n"), ("paragraph", r"\n[ \t\r]*\n"))]
    spans = anchored.select(F.col("key").alias("k"), F.col("t").alias("u"), *counts).join(
        matched, F.col("k").eqNullSafe(F.col("key")) & (F.col("u") == F.col("t")))
    counted = F.when(F.col("kind") == "line", F.col("line")).otherwise(F.col("paragraph"))
    first = F.aggregate(F.slice(counted, 1, F.col("number")), F.lit(0), lambda x, y: x + y)
    spans = spans.select("k", "u", first.alias("first"),
                         (first + counted[F.col("number")]).alias("after")).distinct()
    found = found.join(spans, F.col("k").eqNullSafe(F.col("key")) & (F.col("u") == F.col("t"))
                       & (F.col("start") < F.col("after")) & (F.col("last") >= F.col("first")),
                       "left_anti")
    # Stretches of windows that overlap; in each, from the best window on,
    # those that overlap no better one.
    run = Window.partitionBy("key", "t").orderBy("start", "last", "license", "common", "dice")
    before = F.max("last").over(run.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    found = found.withColumn("stretch", F.sum("new").over(run))
    ranked = F.array_sort(F.collect_list(F.struct(
        (-F.col("dice")).alias("d"), (-F.col("common")).alias("c"), "license", "start", "last")))
    best = found.groupBy("key", "t", "stretch").agg(ranked.alias("ranked"))
    best = best.select("key", F.inline(F.aggregate("ranked", F.slice("ranked", 1, 0), lambda acc, x:
        F.when(F.exists(acc, lambda y: (y["start"] <= x["last"]) & (x["start"] <= y["last"])), acc)
        .otherwise(F.concat(acc, F.array(x))))))
    return best.select("key", F.lit("window").alias("kind"), F.col("start").alias("number"),
                       "license", (-F.col("c")).alias("common"), (-F.col("d")).alias("dice"))


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None, percent: int = PERCENT,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per segment that matches: key, kind, number (from 0), license
    (the most similar template's, ties by name), common, dice; then one per
    window outside them (kind window, number of the first word).

    Null and empty texts and segments of one word match nothing. Rows that
    share a key, or have none, are texts of their own; rows that repeat key
    and text give their matches once. Other columns are not read; without
    documents or templates there are no rows.
    """
    spark = docs.sparkSession
    known = [*templates(), *TEXTS] if known is None else known
    listed = spark.createDataFrame(known, "license string, template string").select(
        "license", _words(F.col("template")).alias("w"))
    listed = listed.select("license", _bigrams(F.col("w")).alias("theirs")).where(
        F.size("theirs") > 0)
    # A template is listed under every size that can reach the threshold.
    a = F.size("theirs")
    sized = listed.select("license", "theirs", F.explode(F.sequence(
        F.ceil(a * percent / (200 - percent)).cast("int"),
        F.floor(a * (200 - percent) / percent).cast("int"))).alias("n"))
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("t"),
                        F.col(text).alias("text"))
    segments = (texts.select("key", "t", F.inline(_segments(F.col("text"))))
                .select("key", "t", "kind", "number", _once(_words(F.col("segment"))).alias("w")))
    # A set of bigrams is at most the words less one, so this bound is safe
    # above the smallest template; long segments are repetitive at best.
    least = sized.agg(F.min("n")).first()[0]
    if least is None:
        segments, least = segments.limit(0), 0
    grams = segments.where(F.size("w") > least).select(
        "key", "t", "kind", "number", _bigrams(F.col("w")).alias("ours"))
    # The templates are a fixed list of a few hundred short rows.
    pairs = grams.withColumn("n", F.size("ours")).join(F.broadcast(sized), "n").select(
        "key", "t", "kind", "number", "license", (F.size("ours") + F.size("theirs")).alias("both"),
        F.size(F.array_intersect("ours", "theirs")).alias("common"))
    hits = pairs.where(F.col("common") * 200 >= F.col("both") * percent).withColumn(
        "dice", F.round(F.col("common") * 2 / F.col("both"), 6))
    best = F.min(F.struct((-F.col("dice")).alias("d"), "license", "common")).alias("best")
    if not listed.take(1):
        return hits.groupBy("key", "t", "kind", "number").agg(best).select(
            "key", "kind", "number", "best.license", "best.common", (-F.col("best.d")).alias("dice"))
    hits = staged(hits.select("key", "t", "kind", "number", "license", "common", "dice"),
                  "license-segments")
    inside = _windows(texts, hits.select("key", "t", "kind", "number").distinct(), known, percent)
    return hits.groupBy("key", "t", "kind", "number").agg(best).select(
        "key", "kind", "number", "best.license", "best.common",
        (-F.col("best.d")).alias("dice")).unionByName(inside)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).withColumnRenamed("key", "doc_id")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_bigrams(words: str) -> str:
    return (f"list_distinct(list_transform(range(1, len({words})), "
            f"lambda i: {words}[i] || ' ' || {words}[i + 1]))")


def _sql_words(text: str) -> str:
    return (f"string_split(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), "
            "' ')")


_KNOWN = ",\n  ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in templates())
OP4_SQL = f"""
WITH known(license, template) AS (VALUES
  {_KNOWN}),
listed AS (
  SELECT license, {_sql_bigrams('w')} AS theirs
  FROM (SELECT license, {_sql_words('template')} AS w FROM known) k),
lines AS (
  SELECT doc_id, md5(text) AS t, 'line' AS kind, unnest(string_split(text, chr(10))) AS segment,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS number FROM documents),
paragraphs AS (
  SELECT doc_id, md5(text) AS t, 'paragraph' AS kind,
         unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) AS segment,
         generate_subscripts(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), 1) - 1 AS number
  FROM documents),
ours AS (
  SELECT doc_id, t, kind, number, {_sql_bigrams('w')} AS ours
  FROM (SELECT doc_id, t, kind, number, {_sql_words('segment')} AS w
        FROM (SELECT * FROM lines UNION ALL
              SELECT * FROM paragraphs WHERE contains(segment, chr(10))) s) u),
pairs AS (
  SELECT doc_id, t, kind, number, license, len(ours) + len(theirs) AS both_sizes,
         len(list_intersect(ours, theirs)) AS common
  FROM ours JOIN listed
    ON len(ours) * {200 - PERCENT} >= len(theirs) * {PERCENT}
   AND len(theirs) * {200 - PERCENT} >= len(ours) * {PERCENT})
SELECT doc_id, kind, CAST(number AS INTEGER) AS number, license,
       CAST(common AS INTEGER) AS common, round(common * 2 / both_sizes, 6) AS dice
FROM pairs WHERE common * 200 >= both_sizes * {PERCENT}
QUALIFY row_number() OVER (PARTITION BY doc_id, t, kind, number
        ORDER BY round(common * 2 / both_sizes, 6) DESC, license, common) = 1"""
