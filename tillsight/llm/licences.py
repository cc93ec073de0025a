"""Licence scan: TF-IDF cosine to templates, then inheritance along directories (operator 2).

A file's lines are compared with the templates of licence notices as sparse TF-IDF
vectors: weights are term frequency times ``ln((1 + N) / (1 + df)) + 1``, with N and
df counted over all lines of the corpus that have a term.  A line whose cosine to
a template reaches THRESHOLD carries that licence; a file's own licence is that of
its best line.  A file named like a licence file, or at least half of whose terms stand
in licence lines, is the licence file of its directory.  A file without a licence of its
own takes that of the nearest directory above it (its own first) with a licence file.

Notices inside longer lines or wrapped over lines are found in windows: of a file's terms
in a row, as many as a template has are compared with it wherever a heavy term of the
template stands, laid over its place in the template (NEAR for the one-line notices,
the threshold for HEADERS, which are too long to be met by chance).  Windows count for
a file like lines; the terms in licence lines and those in windows are counted each for
themselves and the larger number decides about a licence file.

DataFrame operations only.  A line can only reach the threshold if it has one of the
heavy terms of a template (the rest of the template's weight is below the
threshold), so only such lines are cut into terms and joined.  Directories, not files,
are joined with their ancestors, and the templates' terms are the only table sent to
all tasks besides.

Defined results: null and empty texts carry no licence; null parts of a path are empty;
every row is a file of its own, also where rows share a path or have no doc_id (rows equal in
path and text get equal results); ties between templates go to the first
name, between licence files of a directory to the better match, then the first name;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.staging import join_small, prepare, read, stage

#: Licence and a notice of it; fixed values.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
_GNU = ("{what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {name} Public License "
        "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
_GNU_TITLE = ("GNU {name} PUBLIC LICENSE Version {version} Copyright (C) {year} Free Software Foundation, Inc. Everyone is permitted "
              "to copy and distribute verbatim copies of this license document, but changing it is not allowed.")
#: Licence and a header of several lines, its full text (MIT, BSD, Unlicense) or the start of it; fixed values.
HEADERS = (
    ("AGPL-3.0", _GNU.format(what="This program", colon=":", name="Affero General", version=3)),
    ("AGPL-3.0", _GNU_TITLE.format(name="AFFERO GENERAL", version="3, 19 November 2007", year=2007)),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ "
                   "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
                     "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
                     "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
                     "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
                     "its contributors may be used to endorse or promote products derived from this software without specific "
                     "prior written permission."),
    ("GPL-2.0", _GNU.format(what="This program", colon=";", name="General", version=2)),
    ("GPL-2.0", _GNU_TITLE.format(name="GENERAL", version="2, June 1991", year="1989, 1991")),
    ("GPL-3.0", _GNU.format(what="This program", colon=":", name="General", version=3)),
    ("GPL-3.0", _GNU_TITLE.format(name="GENERAL", version="3, 29 June 2007", year=2007)),
    ("LGPL-3.0", _GNU.format(what="This library", colon=":", name="Lesser General", version=3)),
    ("LGPL-3.0", _GNU_TITLE.format(name="LESSER GENERAL", version="3, 29 June 2007", year=2007)),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
            "and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means."),
)
#: Windows start in segments of so many terms.
SEGMENT = 512
#: File names of licence files; a fixed value.
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|unlicense|notice)([.-].*)?$"
TERM = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
THRESHOLD = 0.7
#: Cosine from which a window carries a one-line notice: two of three words in running text are no notice.
NEAR = 0.9


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), 0)


def template_terms(templates) -> list[Counter]:
    return [Counter(template_words(text)) for _, text in templates]


def template_words(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


def document_frequencies(lines: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Lines with a term, and lines with each term of the vocabulary (its size bounds what is collected)."""
    known = F.array_intersect("terms", F.array(*map(F.lit, vocabulary)))
    each = lines.select(terms(F.col("line")).alias("terms")).filter(F.size("terms") > 0).select(
        F.explode(F.concat(F.array(F.lit("")), known)).alias("term"))
    counts = {r["term"]: r["n"] for r in each.groupBy("term").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def heavy_terms(vectors: list[dict[str, float]], threshold: float) -> set[str]:
    """Terms one of which any line must have whose cosine to a template reaches the threshold."""
    heavy = set()
    for v in vectors:
        rest = whole = sum(w * w for w in v.values())
        for term, w in sorted(v.items(), key=lambda x: (-x[1], x[0])):
            if rest < threshold * threshold * whole * (1 - 1e-9):
                break
            heavy.add(term)
            rest -= w * w
    return heavy


#: What a row is known by: rows with the same path and text are judged alike.
FILE = ("path", "dir", "name", "digest")


def windows(files: DataFrame, templates, least: list[float], n: int, df: dict[str, int]) -> DataFrame:
    """FILE, x, n of the files with windows near a template; n terms stand in such windows.

    ``least`` has the cosine from which a window counts for each template, ``n`` and ``df``
    the frequencies over lines.  A file is cut into segments that overlap by the
    longest template, so that no row but the file's own follows its length.
    """
    counted = template_terms(templates)
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for c in counted for t in c}
    vectors = [{t: k * idf[t] for t, k in c.items()} for c in counted]
    anchors: dict[str, list[tuple[int, int]]] = {}
    for k, v in enumerate(vectors):
        for t in heavy_terms([v], least[k]) & df.keys():
            anchors.setdefault(t, []).extend((k, i) for i, x in enumerate(template_words(templates[k][1])) if x == t)
    heavy = sorted(anchors) or [""]
    longest = max(sum(c.values()) for c in counted)
    text = lambda x: "'" + x.replace("'", "\\'") + "'"
    places = ", ".join(f"{text(t)}, array({', '.join(f'struct({k} AS k, {i} AS i)' for k, i in anchors.get(t, []) or [(-1, 0)])})"
                       for t in heavy)
    units = ", ".join("map({})".format(", ".join(
        f"{text(t)}, {w / math.sqrt(sum(x * x for x in v.values()))!r}D" for t, w in v.items())) for v in vectors)
    each = lambda values: f"array({', '.join(values)})"
    known = F.array(*map(F.lit, heavy))
    whole = (files.filter(has_term("text", heavy)).select(*FILE, F.monotonically_increasing_id().alias("file"),
                                                          terms(F.col("text")).alias("terms")).filter(F.arrays_overlap("terms", known)))
    parts = (whole.select(*FILE, "file", F.explode(F.expr(
        f"transform(sequence(0, size(terms) - 1, {SEGMENT}), s -> struct(s AS s, slice(terms, s + 1, {SEGMENT + longest}) AS part))")
        ).alias("p")).select(*FILE, "file", "p.s", "p.part").filter(F.arrays_overlap("part", known)))
    # The template terms of a segment bound the cosine of all its windows.
    vocabulary = F.array(*map(F.lit, sorted(idf)))
    bounds = each(f"{x * x * (1 - 1e-9)!r}D" for x in least)
    parts = parts.withColumn("met", F.array_intersect("part", vocabulary)).withColumn("open", F.expr(
        f"filter(sequence(0, {len(vectors) - 1}), k -> aggregate(met, 0D, (a, t) -> a + pow(coalesce(array({units})[k][t], 0D), 2))"
        f" >= {bounds}[k])")).filter(F.size("open") > 0)
    # A window starts at the place of its heavy term less the term's place in the template, in this segment.
    starts = f"""array_distinct(filter(flatten(transform(filter(sequence(0, size(part) - 1), i -> map_contains_key(map({places}), part[i])),
        i -> transform(element_at(map({places}), part[i]), x -> struct(x.k AS k, greatest(i - x.i, if(s = 0, 0, -1)) AS at)))),
        w -> array_contains(open, w.k) AND w.at >= 0 AND w.at < {SEGMENT}))"""
    size = each(str(sum(c.values())) for c in counted)
    cut = (parts.select(*FILE, "file", "s", "part", F.explode(F.expr(starts)).alias("w"))
           .select(*FILE, "file", "w.k", (F.col("s") + F.col("w.at")).alias("at"),
                   F.expr(f"slice(part, w.at + 1, {size}[w.k])").alias("window"), F.expr(f"array({units})[w.k]").alias("unit")))
    # The terms that a window shares with the template bound its cosine.
    cut = cut.withColumn("words", F.array_distinct("window")).withColumn("least", F.expr(each(f"{x!r}D" for x in least) + "[k]"))
    cut = cut.filter(F.expr("aggregate(words, 0D, (a, t) -> a + pow(coalesce(unit[t], 0D), 2))") >= F.col("least") * F.col("least") * (1 - 1e-9))
    weights = ", ".join(f"{text(t)}, {w!r}D" for t, w in sorted(idf.items()))
    cut = cut.withColumn("w", F.expr(f"transform(words, t -> size(filter(window, x -> x = t)) * coalesce(map({weights})[t], {math.log(1 + n) + 1!r}D))"))
    dot = F.expr("aggregate(zip_with(words, w, (t, y) -> y * coalesce(unit[t], 0D)), 0D, (a, y) -> a + y)")
    length = F.expr("sqrt(aggregate(w, 0D, (a, y) -> a + y * y))")
    near = cut.withColumn("score", F.round(dot / length, 9)).filter(F.col("score") >= F.col("least"))
    near = stage(near.select(*FILE, "file", "at", F.size("window").alias("size"), "score",
                             F.expr(each(text(name) for name, _ in templates) + "[k]").alias("licence")), "licence-windows")
    covered = (near.select("path", "digest", "file", F.explode(F.expr("sequence(at, at + size - 1)")).alias("at")).distinct()
               .groupBy("path", "digest", "file").agg(F.count("*").alias("n")).groupBy("path", "digest").agg(F.max("n").alias("n")))
    return near.groupBy(*FILE).agg(F.min(F.struct(-F.col("score"), "licence")).alias("x")).join(covered, ["path", "digest"])


def has_term(text: str, some: list[str]) -> Column:
    start, end = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
    return F.lower(text).rlike(f"{start}(?:{'|'.join(t.replace('.', '[.]') for t in some)}){end}")


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, headers=HEADERS) -> DataFrame:
    """path, digest, dir, own, score, licence_file of the files ``(dir, name, path, text, digest)`` that carry a licence."""
    spark = files.sparkSession
    files = files.select(*FILE, "text")
    lines = files.select(*FILE, F.monotonically_increasing_id().alias("file"), F.explode(F.split("text", "\n")).alias("line"))
    counted = template_terms(templates)
    vocabulary = sorted({t for c in counted for t in c})
    longer = [*templates, *headers]
    n, df = document_frequencies(lines, sorted({t for c in template_terms(longer) for t in c}))
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in vocabulary}
    vectors = [{t: k * idf[t] for t, k in c.items()} for c in counted]
    heavy = sorted(t for t in heavy_terms(vectors, threshold) if t in df) or [""]  # no line has the others
    some = lines.filter(has_term("line", heavy))
    some = some.withColumn("terms", terms(F.col("line"))).filter(F.arrays_overlap("terms", F.array(*map(F.lit, heavy))))
    some = stage(some.select(*FILE, "file", "terms", F.monotonically_increasing_id().alias("row")), "licence-lines")
    weights = spark.createDataFrame([(t, w) for t, w in idf.items()], "term string, idf double")
    units = spark.createDataFrame(
        [(t, k, templates[k][0], w / math.sqrt(sum(x * x for x in v.values()))) for k, v in enumerate(vectors) for t, w in v.items()],
        "term string, template int, licence string, unit double")
    unseen = math.log(1 + n) + 1
    line = (some.select("row", F.explode("terms").alias("term")).groupBy("row", "term").agg(F.count("*").alias("tf"))
            .join(F.broadcast(weights), "term", "left")
            .select("row", "term", (F.col("tf") * F.coalesce("idf", F.lit(unseen))).alias("w")))
    line = stage(line, "licence-terms")
    length = line.groupBy("row").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    cosines = (line.join(F.broadcast(units), "term").groupBy("row", "template", "licence")
               .agg(F.sum(F.col("w") * F.col("unit")).alias("dot")).join(length, "row")
               .select("row", "licence", F.round(F.col("dot") / F.col("length"), 9).alias("score"))
               .filter(F.col("score") >= threshold))
    best = cosines.groupBy("row").agg(F.min(F.struct(-F.col("score"), "licence")).alias("x"))
    hits = some.join(best, "row").groupBy(*FILE, "file").agg(F.min("x").alias("x"), F.sum(F.size("terms")).alias("n")).drop("file")
    least = [max(threshold, NEAR)] * len(templates) + [threshold] * len(headers)
    hits = hits.unionByName(windows(files, longer, least, n, df))
    hits = stage(hits.groupBy(*FILE).agg(F.min("x").alias("x"), F.max("n").alias("n")), "licence-hits")
    sizes = (join_small(files.select("path", "digest", "text"), hits.select("path", "digest"), ["path", "digest"], "left_semi")
             .groupBy("path", "digest").agg(F.max(F.size(terms(F.col("text")))).alias("m")))
    return (hits.join(sizes, ["path", "digest"])
            .select("path", "digest", "dir", F.col("x.licence").alias("own"), (-F.col("x.col1")).alias("score"),
                    ((2 * F.col("n") >= F.col("m")) | F.col("name").rlike(LICENCE_NAME)).alias("licence_file")))


def ancestors(dir_: Column) -> Column:
    """A directory and all above it down to the root, as paths."""
    parts = F.split(dir_, "/")
    return F.transform(F.sequence(F.lit(0), F.when(dir_ == "", 0).otherwise(F.size(parts))),
                       lambda k: F.array_join(F.slice(parts, 1, k), "/"))


def inherit(files: DataFrame, found: DataFrame) -> DataFrame:
    """Columns of ``files`` with own, licence_file, licence and inherited_from."""
    of_dir = (found.filter("licence_file").groupBy("dir").agg(F.min(F.struct(-F.col("score"), F.col("own"))).alias("x"))
              .select(F.col("dir").alias("above"), F.col("x.own").alias("given")))
    nearest = (files.select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("above"))
               .join(of_dir, "above").groupBy("dir")
               .agg(F.max(F.struct(F.length("above"), F.col("above"), F.col("given"))).alias("x"))
               .select("dir", F.col("x.above").alias("above"), F.col("x.given").alias("given")))
    own = found.select("path", "digest", "own", "licence_file")
    return (files.join(own, ["path", "digest"], "left").join(stage(nearest, "licence-dirs"), "dir", "left")
            .withColumn("licence", F.coalesce("own", "given"))
            .withColumn("inherited_from", F.when(F.col("own").isNull(), F.col("above")))
            .withColumn("licence_file", F.coalesce("licence_file", F.lit(False))).drop("above", "given"))


def licences(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, own, licence_file, licence, inherited_from of ``files(doc_id, dir, name, text)``."""
    path = F.concat(F.col("dir"), F.when(F.col("dir") == "", "").otherwise("/"), F.col("name"))
    placed = files.withColumn("path", path).withColumn("digest", F.md5(F.col("text").cast("binary")))
    found = stage(scan(placed, templates, threshold), "licence-files")
    return inherit(placed.select("doc_id", "dir", "path", "digest"), found).drop("dir", "digest")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document; documents are the files ``source/lang/doc_id``."""
    prepare(spark)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = read(spark, sf_dir, "documents")
    return licences(docs.select("doc_id", F.concat(text("source"), F.lit("/"), text("lang")).alias("dir"),
                                text("doc_id").alias("name"), "text"))


_T = ", ".join(f"({k}, '{name}', '{text.lower()}')" for k, (name, text) in enumerate(TEMPLATES))
_TERM_SQL = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"

ORACLE_OP2 = rf"""
WITH files AS (
  SELECT doc_id, coalesce(source, '') || '/' || coalesce(lang, '') AS dir, coalesce(CAST(doc_id AS VARCHAR), '') AS name, text
  FROM documents),
placed AS MATERIALIZED (SELECT *, dir || '/' || name AS path, row_number() OVER () AS file FROM files),
lines AS (SELECT file, unnest(string_split(text, chr(10))) AS line FROM placed),
cut AS MATERIALIZED (SELECT row_number() OVER () AS row, file, regexp_extract_all(lower(line), '{_TERM_SQL}') AS terms FROM lines),
templates(k, licence, notice) AS (VALUES {_T}),
template_tf AS (
  SELECT k, licence, term, count(*) AS tf
  FROM (SELECT k, licence, unnest(regexp_extract_all(notice, '{_TERM_SQL}')) AS term FROM templates) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT term FROM template_tf),
total AS (SELECT count(*) AS n FROM cut WHERE len(terms) > 0),
words AS (SELECT row, unnest(terms) AS term FROM cut),
line_tf AS (SELECT row, term, count(*) AS tf FROM words GROUP BY ALL),
dfs AS (SELECT term, count(row) AS df FROM vocabulary LEFT JOIN line_tf USING (term) GROUP BY term),
idfs AS (SELECT term, ln((1.0 + n) / (1 + df)) + 1 AS idf FROM dfs, total),
weights AS (SELECT row, term, tf * coalesce(idf, ln(1.0 + n) + 1) AS w FROM line_tf LEFT JOIN idfs USING (term), total),
lengths AS (SELECT row, sqrt(sum(w * w)) AS length FROM weights GROUP BY row),
units AS (
  SELECT k, licence, term, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY k)) AS unit
  FROM template_tf JOIN idfs USING (term)),
dots AS (SELECT row, k, licence, sum(w * unit) AS dot FROM weights JOIN units USING (term) GROUP BY ALL),
cosines AS (SELECT row, licence, round(dot / length, 9) AS score FROM dots JOIN lengths USING (row)),
hits AS (
  SELECT row, min({{'s': -score, 'l': licence}}) AS x FROM cosines WHERE score >= {THRESHOLD} GROUP BY row),
sizes AS (SELECT file, len(regexp_extract_all(lower(text), '{_TERM_SQL}')) AS m FROM placed),
found AS (
  SELECT file, min(x) AS x, 2 * sum(len(terms)) >= any_value(m) AS licence_file
  FROM hits JOIN cut USING (row) JOIN sizes USING (file) GROUP BY file),
of_dir AS (
  SELECT dir AS above, min(x).l AS given FROM found JOIN placed USING (file) WHERE licence_file GROUP BY dir),
dirs AS (SELECT DISTINCT dir FROM placed),
nearest AS (
  SELECT dir, max({{'n': length(above), 'above': above, 'given': given}}) AS x
  FROM dirs JOIN of_dir ON above = '' OR starts_with(dir || '/', above || '/') GROUP BY dir)
SELECT doc_id, path, found.x.l AS own, coalesce(licence_file, FALSE) AS licence_file,
       coalesce(found.x.l, nearest.x.given) AS licence,
       CASE WHEN found.x.l IS NULL THEN nearest.x.above END AS inherited_from
FROM placed LEFT JOIN found USING (file) LEFT JOIN nearest USING (dir)
"""
