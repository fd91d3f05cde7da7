"""License scans in DataFrame operations: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Every line of a file that mentions a licence is a header, by itself and with its neighbours (one line before, two behind). Of a
file named like LICENSE or COPYING that mentions one anywhere, the headers are its opening lines, all windows of some lines that
mention one, whatever its length, and a short text as a whole: a licence can come behind a preface or many copyright lines. The tokens of a header
become a sparse TF-IDF vector, whose cosines with the templates' vectors come from a join on tokens. A file has the licence of
its best header; of a licence file that of the place where the first header lies that is about as good as the best, as long
licences name themselves at the top and quote each other further down. A file without one has that of the nearest ancestor directory with a licence file.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import cut, table

LEAST_COSINE = 0.4
DIGITS = 4  # of a returned cosine
MENTION = r"(?i)licen[cs]|copyright|spdx|creative commons|\bCC[ -]BY|all rights reserved|permission is hereby granted|permission to use, copy|redistribution and use|public domain"
BEFORE, BEHIND = 1, 2  # neighbours of a line that mentions a licence
OPENING = 7  # lines with text
WINDOWS, STEP = (12, 24), 4  # lines with text of a window, short or long, and from one to the next
WINDOW = max(WINDOWS)
WHOLE = 3000  # characters up to which a text is compared as a whole as well; in a longer one a licence is a part, which windows find
ABOUT = 0.15  # a header is about as good as the best if its cosine is at most so much below
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([-_.][^/]*)?$"
#: Licences whose text begins with, or holds, that of another. A window can cut off what makes the difference, so that the
#: longer one counts where it is about as good.
EXTENDS = {"BSD": ["BSD-2-Clause", "BSD-3-Clause"], "BSD-2-Clause": ["BSD-3-Clause"]}
TOKEN = r"[a-z]+|[0-9]+(?:\.[0-9]+)?"
#: Notices and openings of common licences, and short licences in full. A licence can have several. GPL and BSD
#: without a version are what a notice without one can tell.
FSF = "Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MIT", 'MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL", "Licensed under the GNU General Public License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 " + FSF),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 " + FSF),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989 Copyright (C) 1989 " + FSF),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 " + FSF),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 " + FSF),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1991 " + FSF),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 " + FSF),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008 Copyright (C) 2000, 2001, 2002, 2007, 2008 " + FSF),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002 Copyright (C) 2000, 2001, 2002 " + FSF),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", 'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.'),
    ("MPL-1.1", 'MOZILLA PUBLIC LICENSE Version 1.1 1. Definitions. 1.0.1. "Commercial Use" means distribution or otherwise making the Covered Code available to a third party. 1.1. "Contributor" means each entity that creates or contributes to'),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. Use of this source code is governed by a BSD-style license: BSD 3-Clause License"),
    ("BSD-3-Clause", "Copyright (c) All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "BSD 2-Clause License Copyright (c) All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Artistic-1.0", 'The "Artistic License" Preamble The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package'),
    ("Unlicense", "This is free and unencumbered software released into the public domain. The Unlicense"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication. Licensed under CC0 1.0."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Proprietary", "Copyright. All rights reserved. No part may be reproduced without prior written permission."),
]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def template_vectors(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(template, license, token, weight) with unit length, and (token, idf). Both come from the fixed list above, so that
    their size is bounded: they are broadcast."""
    listed = spark.createDataFrame([(i, x, t) for i, (x, t) in enumerate(TEMPLATES)], "template int, license string, text string")
    terms = listed.select("template", "license", F.explode(tokens(F.col("text"))).alias("token")).groupBy("template", "license", "token").agg(F.count("*").alias("tf"))
    idf = terms.groupBy("token").agg((F.log((1.0 + len(TEMPLATES)) / (1.0 + F.count("*"))) + 1.0).alias("idf"))
    raw = terms.join(idf, "token").withColumn("w", F.col("tf") * F.col("idf"))
    length = raw.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return raw.join(length, "template").select("template", "license", "token", (F.col("w") / F.col("length")).alias("weight")), idf


def headers(text: Column, whole: Column) -> Column:
    """(line, header) of each header; of a licence file the opening (line -1), all windows that mention a licence, by their first
    line among those with text, and a short text as a whole (line -2)."""
    lines = F.split(text, "\n")
    part = lambda at, before, behind: F.array_join(F.slice(lines, F.greatest(at - before, F.lit(0)) + 1, F.least(at, F.lit(before)) + 1 + behind), " ")
    own = F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("header")))
    found = F.filter(own, lambda x: x["header"].rlike(MENTION))
    near = F.transform(found, lambda x: F.struct(x["line"].alias("line"), part(x["line"], BEFORE, BEHIND).alias("header")))
    said = F.filter(lines, lambda x: x.rlike(r"\S"))
    opening = F.struct(F.lit(-1).alias("line"), F.array_join(F.slice(said, 1, OPENING), " ").alias("header"))
    full = F.struct(F.lit(-2).alias("line"), F.regexp_replace(text, "\n", " ").alias("header"))
    starts = F.sequence(F.lit(0), F.greatest(F.size(said) - 1, F.lit(0)), F.lit(STEP))
    window = lambda n: lambda i: F.struct(i.alias("line"), F.array_join(F.slice(said, i + 1, F.lit(n)), " ").alias("header"))
    windows = [F.transform(starts, window(n)) for n in WINDOWS]
    telling = F.filter(F.concat(*windows), lambda x: x["header"].rlike(MENTION))
    return F.when(whole, F.concat(F.when(F.length(text) <= WHOLE, F.array(full, opening)).otherwise(F.array(opening)), telling)).otherwise(F.array_distinct(F.concat(found, near)))


def matches(files: DataFrame) -> DataFrame:
    """(path, hash, license, score): of each distinct file (path, hash, text) with headers the best-matching template's licence.

    One pass over the texts, of which those that mention a licence are shuffled: the terms of a header meet the templates' vectors in a broadcast, and each gives its share of the
    products, by template, and of the squared length.
    """
    vectors, idf = template_vectors(files.sparkSession)
    hits = vectors.groupBy("token").agg(F.collect_list(F.struct("template", "license", "weight")).alias("hits")).join(idf, "token")
    unknown = math.log(1.0 + len(TEMPLATES)) + 1.0
    whole = F.col("path").rlike(LICENCE_FILE)
    # Files of equal path and text are one file, which meets in one task; all that follows is grouped within files, so nothing else is shuffled.
    one = files.where(F.col("text").rlike(MENTION)).groupBy("path", "hash").agg(F.first("text").alias("text"))
    found = one.select("path", "hash", F.explode(headers(F.col("text"), whole)).alias("h")).select("path", "hash", F.col("h.line").alias("line"), F.xxhash64("h.header").alias("view"), F.explode(tokens(F.col("h.header"))).alias("token"))
    terms = found.groupBy("path", "hash", "line", "view", "token").agg(F.count("*").alias("tf"))
    weighed = terms.join(F.broadcast(hits), "token", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    none = F.array(F.struct(F.lit(-1).alias("template"), F.lit("").alias("license"), F.col("w").alias("weight")))
    shares = weighed.select("path", "hash", "line", "view", "w", F.explode(F.concat(none, F.coalesce("hits", F.array().cast("array<struct<template:int,license:string,weight:double>>")))).alias("t"))
    sums = shares.groupBy("path", "hash", "line", "view", "t.template", "t.license").agg(F.sum(F.col("w") * F.col("t.weight")).alias("dot"))
    length = F.sqrt(F.max(F.when(F.col("template") < 0, F.col("dot"))))
    cosines = sums.groupBy("path", "hash", "line", "view").agg(length.alias("length"), F.collect_list(F.when(F.col("template") >= 0, F.struct("dot", "template", "license"))).alias("all"))
    best = F.array_max(F.transform("all", lambda x: F.struct(F.round(x["dot"] / F.col("length"), DIGITS).alias("score"), (-F.col("line")).alias("line"), (-x["template"]).alias("template"), x["license"].alias("license"))))
    enough = cosines.select("path", "hash", best.alias("best")).where(F.col("best.score") >= LEAST_COSINE)
    found = enough.groupBy("path", "hash").agg(F.max("best").alias("top"), F.collect_list(F.when(whole, F.col("best"))).alias("all"))
    good = F.filter("all", lambda x: x["score"] >= F.col("top.score") - ABOUT)
    # Lines are negative here. The best from the first of these to a window behind it, as that may cut a licence in two.
    near = F.filter(good, lambda x: x["line"] >= F.array_max(F.transform(good, lambda y: y["line"])) - WINDOW)
    placed = found.select("path", "hash", "top", near.alias("near")).withColumn("first", F.array_max("near"))
    longer = lambda x: reduce(lambda a, b: a | b, ((F.col("first.license") == short) & x["license"].isin(more) for short, more in EXTENDS.items()))
    for _ in EXTENDS:
        placed = placed.withColumn("first", F.coalesce(F.array_max(F.filter("near", longer)), "first"))
    return placed.select("path", "hash", F.when(whole, F.col("first.license")).otherwise(F.col("top.license")).alias("license"), F.when(whole, F.col("first.score")).otherwise(F.col("top.score")).alias("score"))


def parent(path: Column) -> Column:
    """The directory of a path, '' at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(files: DataFrame, path: Column | str = "path", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, path, license, score, origin) for each row of files.

    origin is `file` for a licence file, `header`, `inherited` or `none`. A licence file's licence holds for its directory
    and those below, unless they have a licence file of their own; of several in a directory the best score counts, then the
    first by path. Only the named columns are read. A null or empty text has no headers; a null path is a file at the top
    without a name, which inherits from there; repeated rows each return a row; ties go to the earlier line, then template. No
    rows give no rows.
    """
    path = F.col(path) if isinstance(path, str) else path
    read = files.select(F.col(doc_id).alias("doc_id"), F.coalesce(path, F.lit("")).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    # Checkpoints: each is used twice or meets rows of which many can share a key, which Spark then can split.
    best = cut(matches(read))
    held = best.where(F.col("path").rlike(LICENCE_FILE)).groupBy(parent(F.col("path")).alias("above")).agg(F.max_by(F.struct("license", "score"), F.struct("score", F.col("license"))).alias("given"))
    held = cut(held)
    # Distinct directories, each with its ancestors, meet the directories that hold a licence; the longest ancestor wins.
    folders = read.select(parent(F.col("path")).alias("folder")).distinct()
    steps = F.split("folder", "/")
    ancestors = F.concat(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")), F.array(F.lit("")))
    nearest = cut(folders.select("folder", F.explode(F.array_distinct(ancestors)).alias("above")).join(held, "above").groupBy("folder").agg(F.max_by("given", F.length("above")).alias("given")))
    own = read.select("doc_id", "path", "hash", parent(F.col("path")).alias("folder"))
    rows = own.join(best, ["path", "hash"], "left").join(nearest, "folder", "left")
    origin = F.when(F.col("license").isNotNull() & F.col("path").rlike(LICENCE_FILE), "file").when(F.col("license").isNotNull(), "header").when(F.col("given").isNotNull(), "inherited").otherwise("none")
    return rows.select("doc_id", "path", F.coalesce("license", "given.license").alias("license"), F.coalesce("score", "given.score").alias("score"), origin.alias("origin"))


def document_path() -> Column:
    """The documents table has no paths. They are laid out as a tree, so that the whole operator runs on it: document 1234 of a
    source and language is the file <source>/<lang>/12/1234.txt, and each hundredth document the LICENSE of its directory."""
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    folder = F.coalesce(F.floor(F.col("doc_id") / 100).cast("string"), F.lit("none"))
    return F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), folder, F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(F.concat(number, F.lit(".txt"))))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), document_path())


_values = ", ".join("({}, '{}', '{}')".format(i, x, t.replace("'", "''")) for i, (x, t) in enumerate(TEMPLATES))
_longer = ", ".join(f"('{a}', '{b}')" for a, more in EXTENDS.items() for b in more)
OP8_SQL = rf"""
WITH listed(template, license, text) AS (VALUES {_values}),
tt AS (SELECT template, license, token, count(*) AS tf FROM (SELECT template, license, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS token FROM listed) GROUP BY ALL),
idf AS (SELECT token, ln({1.0 + len(TEMPLATES)} / (1.0 + count(*))) + 1.0 AS idf FROM tt GROUP BY token),
tw AS (SELECT template, license, token, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS weight FROM tt JOIN idf USING (token)),
d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines, coalesce(doc_id % 2 = 0, false) AS whole,
    concat_ws('/', coalesce(source, 'unknown'), coalesce(lang, 'unknown'), coalesce(CAST(CAST(floor(doc_id / 100) AS BIGINT) AS VARCHAR), 'none')) AS folder
  FROM documents),
w AS (SELECT doc_id, text, list_filter(lines, lambda x: regexp_matches(x, '\S')) AS said FROM d WHERE whole AND regexp_matches(text, '{MENTION}')),
mentions AS (SELECT doc_id, lines, line FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS line FROM d WHERE NOT whole AND regexp_matches(text, '{MENTION}')) WHERE regexp_matches(lines[line + 1], '{MENTION}')),
h AS (
  SELECT doc_id, line, 1 AS view, lines[line + 1] AS header FROM mentions
  UNION ALL SELECT doc_id, line, 2, array_to_string(lines[greatest(line - {BEFORE}, 0) + 1 : line + 1 + {BEHIND}], ' ') FROM mentions
  UNION ALL SELECT doc_id, -1, 3, array_to_string(said[1 : {OPENING}], ' ') FROM w
  UNION ALL SELECT doc_id, -2, 4, replace(text, chr(10), ' ') FROM w WHERE length(text) <= {WHOLE}
  UNION ALL SELECT * FROM (SELECT doc_id, line, n, array_to_string(said[line + 1 : line + n], ' ') AS header FROM (SELECT doc_id, said, n, unnest(range(0, greatest(len(said), 1), {STEP})) AS line FROM w, (VALUES {", ".join(f"({n})" for n in WINDOWS)}) t(n))) WHERE regexp_matches(header, '{MENTION}')),
dt AS (SELECT doc_id, line, view, token, count(*) AS tf FROM (SELECT doc_id, line, view, unnest(regexp_extract_all(lower(header), '{TOKEN}')) AS token FROM h) GROUP BY ALL),
dw AS (SELECT doc_id, line, view, token, tf * coalesce(idf, ln({1.0 + len(TEMPLATES)}) + 1.0) AS w FROM dt LEFT JOIN idf USING (token)),
len AS (SELECT doc_id, line, view, sqrt(sum(w * w)) AS length FROM dw GROUP BY ALL),
cos AS (SELECT doc_id, line, view, template, license, round(sum(w * weight) / any_value(length), {DIGITS}) AS score FROM dw JOIN tw USING (token) JOIN len USING (doc_id, line, view) GROUP BY doc_id, line, view, template, license),
each AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, line, view ORDER BY score DESC, template) AS k FROM cos WHERE score >= {LEAST_COSINE}) WHERE k = 1),
good AS (SELECT doc_id, line, template, license, score, whole, min(line) OVER (PARTITION BY doc_id) AS first
  FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS top FROM each) JOIN d USING (doc_id) WHERE score >= top - {ABOUT} OR NOT whole),
near AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY score DESC, line, template) AS of_license, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line, template) AS of_all FROM good WHERE line <= first + {WINDOW} OR NOT whole),
ext(short, more) AS (VALUES {_longer}),
b1 AS (SELECT * FROM near WHERE of_all = 1),
b2 AS (SELECT * FROM (SELECT n.*, row_number() OVER (PARTITION BY n.doc_id ORDER BY n.score DESC, n.line, n.template) AS i FROM b1 JOIN ext ON short = b1.license JOIN near n ON n.doc_id = b1.doc_id AND n.license = more AND n.whole) WHERE i = 1),
c2 AS (SELECT doc_id, license, score FROM b2 UNION ALL SELECT doc_id, license, score FROM b1 WHERE doc_id NOT IN (SELECT doc_id FROM b2)),
b3 AS (SELECT * FROM (SELECT n.*, row_number() OVER (PARTITION BY n.doc_id ORDER BY n.score DESC, n.line, n.template) AS i FROM c2 JOIN ext ON short = c2.license JOIN near n ON n.doc_id = c2.doc_id AND n.license = more AND n.whole) WHERE i = 1),
best AS (SELECT doc_id, license, score FROM b3 UNION ALL SELECT doc_id, license, score FROM c2 WHERE doc_id NOT IN (SELECT doc_id FROM b3)),
given AS (SELECT folder, license, score FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY score DESC, license DESC) AS k FROM best JOIN d USING (doc_id) WHERE whole) WHERE k = 1)
SELECT d.doc_id, d.folder || '/' || CASE WHEN whole THEN 'LICENSE-' || d.doc_id ELSE coalesce(CAST(d.doc_id AS VARCHAR), 'none') || '.txt' END AS path,
  coalesce(best.license, given.license) AS license, coalesce(best.score, given.score) AS score,
  CASE WHEN best.license IS NOT NULL AND whole THEN 'file' WHEN best.license IS NOT NULL THEN 'header' WHEN given.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN given ON d.folder = given.folder
"""
