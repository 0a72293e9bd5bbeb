"""License scans by TF-IDF cosine and directory inheritance (operator 1), native.

Three kinds of units are compared with the templates: each line that carries a licence word; each
header window, that is one to five paragraphs in a row of which the first carries one, so that wrapped
notices are read whole; and the whole text of a licence file (LICENSE, COPYING, ...).
A unit's sparse TF-IDF vector meets those of the templates by joins on terms; the nearest template
above a threshold names the licence, and a file takes its best unit's.  Document
frequencies are counted over all files.

A notice in a licence file (LICENSE, COPYING, ...) also holds for the directory: a file
without a notice of its own takes the licence of its nearest ancestor directory that
has one.  That is worked out once per directory, by joining each directory's ancestor
paths with the licensed ones.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import cut, row_key, text_or_empty

# Notices as their licences or common practice word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
]
# Whole headers and texts, as the licences word them.
_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
              "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
              "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
              "and/or other materials provided with the distribution. ")
_BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
              "without specific prior written permission. ")
_BSD_WARRANTY = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
                 "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
                 "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
                 "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
                 "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_WARRANTY = ("is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
             "PARTICULAR PURPOSE. See the")
_FREE = "is free software; you can redistribute it and/or modify it under the terms of the"
_BY = "as published by the Free Software Foundation; either version"
_LATER = "of the License, or (at your option) any later version."


def _gnu(kind: str, what: str, version: str) -> str:
    return f"This {what} {_FREE} GNU {kind} {_BY} {version} {_LATER}"


TEMPLATES += [
    ("BSD-2-Clause", _BSD_GRANT), ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_NAMES), ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES), ("BSD-3-Clause", _BSD_GRANT + _BSD_NAMES + _BSD_WARRANTY),
    ("MIT", "MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
            "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
            "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
            "and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
                "at https://mozilla.org/MPL/2.0/."),
    *[(name, text) for name, kind, what, version in (("GPL-2.0", "General Public License", "program", "2"), ("GPL-3.0", "General Public License", "program", "3"),
                                                    ("LGPL-2.1", "Lesser General Public License", "library", "2.1"), ("LGPL-3.0", "Lesser General Public License", "library", "3"),
                                                    ("AGPL-3.0", "Affero General Public License", "program", "3"))
      for text in (_gnu(kind, what, version), f"{_gnu(kind, what, version)} This {what} {_WARRANTY} GNU {kind} for more details.")],
]
# A line is a candidate notice if it contains one of these; names of licence files.
STEMS = ["licens", "licence", "copyright", "permission", "redistribut", "free software", "public domain", "waived"]
FILE_NAMES = r"(?i)^(un)?(licen[sc]e|copying|copyright|notice)([._-].*)?$"

THRESHOLD = 0.6
#: Paragraphs of a header window at most; the longest header templates, a BSD grant with its clauses and disclaimer, have five.
WINDOW = 5
#: Stands for a line without letters or digits, which ends a paragraph.
_GAP = "\u0001"


def terms_of(text: Column) -> Column:
    """Lower-case runs of letters a-z and digits."""
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def is_candidate(text: Column) -> Column:
    low = F.lower(text)
    hit = F.lit(False)
    for stem in STEMS:
        hit = hit | F.contains(low, F.lit(stem))
    return hit


def template_terms(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``(template, license, term, tf)``, a few hundred rows."""
    t = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, body string")
    return t.select("template", "license", F.explode(terms_of(F.col("body"))).alias("term")).groupBy("template", "license", "term").agg(F.count(F.lit(1)).alias("tf"))


def weights(files: DataFrame, vocabulary: list[str], text_col: str) -> tuple[dict[str, float], float]:
    """The inverse document frequency of each template term over all files, and that of a term no file has.

    What reaches the driver is one count per template term.
    """
    some = F.array_intersect(terms_of(text_or_empty(text_col)), F.array(*map(F.lit, vocabulary)))
    seen = files.select(F.explode(F.concat(some, F.array(F.lit("")))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = {r.term: r.df for r in seen.collect()}
    n = df.get("", 0)
    return {t: log((n + 1) / (df.get(t, 0) + 1)) + 1 for t in vocabulary}, log(n + 1) + 1


def paragraphs(text: Column) -> Column:
    """Runs of lines that hold letters or digits; comment marks alone on a line end one."""
    marked = F.transform(F.split(text, "\n"), lambda x: F.when(x.rlike(r"[\p{L}\p{N}]"), x).otherwise(_GAP))
    return F.filter(F.split(F.array_join(marked, "\n"), _GAP), lambda x: F.btrim(x, F.lit("\n")) != "")


def units(files: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """``(path, row, unit, pos, size, body)``: what is compared with the templates.

    ``unit`` is 0 for a line, 1 for a window of ``size`` paragraphs (those of more than one line) and 2 for
    a licence file's whole text; ``pos`` is the line's or first paragraph's place.
    """
    text = text_or_empty(text_col)
    some = files.filter(is_candidate(text)).select(F.col(path_col).alias("path"), row_key(text_col).alias("row"), text.alias("text")).dropDuplicates(["path", "row"])
    line = some.select("path", "row", F.lit(0).alias("unit"), F.posexplode(F.split("text", "\n")).alias("pos", "body")).filter(is_candidate(F.col("body")))
    para = some.select("path", "row", paragraphs(F.col("text")).alias("p"))
    first = F.filter(F.transform("p", lambda x, i: F.when(is_candidate(x), i)), lambda i: i.isNotNull())
    start = para.select("path", "row", "p", F.explode(first).alias("pos"))
    wide = start.select("path", "row", "pos", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(WINDOW), F.size("p") - F.col("pos"))),
                        lambda w: F.struct(w.alias("size"), F.btrim(F.array_join(F.slice("p", F.col("pos") + 1, w), "\n"), F.lit("\n")).alias("body")))).alias("w"))
    window = wide.select("path", "row", F.lit(1).alias("unit"), "pos", "w.size", "w.body").filter(F.contains("body", F.lit("\n")))
    whole = some.filter(F.regexp_extract("path", "[^/]*$", 0).rlike(FILE_NAMES)).select(
        "path", "row", F.lit(2).alias("unit"), F.lit(0).alias("pos"), F.lit(1).alias("size"), F.col("text").alias("body"))
    return line.select("path", "row", "unit", "pos", F.lit(1).alias("size"), "body").unionByName(window).unionByName(whole)


def notices(files: DataFrame, path_col: str = "path", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(path, row, unit, pos, size, license, score)`` of each unit that is a licence notice; ``row`` is the text's hash.

    Of templates with equal scores the licence whose name is least counts.
    """
    spark = files.sparkSession
    terms = template_terms(spark, templates)
    idf, rare = weights(files, sorted(r.term for r in terms.select("term").distinct().collect()), text_col)
    known = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    at = ["path", "row", "unit", "pos", "size"]
    line = units(files, path_col, text_col)
    tf = line.select(*at, F.explode(terms_of(F.col("body"))).alias("term")).groupBy(*at, "term").agg(F.count(F.lit(1)).alias("tf"))
    vec = (tf.join(F.broadcast(known), "term", "left")
           .select(*at, "term", (F.col("tf") * F.coalesce("idf", F.lit(rare))).alias("w"), F.col("idf").isNotNull().alias("in")))
    sizes = terms.join(known, "term").select("template", "license", "term", (F.col("tf") * F.col("idf")).alias("v"))
    norm = sizes.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    goal = sizes.join(norm, "template").groupBy("term").agg(F.collect_list(F.struct("template", "license", (F.col("v") / F.col("norm")).alias("v"))).alias("goals"))
    # a term meets its templates as one row; the squared length goes along as a template of its own
    both = vec.join(F.broadcast(goal), "term", "left").select(*at, "w", F.explode(F.concat(
        F.array(F.struct(F.lit(-1).alias("template"), F.lit(None).cast("string").alias("license"), F.col("w").alias("v"))),
        F.coalesce("goals", F.array().cast("array<struct<template:int,license:string,v:double>>")))).alias("g"))
    dot = both.groupBy(*at, F.col("g.template").alias("template"), F.col("g.license").alias("license")).agg(F.sum(F.col("w") * F.col("g.v")).alias("dot"))
    one = dot.groupBy(*at).agg(F.sqrt(F.max(F.when(F.col("template") < 0, F.col("dot")))).alias("length"),
                               F.collect_list(F.when(F.col("template") >= 0, F.struct("dot", "license"))).alias("dots"))
    score = F.transform("dots", lambda d: F.struct((-F.round(d["dot"] / F.col("length"), 6)).alias("s"), d["license"].alias("license")))
    return (one.select(*at, F.array_min(score).alias("b")).filter("b is not null")
            .select(*at, F.col("b.license").alias("license"), (-F.col("b.s")).alias("score")).filter(F.col("score") >= threshold))


def parent(path: Column) -> Column:
    """The directory of a path; the root is empty."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per file: ``path, row, own, score, license, source``.

    ``own`` is the licence of the best unit in the file (then the least name), ``license`` that
    or the inherited one, and ``source`` the directory it is inherited from (null for an
    own licence or none).  Two licence files of one directory: the better score holds.  Null
    and empty texts have no notice, null paths no directory; rows repeating path and text
    give repeated results; an empty table gives no rows.
    """
    found = cut(notices(files, path_col, text_col, templates, threshold))
    pick = F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")
    own = found.groupBy("path", "row").agg(pick).select(F.col("path").alias("p"), F.col("row").alias("r"), F.col("b.license").alias("own"), (-F.col("b.s")).alias("score"))
    own = cut(own)
    name = F.regexp_extract("p", "[^/]*$", 0)
    licensed = (own.filter(name.rlike(FILE_NAMES)).withColumn("dir", parent(F.col("p"))).withColumnRenamed("own", "license")
                .groupBy("dir").agg(pick).select("dir", F.col("b.license").alias("license")))
    base = files.select(F.col(path_col).alias("path"), row_key(text_col).alias("row"), parent(F.col(path_col)).alias("dir"))
    dirs = base.filter("path is not null").select("dir").distinct()
    # the ancestors of a directory, itself first: its path less 0, 1, 2, ... names, and the root
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.size(parts), F.lit(0)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    chain = dirs.select("dir", F.posexplode(F.array_distinct(up)).alias("far", "above"))
    near = (chain.join(licensed.withColumnRenamed("dir", "above"), "above").groupBy("dir").agg(F.min(F.struct("far", "above", "license")).alias("n"))
            .select(F.col("dir").alias("d"), F.col("n.above").alias("above"), F.col("n.license").alias("given")))
    with_own = base.join(own, base["path"].eqNullSafe(own["p"]) & (base["row"] == own["r"]), "left")
    both = with_own.join(near, with_own["dir"] == near["d"], "left")
    return both.select("path", "row", "own", "score", F.coalesce("own", "given").alias("license"), F.when(F.col("own").isNull(), F.col("above")).alias("source"))
