"""Licence scan: canonical digests of texts joined with digests of known licences.

Whole texts, their paragraphs and their lines are brought to a canonical form
(lower case, copyright lines gone, punctuation to blanks, equivalent spellings
to one) and hashed; the digests are joined with those of the known texts, which
go through the same expression. The known table is a constant of this module
(a few hundred rows at most), so it is broadcast before anything is shuffled;
only hits are grouped by document. The paragraphs of each full text are known too: a
text all of whose paragraphs occur in a document, in whatever surroundings, is found.
Full texts of AGPL-3.0 and of the CC BY licences are not known, only their statements.

Null text has no units. Repeated rows are reported each. Extra columns are
ignored. Several licences in a text are listed in order of their names.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (identifier, spellings of its name) and statements around a name.
NAMES = (
    ("MIT", ("MIT License", "MIT")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "LGPL-3.0")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "AGPL-3.0")),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "MPL-2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "BSD-2-Clause")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "BSD-3-Clause")),
    ("ISC", ("ISC License", "ISC")),
    ("CC0-1.0", ("CC0 1.0", "CC0-1.0")),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0 International License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License")),
)
STATEMENTS = ("{}", "Released under {}.", "Licensed under {}.", "This work is licensed under {}.", "Distributed under {}.",
              "This software is licensed under {}.", "Available under {}.", "SPDX-License-Identifier: {}")
TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
)
# Notices that authors are told to put on their files, each one paragraph.
GNU = """This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1}General
Public License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any
later version."""
NOTICES = (
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("GPL-2.0", GNU.format(";", "", "2")), ("GPL-3.0", GNU.format(":", "", "3")),
    ("LGPL-3.0", GNU.format(":", "Lesser ", "3")), ("AGPL-3.0", GNU.format(":", "Affero ", "3")),
)
PARAGRAPH = r"\n[ \t]*(?://+|/?\*+/?|[#;]+|--)?[ \t]*\n\s*"  # between two paragraphs, also of a comment
# A line that opens with the word but goes on with a licence's sentence is no copyright line.
OWN_LINE = (r"(?m)^[ \t]*(?:copyright(?![ \t]+(?:holders?|owners?|notices?|laws?|licen[sc]es?|interests?|and|or|to|in)\b)"
            r"|\(c\)|©)[^\n]*$")
COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©)[^\n]*$"
# (pattern, replacement) on lower-case words between single blanks.
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
             ("non commercial", "noncommercial"), (" v([0-9])", " version $1"), ("(version [0-9]) 0 ", "$1 "),
             (" under the ", " under "))


def canonical(text: Column) -> Column:
    c = F.regexp_replace(F.lower(text), OWN_LINE, " ")
    c = F.concat(F.lit(" "), F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for pattern, to in SPELLINGS:
        c = F.regexp_replace(c, pattern, to)
    return F.trim(c)


def known_rows() -> list[tuple[str, str]]:
    rows = [(i, s.format(n)) for i, names in NAMES for n in names for s in STATEMENTS]
    return rows + [(i, t) for i, t in TEXTS]


def full_texts() -> list[tuple[str, list[str]]]:
    """(license, paragraphs) of every full text, up to the end of its terms."""
    out = [(i, re.split(r"\n(?=The above copyright|THE SOFTWARE IS)", t)) for i, t in TEXTS]
    for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        terms = re.split(r"(?m)^\s*END OF TERMS AND CONDITIONS", f.read_text("utf-8"))[0]
        out.append((f.stem, re.split(r"\n\s*\n\s*", terms.strip())))
    three = dict(out)["BSD-3-Clause"]
    out.append(("BSD-2-Clause", [p for p in three if not p.startswith("3.")]))
    return out + [(i, [re.sub(r"^[0-9]\. ", "", p) for p in t]) for i, t in out if i.startswith("BSD")]


def all_rows() -> list[tuple[str, str]]:
    """The known rows, notices, and full texts with and without a title."""
    titles = {i: [x for n in names for x in (n, f"The {n}", f"{n} ({i})", f"The {n} ({i})")] for i, names in NAMES}
    full = [(i, "\n\n".join(t)) for i, t in full_texts()]
    files = [(f.stem, f.read_text("utf-8")) for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    return [*known_rows(), *NOTICES, *full, *files, *[(i, f"{n}\n{t}") for i, t in full for n in titles[i]]]


def known(spark: SparkSession, rows=None) -> DataFrame:
    """digest, license, of, n: known texts, one row per digest, of and n null; and each
    paragraph of the full text ``of``, which has n of them. A notice of the writer's own
    copyright and address is not asked for."""
    table = spark.createDataFrame(rows or all_rows(), "license string, text string")
    whole = (table.select(F.md5(canonical(F.col("text"))).alias("digest"), "license")
             .groupBy("digest").agg(F.min("license").alias("license"))
             .select("digest", "license", F.lit(None).cast("int").alias("of"), F.lit(None).cast("long").alias("n")))
    if rows:
        return whole
    parts = [(k, i, p) for k, (i, t) in enumerate(full_texts()) for p in t if "Copyright (C)" not in p]
    parts = (spark.createDataFrame(parts, "of int, license string, text string")
             .withColumn("text", canonical(F.col("text"))).where("text <> ''")
             .select("of", "license", F.md5("text").alias("digest")).distinct())
    n = parts.groupBy("of").agg(F.count("*").alias("n"))
    return whole.unionByName(parts.join(n, "of").select("digest", "license", "of", "n"))


def _complete(parts: Column) -> Column:
    """Licenses of the full texts all of whose paragraphs are there; a text that holds
    another one hides it."""
    texts = F.array_distinct(F.transform(parts, lambda p: F.struct(p.of.alias("of"), p.license.alias("license"), p.n.alias("n"))))
    names = F.array_distinct(F.transform(F.filter(texts, lambda t: F.size(F.filter(parts, lambda p: p.of == t.of)) == t.n),
                                         lambda t: t.license))
    return F.when(F.array_contains(names, "BSD-3-Clause"), F.array_remove(names, "BSD-2-Clause")).otherwise(names)


def scan(docs: DataFrame, key: str = "doc_id", rows=None) -> DataFrame:
    """key, n_units, n_found, whole (the entire text is a licence), licenses."""
    src = docs.select(F.col(f"`{key}`").alias(key), F.coalesce("text", F.lit("")).alias("text"))
    row = F.xxhash64(key, "text")
    units = src.select(key, row.alias("h"), F.explode(F.concat(
        F.array(F.struct(F.lit("whole").alias("kind"), F.col("text").alias("unit"))),
        F.transform(F.filter(F.split("text", PARAGRAPH), lambda u: u.contains("\n")),
                    lambda u: F.struct(F.lit("paragraph").alias("kind"), u.alias("unit"))),
        F.transform(F.split("text", "\n"), lambda u: F.struct(F.lit("line").alias("kind"), u.alias("unit"))))).alias("u"))
    digests = units.select(key, "h", "u.kind", F.md5(canonical(F.col("u.unit"))).alias("digest"))
    hits = digests.join(F.broadcast(known(docs.sparkSession, rows)), "digest")
    # Repeated rows have the same key and hash: their hits are counted once.
    found = (hits.groupBy(key, "h").agg(
        F.collect_set(F.when(F.col("of").isNull(), F.col("license"))).alias("stated"),
        F.collect_set(F.when(F.col("of").isNotNull(), F.struct("of", "license", "n", "digest"))).alias("parts"),
        F.count_if((F.col("kind") == "line") & F.col("of").isNull()).alias("lines"),
        F.max((F.col("kind") == "whole") & F.col("of").isNull()).alias("whole"))
        .withColumn("licenses", F.sort_array(F.array_union("stated", _complete(F.col("parts")))))
        .select(F.col(key).alias("k"), F.col("h").alias("hh"), "licenses", "lines", "whole"))
    copies = src.select(key, row.alias("h"), F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    n = copies.groupBy(key, "h", "n_lines").agg(F.count("*").alias("copies"))
    return (n.join(found, F.col(key).eqNullSafe(F.col("k")) & (F.col("h") == F.col("hh")), "left")
            .withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(key, "n_lines", (F.coalesce("lines", F.lit(0)) / F.col("copies")).cast("long").alias("n_found"),
                    F.coalesce("whole", F.lit(False)).alias("whole"),
                    F.coalesce(F.array_join("licenses", ","), F.lit("")).alias("licenses")))


def _oracle() -> str:
    def canon(t):
        c = f"regexp_replace(lower({t}), '{COPYRIGHT_LINE}', ' ', 'g')"
        c = rf"' ' || regexp_replace({c}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
        for p, to in SPELLINGS:
            c = f"regexp_replace({c}, '{p}', '{to.replace('$', chr(92))}', 'g')"
        return f"trim({c})"

    rows = ",\n".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in known_rows())
    return rf"""
WITH known AS MATERIALIZED (SELECT md5({canon('t')}) AS digest, min(l) AS license FROM (VALUES {rows}) v(l, t) GROUP BY 1),
d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT doc_id, 'whole' AS kind, text AS unit FROM d
  UNION ALL SELECT doc_id, 'paragraph', p FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \t]*\n\s*')) AS p FROM d) WHERE contains(p, chr(10))
  UNION ALL SELECT doc_id, 'line', unnest(string_split(text, chr(10))) FROM d),
hit AS (SELECT doc_id, kind, license FROM (SELECT doc_id, kind, md5({canon('unit')}) AS digest FROM u) JOIN known USING (digest)),
f AS (SELECT doc_id, count(*) FILTER (kind = 'line') AS n_found, bool_or(kind = 'whole') AS whole,
      string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM hit GROUP BY doc_id)
SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS n_lines, coalesce(n_found, 0)::BIGINT AS n_found,
       coalesce(whole, false) AS whole, coalesce(licenses, '') AS licenses FROM d LEFT JOIN f USING (doc_id)"""


ORACLE = _oracle()
