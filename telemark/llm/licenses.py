"""Licence scan: sparse TF-IDF cosine to templates, then inheritance along directories.

Units of a text are its sentences with a licence cue, line by line; its blocks: the
paragraphs (between blank lines, comment marks taken off), their sentences with single line
breaks joined, and the leading comment as a whole; and the whole text of a licence file.
Paragraphs and leading comments need a cue of BLOCK_CUE, which every template has; licence
files need none. Sentences are compared with short notices, blocks and files also with
licence headers and full licence texts (license_texts/).

Units and templates are sparse TF-IDF vectors (words: lower-cased runs of letters, digits
and dots inside them); document frequencies are counted over the distinct sentences with a
cue. In blocks and files a term counts 1 + ln(its count), for else the common words of any
long text would make it like a long licence. A unit's licence is the template of the greatest cosine (ties: the smaller name), a
document's that of its best unit, if the cosine is at least MIN_COSINE. An
SPDX-License-Identifier tag names its licence itself, as written, with cosine 1. "All rights
reserved" stands in many free licences too, so PROPRIETARY only counts beside nothing else.

A file without its own licence inherits that of the licence file (named LICENSE, COPYING
or NOTICE, any extension) in its own directory or the nearest one above it.

Equal units of many documents are one row: scoring works on distinct units and is joined
back by checked size, or salted, so a notice that a third of all documents share is no hot
key. Ancestors are listed for distinct directories only, not per file. Two licence files
of one directory: the smaller id counts.

Null, empty texts and texts without cue have no own licence, and may inherit. A null path
has no directory and inherits nothing. Repeated rows are reported each.
"""
from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.llm.tables import stored
from telemark.operators.joins import attach

MIN_COSINE = 0.6
CUE = r"(?i)licen[sc]|copyright|public domain|permission|redistribut|rights reserved|creative commons"
_SENTENCE = r"\n+|(?<=[.!?])\s+"
BLOCK_CUE = CUE + r"|free software|open source|\bgpl|warrant(?:y|ies)\b|spdx"
LICENCE_FILE = r"(?i)^(license|licence|copying|notice)(\..*)?$"
PROPRIETARY = "Proprietary"
_SPDX = r"(?i)SPDX-License-Identifier:[ \t]*(\(?[a-z0-9.+:-]+\)?(?:[ \t]+(?:OR|AND|WITH)[ \t]+\(?[a-z0-9.+:-]+\)?)*)"
# Lazy runs of single characters: Java's matcher would recurse once per line of a repeated group.
_COMMENT = (r"^\s*(?:/\*[\s\S]*?(?:\*/|\z)|<!--[\s\S]*?(?:-->|\z)|\"\"\"[\s\S]*?(?:\"\"\"|\z)"
            r"|(?://|#|;|--|%)[\s\S]*?(?=\n[ \t]*(?!//|#|;|--|%)\S|\z))")
_MARKS = r"(?m)^[ \t]*(?:/\*+|\*+/|\*+|//+|#+|;+|--+|%+|<!--)|(?:\*/|-->)[ \t]*$"

# Fixed texts: short notices by which licences are usually declared.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (PROPRIETARY, "All rights reserved."),
]

# Headers as licences ask for them; _gnu() writes those of the GNU licences.
_WARRANTY = ("is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
             "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details.")


def _gnu(name: str, title: str, version: str) -> list[tuple[str, str]]:
    out = []
    for what in ("This program", "This library"):
        grant = (f"{what} is free software{{}} you can redistribute it and/or modify it under the terms of the GNU {title} as published by "
                 f"the Free Software Foundation{{}} version {version} of the License, or (at your option) any later version.")
        grant = grant.format(":" if version == "3" else ";", ", either" if version == "3" else "; either")
        copy = f"You should have received a copy of the GNU {title} along with {what.lower()}. If not, see https://www.gnu.org/licenses/."
        out += [(name, grant), (name, f"{grant} {what} {_WARRANTY.format(title)} {copy}")]
    return [*out, (name, f"GNU {title} Version {version}")]


HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
     "agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
     "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *_gnu("GPL-2.0", "General Public License", "2"),
    *_gnu("GPL-3.0", "General Public License", "3"),
    *_gnu("LGPL-2.1", "Lesser General Public License", "2.1"),
    *_gnu("LGPL-3.0", "Lesser General Public License", "3"),
    *((f"CC-BY{short}-4.0", text.format(long)) for short, long in (("", ""), ("-NC", "-NonCommercial"), ("-SA", "-ShareAlike")) for text in (
        "This work is licensed under a Creative Commons Attribution{} 4.0 International License.",
        "Creative Commons Attribution{} 4.0 International Public License")),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"),
    (PROPRIETARY, "Copyright (c). All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited. "
     "Proprietary and confidential."),
]


def texts() -> list[tuple[str, str]]:
    """The full licence texts, and the grants of MIT and ISC, which stand alone in headers."""
    full = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    grants = [(n, part) for n, t in full if n in ("MIT", "ISC") for part in t.split("\n\n")[1:2]]
    return full + grants


def terms(text):
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*)"), 1)


def term_counts(units: DataFrame) -> DataFrame:
    """(unit, term, tf) of distinct (unit, body)."""
    return stored(units.select("unit", F.explode(terms("body")).alias("term")).groupBy("unit", "term").agg(
        F.count("*").alias("tf")), "unit-terms")


def scored_units(split: DataFrame, templates: DataFrame, idf: DataFrame, total: int, damped: bool = False) -> DataFrame:
    """(unit, license, cosine): the best template of every unit of `split` (unit, term, tf).
    `idf` (term, idf) of a corpus of `total` units. `damped`: a term counts 1 + ln(tf)."""
    tf = F.log("tf") + 1.0 if damped else F.col("tf")
    known = templates.select("license", F.md5("text").alias("text"), F.explode(terms("text")).alias("term")).groupBy(
        "license", "text", "term").agg(F.count("*").alias("tf"))
    unseen = F.log(F.lit(1.0) + total) + 1.0
    weighted = stored(known.join(idf, "term", "left").withColumn("w", tf * F.coalesce("idf", unseen)), "templates")
    norms = weighted.groupBy("license", "text").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("template_norm"))
    vectors = stored(weighted.join(norms, ["license", "text"]).select(
        "license", "text", "term", (F.col("w") / F.col("template_norm")).alias("v")), "template-vectors")
    mine = attach(split, idf, "term", "left").select("unit", "term", (tf * F.coalesce("idf", unseen)).alias("u"))
    lengths = mine.groupBy("unit").agg(F.sqrt(F.sum(F.col("u") * F.col("u"))).alias("unit_norm"))
    dots = attach(mine, vectors, "term", "inner").groupBy("unit", "license", "text").agg(F.sum(F.col("u") * F.col("v")).alias("dot"))
    # Rounded, so that equal cosines stay equal whatever the order of summation.
    cosine = F.round(F.col("dot") / F.col("unit_norm") + 1e-12, 6)
    best = dots.join(lengths, "unit").withColumn("cosine", cosine).groupBy("unit").agg(
        F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("b"))
    return best.select("unit", F.col("b.license").alias("license"), (-F.col("b.far")).alias("cosine"))


def blocks(files: DataFrame) -> DataFrame:
    """(id, path, body): the blocks of every text (see above), line breaks and blanks as one blank."""
    plain = files.withColumn("plain", F.regexp_replace("text", _MARKS, ""))
    paragraphs = F.split("plain", r"\n\s*\n")
    # Sentences that no line break cuts are units already.
    sentences = F.flatten(F.transform(F.filter(paragraphs, lambda p: F.trim(p).contains("\n")), lambda p: F.split(
        F.regexp_replace(p, r"\s+", " "), r"(?<=[.!?])\s+")))
    comment = F.array(F.regexp_replace(F.regexp_extract("text", _COMMENT, 0), _MARKS, ""))
    cued = plain.filter(F.col("text").rlike(BLOCK_CUE)).select(
        "id", "path", F.explode(F.concat(paragraphs, sentences, comment)).alias("body")).filter(F.col("body").rlike(BLOCK_CUE))
    whole = files.filter(is_licence_file("path")).select("id", "path", F.col("text").alias("body"))
    return cued.unionByName(whole).select("id", "path", F.trim(F.regexp_replace("body", r"\s+", " ")).alias("body")).filter("body <> ''")


def is_licence_file(path: str):
    return F.element_at(F.split(path, "/"), -1).rlike(LICENCE_FILE)


def scan(files: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         path_col: str = "path", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(id, path, own_license, own_cosine, license, license_dir) per row of `files`."""
    slim = files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    cut = slim.filter(F.col("text").rlike(CUE)).select("id", "path", F.explode(F.split("text", _SENTENCE)).alias("unit"))
    found = stored(cut.withColumn("unit", F.trim("unit")).filter(F.col("unit").rlike(CUE)), "units")
    units = stored(found.select("unit").distinct(), "distinct-units")
    total, split = units.count(), term_counts(units.withColumn("body", F.col("unit")))
    idf = stored(split.groupBy("term").agg((F.log((F.lit(1.0) + total) / (F.count("*") + 1.0)) + 1.0).alias("idf")), "idf")
    best = stored(scored_units(split, templates, idf, total).filter(F.col("cosine") >= min_cosine), "scored-units")
    told = attach(found, best, "unit", "inner").select("id", "path", "license", "cosine")
    parts = stored(blocks(slim).withColumn("unit", F.md5("body")), "blocks")
    larger = templates.select("license", "text").unionByName(block_table(files.sparkSession))
    best = stored(scored_units(term_counts(parts.select("unit", "body").dropDuplicates(["unit"])), larger, idf, total, True).filter(
        F.col("cosine") >= min_cosine), "scored-blocks")
    told = told.unionByName(attach(parts.drop("body"), best, "unit", "inner").select("id", "path", "license", "cosine"))
    tags = slim.filter(F.col("text").rlike(_SPDX)).select(
        "id", "path", F.explode(F.regexp_extract_all("text", F.lit(_SPDX), 1)).alias("license"), F.lit(1.0).alias("cosine"))
    own = stored(told.unionByName(tags).groupBy("id", "path").agg(
        F.min(F.struct((F.col("license") == PROPRIETARY).alias("last"), (-F.col("cosine")).alias("far"), "license")).alias("b")).select(
        "id", "path", F.col("b.license").alias("own_license"), (-F.col("b.far")).alias("own_cosine")), "own")
    folder = F.regexp_extract("path", r"(?s)^(.*/)?[^/]*$", 1)
    givers = own.filter(is_licence_file("path")).groupBy(folder.alias("dir")).agg(F.min_by("own_license", F.struct("id", "own_license")).alias("given"))
    folders = slim.filter("path IS NOT NULL").select(folder.alias("dir")).distinct()
    parts = F.split(F.regexp_replace("dir", "/$", ""), "/")
    above = folders.select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))))).alias("up"))
    near = stored(above.join(givers.toDF("up", "given"), "up").groupBy("dir").agg(
        F.max(F.struct(F.length("up").alias("depth"), "up", "given")).alias("n")).select(
        "dir", F.col("n.up").alias("license_dir"), F.col("n.given").alias("given")), "inherited")
    rows = slim.select("id", "path", folder.alias("dir"))
    rows = attach(rows, own.withColumnRenamed("id", "i").withColumnRenamed("path", "p").select(
        F.col("i").alias("id"), F.col("p").alias("path"), "own_license", "own_cosine"), ["id", "path"], "left", salts=1)
    rows = attach(rows, near, "dir", "left")
    return rows.select(
        F.col("id").alias(id_col), "path", "own_license", "own_cosine", F.coalesce("own_license", "given").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("license_dir")).alias("license_dir"))


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def block_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*HEADERS, *texts()], "license string, text string")


def with_paths(docs: DataFrame) -> DataFrame:
    """The documents as files: source/language/hundreds/name; every fiftieth is a licence file."""
    name = F.when(F.col("doc_id") % 50 == 0, F.lit("LICENSE")).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.withColumn("path", F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), name))
