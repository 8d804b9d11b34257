"""Licences of files: sparse TF-IDF cosine of their header lines to templates, then inheritance from the nearest folder.

DataFrame operations only. Every line of every text that has a licence cue is a header and is compared with the notices; its
paragraphs, its leading comment and the whole text are compared with the standard header blocks and the full licence texts,
and an SPDX tag names its licence. A file made up of these is the licence file of its folder, and a file without a header of its own has the licence of
the nearest folder above it that has a licence file. Document frequencies are counted over all texts."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialize, small

#: Notices of public licences and their SPDX identifiers.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause New or Revised License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain, Unlicense."),
)
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_GNU_MORE = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details. You should have received a copy of the GNU {} along with this program. If not, see <https://www.gnu.org/licenses/>."
_GNU_KINDS = (("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3"))
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'
_APACHE_MORE = ' http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
#: Standard header blocks, whole and by the paragraph that tells the licence, and the full texts beside this file.
BLOCKS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + _APACHE_MORE),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    *[(name, _GNU.format(title, n)) for name, title, n in _GNU_KINDS],
    *[(name, _GNU.format(title, n) + _GNU_MORE.format(title, title)) for name, title, n in _GNU_KINDS],
    *[(path.stem, path.read_text()) for path in sorted(Path(__file__).with_name("licenses").glob("*.txt"))],
)
#: What a text must have for its paragraphs and the whole of it to be compared, in lower case; all of BLOCKS have it.
BLOCK_CUE = r"licen[sc]|copyright|free software|public domain"
#: What the whole of it must have besides to be compared with the full texts, all of which have it.
FILE_CUE = r"warrant|liab|lesser[^\p{L}\p{N}]+general"
#: A licence expression in a tag.
SPDX = r"SPDX-License-Identifier:[ \t]*(\(?[A-Za-z0-9][A-Za-z0-9.+-]*\)?(?: (?:AND|OR|WITH) \(?[A-Za-z0-9][A-Za-z0-9.+-]*\)?)*)"
_COMMENT = r"[ \t]*(?:#|//|--|;|%)"
#: Lines that may be notices, in lower case.
CUE = r"licen[sc]|copyright|spdx|public domain|creative commons|\bcc (by|0)|\bcc0\b"
SIMILAR = 0.7
#: Share of a file's words that must stand in notices for it to be a licence file.
FILE_SHARE = 0.5
WORD = r"[\p{L}\p{N}]+"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _templates(spark: SparkSession, of: tuple[tuple[str, str], ...]) -> DataFrame:
    """(template, license, term, tf): a constant."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("template"), F.lit(a).alias("license"), F.lit(b).alias("text")) for i, (a, b) in enumerate(of)]))
    lines = spark.range(1).select(pairs.alias("t")).select("t.template", "t.license", F.explode(_terms(F.col("t.text"))).alias("term"))
    return lines.groupBy("template", "license", "term").agg(F.count("*").alias("tf"))


def _vocabulary(of: tuple[tuple[str, str], ...]) -> list[str]:
    return sorted({t for _, text in of for t in _python_terms(text)})


def _idf(df: Column, n: Column) -> Column:
    return F.log((n + 1) / (df + 1)) + 1


def _frequencies(files: DataFrame) -> DataFrame:
    """(term, idf) of all template terms, by the texts of files that have them."""
    vocabulary = _vocabulary(TEMPLATES + BLOCKS)
    has = F.array_distinct(F.filter(_terms(F.col("text")), lambda t: t.isin(vocabulary)))
    counted = files.select(F.explode(F.concat(has, F.array(F.lit("\u0000all")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))  # a row a vocabulary term
    n = F.coalesce(F.max(F.when(F.col("term") == "\u0000all", F.col("df"))).over(Window.partitionBy()), F.lit(0))
    weights = counted.select("term", "df", n.alias("n")).filter(F.col("term") != "\u0000all")
    weights = files.sparkSession.range(1).select(F.explode(F.split(F.lit(" ".join(vocabulary)), " ")).alias("term")).join(weights, "term", "left")
    total = F.coalesce(F.max("n").over(Window.partitionBy()), F.lit(0))
    return weights.select("term", _idf(F.coalesce("df", F.lit(0)), total).alias("idf"))


def _best(units: DataFrame, of: tuple[tuple[str, str], ...], frequencies: DataFrame) -> DataFrame:
    """(_unit, license, similarity) of the units (_unit, terms) that are similar to a template: the best one.

    A unit's terms that no template has weigh as the mean template term."""
    weights = frequencies.filter(F.col("term").isin(_vocabulary(of))).withColumn("other", F.avg("idf").over(Window.partitionBy()))
    of_template = _templates(units.sparkSession, of).join(weights, "term").withColumn("w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template")))
    of_template = of_template.select("template", "license", "term", "idf", (F.col("w") / length).alias("w"))
    # equal texts are compared once
    own = units.select("_unit", "terms").dropDuplicates(["_unit"]).select("_unit", F.explode("terms").alias("term")).groupBy("_unit", "term").agg(F.count("*").alias("tf"))
    own = own.join(F.broadcast(weights), "term", "left")  # a text without any known term is like no template
    of_unit = Window.partitionBy("_unit")
    own = own.withColumn("w", F.col("tf") * F.coalesce("idf", F.max("other").over(of_unit)))
    # by Cauchy and Schwarz the similarity is at most the known terms' part of the length
    own = own.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(of_unit))).withColumn("known", F.sqrt(F.sum(F.when(F.col("idf").isNotNull(), F.col("w") * F.col("w"))).over(of_unit)))
    own = own.filter(F.col("known") >= (SIMILAR - 1e-6) * F.col("norm"))
    dots = own.select("_unit", "term", "w", "norm").join(F.broadcast(of_template.select("template", "license", "term", F.col("w").alias("tw"))), "term").groupBy("_unit", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.first("norm").alias("norm"))
    scored = dots.select("_unit", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("similarity"))
    best = scored.groupBy("_unit").agg(F.min_by(F.struct("license", "similarity"), F.struct(-F.col("similarity"), "license")).alias("b"))
    return best.filter(F.col("b.similarity") >= SIMILAR).select("_unit", "b.license", "b.similarity")


def headers(files: DataFrame) -> DataFrame:
    """(key, unit, license, similarity, words) of each notice of files (key, text): its best template, if similar.

    unit is `line`, `paragraph`, `comment` (the leading one), `file` or `tag`; units overlap."""
    frequencies = materialize(_frequencies(files), "frequencies")
    lines = files.select("key", F.explode(F.split("text", r"\r?\n")).alias("_text"))
    lines = materialize(lines.filter(F.lower("_text").rlike(CUE)).select("key", F.lit("line").alias("unit"), F.xxhash64("_text").alias("_unit"), _terms(F.col("_text")).alias("terms")), "lines")
    cued = files.filter(F.lower("text").rlike(BLOCK_CUE)).select("key", F.regexp_replace("text", r"\r\n?", "\n").alias("text"))
    # a comment and the code beside it are apart; so are paragraphs, by lines without a word
    apart = F.regexp_replace(F.regexp_replace("text", rf"(?m)^({_COMMENT}.*)\n(?!{_COMMENT})", "$1\n\n"), rf"(?m)^(?!{_COMMENT})(.+)\n(?={_COMMENT})", "$1\n\n")
    paragraphs = F.transform(F.split(apart, r"\n(?:[^\p{L}\p{N}\n]*\n)+"), lambda x: F.struct(F.lit("paragraph").alias("unit"), x.alias("_text")))
    comment = F.regexp_extract("text", rf"\A(?:#!.*\n)?\s*(/\*(?s:.*?)\*/|(?:{_COMMENT}.*(?:\n|\z))+)", 1)
    whole = F.array(F.struct(F.lit("comment").alias("unit"), comment.alias("_text")), F.struct(F.lit("file").alias("unit"), F.col("text").alias("_text")))
    blocks = cued.select("key", F.explode(F.concat(paragraphs, whole)).alias("u")).select("key", "u.*").filter(F.lower("_text").rlike(BLOCK_CUE) & ((F.col("unit") != "file") | F.lower("_text").rlike(FILE_CUE)))
    blocks = materialize(blocks.select("key", "unit", F.xxhash64("_text").alias("_unit"), _terms(F.col("_text")).alias("terms")), "blocks")
    tags = files.filter(F.contains("text", F.lit("SPDX-License-Identifier:"))).select("key", F.explode(F.regexp_extract_all("text", F.lit(SPDX), F.lit(1))).alias("license"))
    tags = tags.select("key", F.lit("tag").alias("unit"), "license", F.lit(1.0).alias("similarity"), (F.size(_terms(F.col("license"))) + 3).alias("words"))
    found = [units.select("key", "unit", "_unit", F.size("terms").alias("words")).join(_best(units, of, frequencies), "_unit").select("key", "unit", "license", "similarity", "words") for units, of in ((lines, TEMPLATES), (blocks, BLOCKS))]
    return found[0].unionByName(found[1]).unionByName(tags)


def _python_terms(text: str) -> list[str]:
    import re

    return re.findall(r"[^\W_]+", text.lower())


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(doc_id, path, license, similarity, via, license_path) of every file.

    via is `header` (a notice in the file), `inherited` (license_path is the licence file of the nearest folder above or at
    the file's) or null. Of several notices the most similar counts, then the first by name; of several licence files of a
    folder the most similar, then the first by path. Null text has no notice; a null path is in no folder; rows that repeat
    an id and path with the same text are one file with several results, the same for each; with other texts they are files
    of their own. An empty table gives an empty result; further
    columns are not looked at."""
    path = F.col(path_col).cast("string")
    base = files.select(F.col(id_col).cast("long").alias("doc_id"), path.alias("path"), F.col(text_col).cast("string").alias("text"))
    key = F.struct("doc_id", "path", F.xxhash64(F.coalesce("text", F.lit(""))).alias("of_text"))
    base = base.withColumn("key", key).withColumn("folder", F.regexp_replace(F.concat(F.lit("/"), F.col("path")), "/[^/]*$", ""))
    found = headers(base.select("key", "text"))
    top = F.min_by(F.struct("license", "similarity"), F.struct(-F.col("similarity"), "license")).alias("h")
    # units of one kind do not overlap; a repeated row brings all its units again
    per_file = found.groupBy("key", "unit").agg(top, F.sum("words").alias("words")).groupBy("key").agg(F.min_by("h", F.struct(-F.col("h.similarity"), "h.license")).alias("h"), F.max("words").alias("words"))
    per_file = materialize(per_file, "notices")
    sizes = base.join(small(per_file), "key").select("key", "folder", "h", "words", F.size(_terms(F.col("text"))).alias("size"))
    one = sizes.groupBy("key").agg(F.first("folder").alias("folder"), F.first("h").alias("h"), F.first("words").alias("words"), F.first("size").alias("size"), F.count("*").alias("copies"))

    licence_files = one.filter((F.col("words") >= FILE_SHARE * F.col("size") * F.col("copies")) & F.col("folder").isNotNull())
    order = F.struct(-F.col("h.similarity"), "key.path", "h.license")
    of_folder = licence_files.groupBy(F.col("folder").alias("above")).agg(F.min_by(F.struct("h.license", "h.similarity", F.col("key.path").alias("path")), order).alias("l"))
    # the folders, once each, with all folders above them
    folders = base.filter("folder is not null").select("folder").distinct()
    parts = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("above"))
    nearest = above.join(of_folder, "above").groupBy("folder").agg(F.max_by("l", F.length("above")).alias("l"))
    out = base.select("key", "folder").join(small(per_file.select("key", "h")), "key", "left").join(nearest, "folder", "left")
    own = F.col("h").isNotNull()
    return out.select(
        "key.doc_id", "key.path", F.coalesce("h.license", "l.license").alias("license"), F.when(own, F.col("h.similarity")).otherwise(F.col("l.similarity")).alias("similarity"),
        F.when(own, F.lit("header")).when(F.col("l").isNotNull(), F.lit("inherited")).alias("via"), F.when(~own, F.col("l.path")).alias("license_path"),
    )
