"""Licences of documents from headers and licence files, in DataFrame functions alone.

Sentences with a licence cue are compared with announcements, blocks of lines with headers and
whole documents with licence texts, each by the cosine of sparse TF-IDF vectors of words and
word pairs. Equal ones are compared once. An SPDX identifier names its licence itself. A document
near to a licence text, or that consists mostly of announcements, is a licence file and speaks
for its directory; a document without a licence of its own has that of the nearest directory
above it.
"""

from __future__ import annotations

import math
from importlib.resources import files as parts_of

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable
from .common import query, table

CUE = r"(?i)licen[cs]|spdx|copyright|public domain|\bcc[ -](?:by|0)|\bcc0|unlicense|warrant"
LEAST_COSINE = 0.5
FILE_SHARE = 0.5
SALTS = 8
SPDX = r"SPDX-License-Identifier:\s*([^\r\n]*)"
#: One identifier of an expression; suffixes that TEMPLATES do not tell apart are left out.
NAME = r"(?<![A-Za-z0-9.+-])(?!(?:AND|OR|WITH)(?![A-Za-z0-9.+-]))([A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?)"
#: Signs of comments at both ends of a line.
MARKS = r"(?m)^[ \t]*(?:<!--|/\*+|\*+/?|//+|#+|;+|--+|%+|dnl\b|rem\b)?[ \t]*|[ \t]*(?:\*+/|-->)?[ \t\r]*$"

# fixed values: identifiers of common licences and the sentences that announce them
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-2-Clause", "Distributed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Distributed under the BSD 3-Clause License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Released under the ISC License."),
]


def _gnu(name: str, version: str, work: str = "This program", of: str = "") -> str:
    return (
        f"{work} is free software{of} you can redistribute it and/or modify it under the terms of the GNU {name} as published "
        f"by the Free Software Foundation, {version}. {work} is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        f"{name} for more details. You should have received a copy of the GNU {name} along with this program."
    )


_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
#: Headers of files, whole and by the paragraph that names the licence.
HEADERS = [
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + ' Unless required by applicable law or agreed to in writing, software distributed under the License '
     'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the '
     "License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    *(
        (name, text if whole else text.split(f" {work} is distributed")[0])
        for name, title, version, work in (
            ("GPL-2.0", "General Public License", "either version 2 of the License, or (at your option) any later version", "This program"),
            ("GPL-2.0", "General Public License", "version 2", "This program"),
            ("GPL-3.0", "General Public License", "either version 3 of the License, or (at your option) any later version", "This program"),
            ("LGPL-2.1", "Lesser General Public License", "either version 2.1 of the License, or (at your option) any later version", "This library"),
            ("LGPL-3.0", "Lesser General Public License", "either version 3 of the License, or (at your option) any later version", "This library"),
            ("AGPL-3.0", "Affero General Public License", "either version 3 of the License, or (at your option) any later version", "This program"),
        )
        for text in (_gnu(title, version, work, ";"),) for whole in (True, False)
    ),
]


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the licence texts in ``texts``."""
    out = []
    for f in sorted(parts_of(__package__).joinpath("texts").iterdir(), key=lambda f: f.name):
        if f.name.endswith(".txt"):
            out.append((f.name.removesuffix(".txt"), f.read_text()))
    return out


def terms(text: str) -> Column:
    """Words and pairs of neighbouring words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9]+(?:[.-][a-z0-9]+)*"), F.lit(0))
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, F.filter(F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda p: p != ""))


def _vectors(rows: DataFrame, key: str, idf: DataFrame, unseen: float) -> DataFrame:
    """(key, term, w): sparse vectors of length one."""
    counted = rows.select(key, F.explode("terms").alias("term")).groupBy(key, "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(idf, "term", "left").withColumn(
        "w", (1 + F.log("tf")) * F.coalesce("idf", F.lit(unseen))
    )
    norms = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norms, key).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def match(sentences: DataFrame, templates: DataFrame) -> DataFrame:
    """(id, license, score): the best template of each distinct sentence, if any is near.

    Sentences may be blocks or whole documents, as the templates are; ``id`` is their digest.
    """
    known = templates.select("license", "template").distinct().withColumn("terms", terms("template")).withColumn("id", F.md5("template"))
    total = known.count()
    idf = known.select("id", F.explode("terms").alias("term")).distinct().groupBy("term").agg(
        (F.log((total + 1) / (F.count("*") + 1)) + 1).alias("idf")
    )
    idf, unseen = durable(idf), math.log(total + 1) + 1
    left = _vectors(sentences.dropDuplicates(["id"]).withColumn("terms", terms("sentence")), "id", idf, unseen)
    right = durable(_vectors(known, "id", idf, unseen).withColumnsRenamed({"id": "template", "w": "v"}))
    scores = left.join(right, "term").groupBy("id", "template").agg(F.sum(F.col("w") * F.col("v")).alias("score"))
    named = known.groupBy(F.col("id").alias("template")).agg(F.min("license").alias("license"))
    return scores.filter(F.col("score") >= LEAST_COSINE).join(named, "template").groupBy("id").agg(
        F.max(F.struct("score", "license")).alias("best")
    ).select("id", "best.license", F.round("best.score", 9).alias("score"))


def licences(
    docs: DataFrame, templates: DataFrame, key: str = "doc_id", text: str = "text", path: str = "path"
) -> DataFrame:
    """(key, license, score, origin, license_dir) for every row; origin is own, inherited or null.

    Null and empty texts have no licence of their own but inherit. A null path lies in the root,
    which is the empty path. Rows with a null key stay; repeated rows have equal results. In a
    directory with several licence files the best score counts, then the later name. Other
    columns are ignored. ``templates`` are announcements; ``HEADERS`` and ``full_texts()`` are
    always known. A near licence text decides before all, else the best score.
    """
    levels = F.split(F.coalesce(path, F.lit("")), "/")
    source = docs.select(
        F.col(key).alias("key"), F.xxhash64(key, text, path).alias("row"), F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(path, F.lit("")).alias("path"),
    )
    spark = docs.sparkSession
    with_cue = lambda parts: F.explode(F.array_distinct(F.filter(parts, lambda s: s.rlike(CUE))))
    plain = lambda text: F.trim(F.regexp_replace(F.regexp_replace(text, MARKS, " "), r"\s+", " "))
    cue = source.filter(F.col("text").rlike(CUE))
    cued = durable(
        cue.select("row", "path", F.length("text").alias("whole"), with_cue(F.split("text", r"(?<=[.!?])\s+|\n")).alias("sentence"))
        .withColumn("id", F.md5("sentence"))
    )
    # blocks lie between empty lines; equal blocks and documents are compared once, by their words
    block = F.transform(F.split("text", r"\n[ \t\r]*\n"), plain)
    blocks = durable(cue.select("row", "path", with_cue(block).alias("sentence")).withColumn("id", F.md5("sentence")))
    wholes = durable(cue.select("row", "path", plain("text").alias("sentence")).withColumn("id", F.md5("sentence")))
    spdx = F.explode(F.flatten(F.transform(
        F.regexp_extract_all("text", F.lit(f"(?i){SPDX}"), F.lit(1)),
        lambda e: F.regexp_extract_all(F.regexp_replace(e, r"(?i)-(?:only|or-later)(?![A-Za-z0-9.-])|\bWITH\s+\S+|\*/.*|-->.*", ""), F.lit(NAME), F.lit(1)),
    )))
    declared = cue.select("row", "path", spdx.alias("license")).select(
        "row", "path", F.lit(0).alias("level"), F.lit(1.0).alias("score"), "license", F.lit(None).cast("double").alias("share")
    )

    def near(units: DataFrame, known: DataFrame, level: int, share: Column) -> DataFrame:
        each = durable(match(units, known)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return units.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(each, ["id", "salt"]).select(
            "row", "path", F.lit(level).alias("level"), "score", "license", share.alias("share")
        )

    named = lambda rows: spark.createDataFrame(rows, "license string, template string")
    whole_file = F.lit(1.0)  # a licence text is its document
    found = (
        near(cued, templates, 0, F.length("sentence") / F.col("whole"))
        .unionByName(near(blocks, named(HEADERS), 0, F.lit(None).cast("double")))
        .unionByName(near(wholes, named(full_texts()), 1, whole_file)).unionByName(declared)
    )
    best = F.max(F.struct("level", "score", "license"))
    own = durable(
        found.groupBy("row").agg(best.alias("best"), F.first("path").alias("path"), F.sum("share").alias("share")).select(
            "row", F.struct("best.score", "best.license").alias("own"), "path", "share"
        )
    )
    parent = F.regexp_replace("path", r"/?[^/]*$", "")
    files = durable(
        own.filter(F.col("share") >= FILE_SHARE).groupBy(parent.alias("dir")).agg(F.max("own").alias("file"))
    )
    depth = docs.select(F.max(F.size(levels))).first()[0] or 0
    out = source.select("key", "row", "path").join(own.select("row", "own").dropDuplicates(["row"]), "row", "left")
    out = out.withColumn("up", parent).withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    spread = files.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = out.withColumn("near", F.lit(None).cast(files.schema["file"].dataType)).withColumn("at", F.lit(None).cast("string"))
    for _ in range(depth):  # as many joins as the deepest path has levels
        step = spread.select(F.col("dir").alias("up"), "salt", F.col("file").alias("found"))
        out = out.join(step, ["up", "salt"], "left").withColumn(
            "at", F.coalesce("at", F.when(F.col("found").isNotNull(), F.col("up")))
        ).withColumn("near", F.coalesce("near", "found")).drop("found").withColumn(
            "up", F.when(F.col("up") != "", F.regexp_replace("up", r"/?[^/]*$", ""))
        )
    got = F.coalesce("own", "near")
    return out.select(
        F.col("key").alias(key), got["license"].alias("license"), got["score"].alias("score"),
        F.when(F.col("own").isNotNull(), F.lit("own")).when(F.col("near").isNotNull(), F.lit("inherited")).alias("origin"),
        F.when(F.col("own").isNull(), F.col("at")).alias("license_dir"),
    )


@query("op8_licenses")
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in source/lang/hundreds of ids, which stand for a source tree."""
    docs = table(spark, sf_dir, "documents")
    folder = F.floor(F.col("doc_id") / 100).cast("string")
    placed = docs.withColumn("path", F.concat_ws("/", "source", "lang", folder, F.col("doc_id").cast("string")))
    return licences(placed, spark.createDataFrame(TEMPLATES, "license string, template string"))
