"""License scans: MinHash bands over overlapping text windows, then exact containment (DataFrame functions only)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import local_rows

# Texts of public licenses and their notices, the texts to find.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_3 = """Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution."""
BSD_DISCLAIMER = """IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
permission notice appear in all copies."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"""
UNLICENSE = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"
GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation"""
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", APACHE),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", MIT),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", GNU.format("GNU General Public License")),
    ("LGPL", GNU.format("GNU Lesser General Public License")),
    ("AGPL", GNU.format("GNU Affero General Public License")),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", BSD_3),
    ("BSD", BSD_DISCLAIMER),
    ("ISC", ISC),
    ("Zlib", ZLIB),
    ("Unlicense", UNLICENSE),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("proprietary", "All rights reserved"),
]
SHINGLE, BANDS, CONTAINMENT = 3, 64, 0.8
WORDS = "[^\\p{L}\\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def shingles(words: Column, n: Column) -> Column:
    """Hashes of the three-word shingles of an array of n words, in order."""
    return F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(
        words[i], words[i + 1], words[i + 2]))).otherwise(F.array().cast("array<bigint>"))


def bands(sh: Column) -> Column:
    """One MinHash per band (bands of one row). Two sets of Jaccard similarity s share a band with
    probability 1 - (1 - s) ** BANDS; see ``scan_licenses`` for the least s."""
    least = lambda b: F.array_min(F.transform(sh, lambda h: F.xxhash64(h, F.lit(b))))
    return F.array(*[least(b) for b in range(BANDS)])


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, cls, tsh, tbands): cls is the least power of two of at least as many words."""
    rows = []
    for i, (name, text) in enumerate(templates):
        n = len([w for w in re.split(r"[\W_]+", text.lower()) if w])
        if n < SHINGLE:
            raise ValueError(f"a template needs {SHINGLE} words: {text!r}")
        rows.append((i, name, text, max(4, 1 << (n - 1).bit_length())))
    t = local_rows(spark, rows, ["template", "license", "body", "cls"])
    t = t.withColumn("w", words_of(F.col("body")))
    t = t.withColumn("tsh", F.array_distinct(shingles(F.col("w"), F.size("w"))))
    return t.select("template", "license", "cls", "tsh", F.size("w").alias("tlen"), bands(F.col("tsh")).alias("tbands"))


def license_hits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(id, template, license, start_word, containment) for each window whose text holds a template.

    Windows: for templates of up to c words (c a power of two), windows of 3c/2 words begin at
    every c/2-th word, so any run of c words lies whole in one of them and its Jaccard similarity
    with a template of more than c/2 words is at least (c/2 - 1) / (3c/2 - 2), 1/4 or more; with
    64 bands of one row a whole template is missed with a chance of at most 0.75 ** 64, 1e-8. A text that
    holds 0.8 of a template's shingles has 1/5 or more, hence a chance of 1e-6 at most.
    A band can only collide where a window shares a shingle with the template, so windows without
    any template shingle are passed over before the bands are made, which loses nothing.
    Verification is exact: the share of the template's shingles found in the window.
    """
    spark = docs.sparkSession
    found = template_table(spark, TEMPLATES if templates is None else templates)
    known = found.collect()
    marks = sorted({h for r in known for h in r.tsh})
    classes = sorted({r.cls for r in known})
    base = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w"))
    base = base.withColumn("sh", shingles(F.col("w"), F.size("w"))).drop("w")
    near = F.filter(F.sequence(F.lit(0), F.size("sh") - 1), lambda i: F.col("sh")[i].isin(marks))
    near = F.when(F.size("sh") > 0, near)
    # windows of class c that hold the shingle at p: the last to begin before it and the two before that one
    spots = F.array_distinct(F.flatten(F.transform(near, lambda p: F.flatten(F.array(*[
        F.array(F.struct(F.lit(c).alias("cls"), (F.floor(p / (c // 2)) - k).cast("int").alias("k"))
                ) for c in classes for k in (0, 1, 2)])))))
    base = base.withColumn("spots", spots)
    half = F.floor(F.col("s.cls") / 2)
    windows = (base.select("id", "sh", F.explode_outer("spots").alias("s"))
               .select("id", F.col("s.cls").alias("wcls"), (F.col("s.k") * half).cast("int").alias("start_word"),
                       F.array_distinct(F.slice("sh", F.greatest(F.col("s.k") * half, F.lit(0)).cast("int") + 1,
                                                (3 * half).cast("int") - 2)).alias("wsh"))
               .filter("start_word >= 0"))
    windows = windows.select("id", "wcls", "start_word", "wsh", F.posexplode_outer(bands(F.col("wsh"))).alias("band", "mark"))
    keys = found.select("template", "license", "cls", "tsh", F.posexplode_outer("tbands").alias("tband", "tmark"))
    pairs = windows.join(F.broadcast(keys), (F.col("wcls") == F.col("cls")) & (F.col("band") == F.col("tband"))
                         & (F.col("mark") == F.col("tmark")))
    share = F.size(F.array_intersect("wsh", "tsh")) / F.size("tsh")
    return (pairs.select("id", "template", "license", "start_word", share.alias("containment"))
            .filter(F.col("containment") >= CONTAINMENT).dropDuplicates(["id", "template", "start_word"]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, licenses, n_templates): a row for each document that holds a license notice.

    ``licenses`` lists the names found, sorted and comma-joined. Words are runs of letters and
    digits, lower-cased; a template counts where 80 % or more of its three-word shingles stand in
    one window of the text. Null or empty texts, and texts under three words, hold none; rows with
    a null id or repeated ids are merged by id. Only found windows are shuffled, the template table
    is a parameter of fixed size and the only thing broadcast.
    """
    hits = license_hits(docs, id_col, text_col, templates)
    return (hits.groupBy(F.col("id").alias("doc_id"))
            .agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
                 F.countDistinct("template").alias("n_templates")))
