"""License scans: Dice coefficient over word bigrams between texts and license templates."""

from __future__ import annotations

import functools
import math
import operator
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.scalar import let

THRESHOLD = 0.8

#: Public license notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        'shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY '
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]


#: Words that plain texts are full of; they are the last choice as anchors.
_COMMON = {"a", "and", "any", "are", "as", "by", "for", "in", "is", "of", "on", "or", "that", "the", "this", "to", "under", "use", "with"}


def words(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+", -1), lambda w: w != "")


def bigrams(listed: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is its own entry."""
    pairs = F.zip_with(F.slice(listed, 1, F.greatest(F.size(listed) - 1, F.lit(0))), F.slice(listed, 2, F.greatest(F.size(listed) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(listed) == 1, listed).otherwise(F.array_distinct(pairs))


def template_grams(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(template, license, size, gram): the templates' bigrams; as many rows as the given texts have words."""
    rows = [(k, name, text) for k, (name, text) in enumerate(templates)]
    t = spark.createDataFrame(rows, "template int, license string, text string").withColumn("grams", bigrams(words(F.col("text"))))
    return t.select("template", "license", F.size("grams").alias("size"), F.explode("grams").alias("gram"))


def anchors(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which each text that reaches the threshold holds at least one.

    A fitting text has at least size * threshold / (2 - threshold) of a template's bigrams.
    For each template the longest words (common ones last) are taken until so many bigrams hold one of them
    that the others alone would be too few. A word that holds another chosen one is not listed,
    as the texts are searched for the signs of a word, not for the word alone.
    """
    chosen: set[str] = set()
    for _, text in templates:
        listed = re.findall("[a-z0-9]+", text.lower())
        grams = set(zip(listed, listed[1:], strict=False)) or {(listed[0],)}
        needed = math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)
        own: set[str] = set()
        for word in sorted(set(listed), key=lambda w: (w in _COMMON, w not in chosen, -len(w), w)):
            if sum(not own.intersection(g) for g in grams) < needed:
                break
            own.add(word)
        chosen |= own
    return sorted(w for w in chosen if not any(other != w and other in w for other in chosen))


def windows(text: Column, templates: list[tuple[str, str]], threshold: float) -> Column:
    """[(template, license, dice)]: for each template the best window of the text that reaches the threshold.

    A window has as many words as the template and starts with one of its bigrams: any other
    window can be moved up to its first common bigram and loses none. Windows that hold fewer
    of the template's bigrams than a fitting text needs are not compared. Templates of one word
    have no windows. The words are split once, and only the places of the templates' bigrams
    are looked at again.
    """
    told = []
    for k, (name, body) in enumerate(templates):
        listed = re.findall("[a-z0-9]+", body.lower())
        if len(listed) > 1:
            told.append((k, name, len(listed), sorted({" ".join(g) for g in zip(listed, listed[1:], strict=False)})))
    if not told:
        return F.array().cast("array<struct<template:int,license:string,dice:double>>")
    every = sorted({g for *_, grams in told for g in grams})
    first, second = sorted({g.split()[0] for g in every}), sorted({g.split()[1] for g in every})

    def fitting(split: Column, hits: Column, k: int, name: str, length: int, grams: list[str]) -> Column:
        needed = max(1, math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9))

        def dice(start: Column) -> Column:
            def compared(own: Column) -> Column:
                return 2.0 * F.size(F.filter(own, lambda g: g.isin(grams))) / (F.size(own) + len(grams))

            return let(F.slice(split, start + 1, F.lit(length)), lambda part: let(bigrams(part), compared))

        def best(places: Column) -> Column:
            dense = F.filter(places, lambda at, i: F.get(places, i + (needed - 1)) <= at + (length - 2))
            return F.array_max(F.transform(dense, dice))

        places = F.transform(F.filter(hits, lambda h: h["gram"].isin(grams)), lambda h: h["at"])
        return F.struct(F.lit(k).alias("template"), F.lit(name).alias("license"), let(places, best).alias("dice"))

    def of(split: Column) -> Column:
        def bigram(word: Column, at: Column) -> Column:
            after = F.get(split, at + 1)
            return F.when(word.isin(first) & after.isin(second), F.struct(at.alias("at"), F.concat_ws(" ", word, after).alias("gram")))

        hits = F.filter(F.transform(split, bigram), lambda h: h["gram"].isin(every))
        found = let(hits, lambda h: F.array(*[fitting(split, h, *t) for t in told]))
        return F.filter(found, lambda x: x["dice"] >= threshold)

    return let(words(text), of)


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, templates: list[tuple[str, str]] | None = None
) -> DataFrame:
    """(key, line, license, dice): each line of a text that a template fits, with its best license; line 0 for the text.

    Lines and templates are lower-case words; Dice is 2 * common / (bigrams of the line +
    bigrams of the template), over distinct bigrams. line counts from 1. Line 0 stands for the
    text: each license that fits it as a whole, or a window of it as long as the template, so
    notices that are wrapped over lines or lie inside other text are found. Templates whose
    size lies outside size * threshold / (2 - threshold) .. size * (2 - threshold) / threshold
    cannot reach the threshold and are not compared. Ties go to the first template.

    Null and empty texts match nothing. Repeated rows give one result; texts that share a
    key are taken apart, and the best license of a line number (of line 0, the best Dice of each
    license) is reported for the key.
    A null key is kept. Other columns are not read.
    """
    templates = templates or TEMPLATES
    grams = template_grams(docs.sparkSession, templates)
    names = anchors(templates, threshold)

    def anchored(value: Column) -> Column:
        # The lambda binds the value once; a filter over a plain column would lower the text anew for each word.
        return F.exists(F.array(value), lambda v: functools.reduce(operator.or_, (F.contains(v, F.lit(w)) for w in names)))

    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least, most = grams.agg(F.min("size"), F.max("size")).first()
    # Lower case comes first, so that the texts and lines without an anchor word can be left out unsplit.
    source = docs.filter(anchored(F.lower(F.col(text)))).select(F.col(key).alias("row_key"), F.lower(F.col(text)).alias("text"))
    lines = F.split("text", "\n", -1)
    units = F.concat(
        F.transform(lines, lambda x, k: F.struct((k + 1).alias("line"), x.alias("unit"))),
        F.when(F.size(lines) > 1, F.array(F.struct(F.lit(0).alias("line"), F.col("text").alias("unit")))).otherwise(F.array().cast("array<struct<line:int,unit:string>>")),
    )
    split = source.select("row_key", F.xxhash64("text").alias("text_key"), F.explode(units).alias("u")).filter(anchored(F.col("u.unit")))
    split = split.select("row_key", "text_key", "u.line", words(F.col("u.unit")).alias("words"))
    sized = split.filter(F.size("words") >= int(least * low)).withColumn("grams", bigrams(F.col("words")))
    sized = sized.withColumn("own", F.size("grams")).filter(F.col("own").between(least * low, most * high))
    pairs = (
        sized.select("row_key", "text_key", "line", "own", F.explode("grams").alias("gram"))
        .join(F.broadcast(grams), "gram")
        .filter(F.col("own").between(F.col("size") * low, F.col("size") * high))
        .groupBy("row_key", "text_key", "line", "own", "template", "license", "size")
        .agg(F.size(F.collect_set("gram")).alias("common"))
        .withColumn("dice", 2.0 * F.col("common") / (F.col("own") + F.col("size")))
        .filter(F.col("dice") >= threshold)
    )
    inside = source.select("row_key", F.explode(windows(F.col("text"), templates, threshold)).alias("w"))
    found = pairs.select("row_key", "line", "template", "license", "dice").unionByName(inside.select("row_key", F.lit(0).alias("line"), "w.*"))
    apart = F.when(F.col("line") == 0, F.col("license")).alias("apart")
    best = found.groupBy("row_key", "line", apart).agg(F.max(F.struct("dice", (-F.col("template")).alias("first"), "license")).alias("best"))
    return best.select(F.col("row_key").alias(key), F.col("line").cast("bigint").alias("line"), "best.license", "best.dice")
