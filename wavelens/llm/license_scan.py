"""Licence notices in documents, by a trained paragraph classifier.

A paragraph is a block of lines up to one without a letter or digit, so that a notice
wrapped over lines, or inside a comment, is one paragraph; marks of comments are no words.
A paragraph is read in overlapping windows of ``WINDOW`` words, each the set of its word
unigrams and bigrams. A logistic regression with an L1 penalty, hence sparse weights,
tells licence families, licence-like text of no known family, and other text apart. It is
calibrated on notices whose whole templates it has not seen: a temperature that makes the
probability of a notice honest, and a threshold above which hardly any other text came out
as one. A family must also be confirmed by comparison with its templates, names and
version numbers among them; licence-like text that none confirms is ``unknown``.

A window can only be a notice if it holds a word of some weight for it. Such words follow
from the weights, and windows without one are left out before n-grams are made; this
changes no result.

All of it is DataFrame functions and Spark's own estimators.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelens.llm.common import filled
from wavelens.session import stored

OTHER, UNKNOWN = "other", "unknown"
#: Windows of the corpus that stand for other text while training, at most.
FIT_WINDOWS = 4_000
VOCABULARY = 1 << 13
#: Share of a template's n-grams that confirms its family.
CONFIRMED = 0.8
#: Words of a window, and from one window to the next; texts up to the difference stand whole in one.
WINDOW, STRIDE = 24, 12
#: Words on either side of a window in which the rest of a longer template is looked for.
AROUND = 64
#: Words of the pieces that templates are shortened to while training, and from one to the next.
PIECE, STEP = 14, 3
#: Families that a window may be compared with, the most probable first.
FAMILIES = 3
#: Share of other text above the threshold, at most.
WRONG = 0.001
WORD = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+){0,8}"
BLANK_LINES = r"\n[^\p{L}\p{N}]*\n"

# Words that name a licence.
NAMES = {
    "apache", "mit", "gnu", "lesser", "bsd", "mozilla", "mpl", "cc", "creative", "commons", "attribution",
    "attribution-sharealike", "attribution-noncommercial", "cc0",
}

# The usual notices and opening sentences of public licences.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "lgpl-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work under CC0 1.0.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright by the author. All rights reserved. No part of this publication may be reproduced without the "
        "prior written permission of the publisher.",
    ],
}

# Notices of no family above.
GENERIC = [
    "This text may be used under the terms given in the accompanying file.",
    "See the license file in the root of this project for details.",
    "Use of this material is subject to the license agreement you have accepted.",
    "Licensed under the terms of the agreement between the parties.",
    "You may copy this document for personal use as long as this notice is kept.",
    "Distributed under a custom license, please contact the author.",
    "Permission to reprint is granted on written request.",
    "This software is provided under the vendor license, version 1.2.",
    "Released under the Example Public License, version 7.",
    "Copyright notice: redistribution requires consent of the owner.",
    "This program is licensed under the GNU Affero General Public License, version 3.",
    "Licensed under the Eclipse Public License, version 1.0.",
    "You may distribute this package under the terms of the Artistic License.",
    "Licensed under the Apache License, Version 1.1.",
]

# Sentences that use the words of notices for something else.
PLAIN = [
    "She gave her permission and they used the files in the office without any conditions or limits.",
    "The driver showed his license and a copy of the notice to the owner of the house.",
    "The public library is free for all, and any person may copy a page of a book there.",
    "All software and documentation of the course can be found in the folder of the general office.",
    "The law required a written version of the agreement, and the work was published in the same form.",
    "In the terms of this theory, the following conditions must hold for any source in the field.",
    "The foundation of the house was granted no limitation, as the owner had agreed in writing.",
    "Merge the files, modify the code and publish it in the list of the project.",
    "This program is about the rights of workers, and either version of the story may be true.",
    "They sell copies of the work at the market and charge for any use of the binary code.",
]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def ngrams(ws: Column) -> Column:
    """Distinct words and pairs of neighbouring words of an array of words."""
    following = F.slice(ws, F.lit(2), F.greatest(F.size(ws), F.lit(1)))
    pairs = F.zip_with(ws, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(ws, F.filter(pairs, lambda p: p.isNotNull())))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, paragraph, words)`` of every block of lines; null text has one without words."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", filled().alias("text"))
    blocks = rows.select("row", "doc_id", F.posexplode(F.split("text", BLANK_LINES)).alias("paragraph", "block"))
    return blocks.select("row", "doc_id", "paragraph", words(F.col("block")).alias("words"))


def windows(paragraphs: DataFrame, cues: list[str] | None = None) -> DataFrame:
    """``(row, doc_id, paragraph, start, words, context)`` of every window with a word, or with one of ``cues``."""

    def cut(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(ws) - WINDOW + STRIDE - 1), F.lit(STRIDE))

        def one(i: Column) -> Column:
            first = F.greatest(F.lit(0), i - AROUND)
            return F.struct(
                i.alias("start"), F.slice(ws, i + 1, F.lit(WINDOW)).alias("words"),
                F.slice(ws, first + 1, i + WINDOW + AROUND - first).alias("context"),
            )

        def tells(i: Column) -> Column:
            part = F.slice(ws, i + 1, F.lit(WINDOW))
            return F.size(part) > 0 if cues is None else F.exists(part, lambda w: w.isin(cues))

        return F.transform(F.filter(starts, tells), one)

    # in one expression, as a filter on the words would find them twice
    found = paragraphs.select("row", "doc_id", "paragraph", F.explode(_let(F.col("words"), cut)).alias("w"))
    return found.select("row", "doc_id", "paragraph", "w.*")


def required(text: str) -> list[str]:
    """Pairs of neighbouring words that a template cannot do without: names and what follows, versions and what precedes."""
    ws = re.findall(r"[^\W_]+(?:[.-][^\W_]+){0,8}", text.lower())
    return [f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False) if a in NAMES or any(c.isdigit() for c in b)]


def template_table(spark: SparkSession) -> DataFrame:
    """``(label, template, required, short)``: the n-grams of every template and those it cannot do without."""
    rows = [(family, text, required(text)) for family, texts in TEMPLATES.items() for text in texts]
    table = spark.createDataFrame(rows, "label string, text string, required array<string>")
    ws = words(F.col("text"))
    return table.select("label", ngrams(ws).alias("template"), "required", (F.size(ws) <= WINDOW - STRIDE).alias("short"))


def _examples(spark: SparkSession) -> DataFrame:
    """``(label, fold, words)``: templates, generic notices and plain sentences, and pieces of them; a template is all in one fold."""
    rows = []
    for family, texts in [*TEMPLATES.items(), (UNKNOWN, GENERIC), (OTHER, PLAIN)]:
        for fold, text in enumerate(texts):
            ws = text.split()
            starts = range(0, max(1, len(ws) - PIECE + STEP), STEP)
            pieces = dict.fromkeys([" ".join(ws[:WINDOW]), *(" ".join(ws[i : i + PIECE]) for i in starts)])
            rows += [(family, fold % 2, x) for x in pieces]
    return spark.createDataFrame(rows, "label string, fold int, text string").select("label", "fold", words(F.col("text")).alias("words"))


def training_set(docs: DataFrame) -> DataFrame:
    """``(label, fold, grams)``: notices alone and inside other text, and other text.

    Other text is drawn from the corpus by the hash of its documents, at most
    ``FIT_WINDOWS`` windows; those that resemble a template are left out.
    """
    spark = docs.sparkSession
    notices = _examples(spark)
    total = docs.select(F.count(F.lit(1))).collect()[0][0]
    rate = min(1.0, FIT_WINDOWS / 4 / max(total, 1))
    draw = F.pmod(F.xxhash64(F.lit("licence"), F.col("doc_id")), F.lit(1 << 30)) < max(1, int(rate * (1 << 30)))
    order = F.xxhash64("words")
    drawn = windows(paragraphs(docs.filter(draw))).orderBy(order, "doc_id", "paragraph", "start").limit(FIT_WINDOWS)
    drawn = stored(drawn.select("words", ngrams(F.col("words")).alias("grams")), "other")
    likes = []
    for r in template_table(spark).collect():
        common = F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in r["template"]])))
        likes += [common / len(r["template"]), common / F.size("grams")]
    other = drawn.filter(F.greatest(*likes) < 0.3).select(
        F.lit(OTHER).alias("label"), F.pmod(order, F.lit(2)).cast("int").alias("fold"), "words"
    )
    spots = F.pmod(F.xxhash64("words"), F.lit(97))
    numbered = notices.select("label", "fold", "words", F.explode(F.array(*[F.pmod(spots + k, F.lit(97)) for k in (0, 31)])).alias("i"))
    around = other.select(spots.alias("i"), F.col("fold").alias("its"), F.col("words").alias("more"))
    before = F.pmod(F.xxhash64("words", "more"), F.lit(WINDOW - PIECE + 1)).cast("int")
    placed = F.concat(
        F.slice("more", F.lit(1), before), "words", F.slice("more", before + 1, F.greatest(F.lit(0), WINDOW - F.size("words") - before))
    )
    inside = numbered.join(around, "i").filter("fold = its").select("label", "fold", F.slice(placed, 1, WINDOW).alias("words"))
    examples = notices.unionByName(other).unionByName(inside)
    return stored(examples.select("label", "fold", ngrams(F.col("words")).alias("grams")).coalesce(4), "licence-examples")


@dataclass
class Classifier:
    vectors: CountVectorizerModel
    regression: LogisticRegressionModel
    labels: list[str]
    temperature: float
    threshold: float
    cues: list[str] | None

    def classify(self, df: DataFrame) -> DataFrame:
        """Add to rows with ``grams`` their ``label``, the calibrated ``notice`` probability and the likeliest ``families``."""
        scored = self.regression.transform(self.vectors.transform(df))
        labels = F.split(F.lit(",".join(self.labels)), ",")
        share = _softmax(vector_to_array("rawPrediction"), self.temperature)
        each = F.zip_with(share, labels, lambda p, x: F.struct(p.alias("p"), x.alias("label")))
        out = scored.select(*df.columns, F.sort_array(each, asc=False).alias("each"))
        families = F.filter("each", lambda x: ~x["label"].isin(OTHER, UNKNOWN))
        other = F.filter("each", lambda x: x["label"] == OTHER)
        return out.select(
            *df.columns, F.col("each")[0]["label"].alias("label"), (1 - other[0]["p"]).alias("notice"),
            F.slice(families, 1, FAMILIES).alias("families"),
        )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _softmax(raw: Column, temperature: float) -> Column:
    def odds(scores: Column) -> Column:
        return _let(F.array_max(scores), lambda top: F.transform(scores, lambda x: F.exp((x - top) / temperature)))

    def shares(each: Column) -> Column:
        return _let(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(each, lambda x: x / total))

    return _let(raw, lambda scores: _let(odds(scores), shares))


def cue_words(vocabulary: list[str], weights: np.ndarray, intercepts: np.ndarray, other: int) -> list[str] | None:
    """Words one of which any window must hold that is not ``other``; None if there is no such set.

    What the intercepts are ahead for ``other`` must be made up by n-grams that speak for
    something else. Those that cannot do so even all together are no cues. A pair of words
    is found by its rarer one.
    """
    lead = intercepts[other] - np.delete(intercepts, other).max()
    if lead <= 0:
        return None
    gain = np.maximum(np.delete(weights, other, 0) - weights[other], 0).max(0)
    order = np.argsort(gain, kind="stable")
    telling = order[np.cumsum(gain[order]) >= lead * (1 - 1e-9)]
    place = {g: i for i, g in enumerate(vocabulary)}
    return sorted({max(vocabulary[i].split(" "), key=lambda w: (place.get(w, len(place)), w)) for i in telling})


def fit(docs: DataFrame) -> Classifier:
    """A classifier fitted on all examples, calibrated on two folds of templates, each scored by a fit on the other."""
    examples = training_set(docs)
    labels = sorted([*TEMPLATES, UNKNOWN, OTHER])
    index = F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1
    data = examples.select(index.cast("double").alias("y"), "grams", "fold")
    vectors = CountVectorizer(inputCol="grams", outputCol="x", vocabSize=VOCABULARY, minDF=2.0, binary=True).fit(data)
    weights = data.groupBy("y").agg((1 / F.sqrt(F.count(F.lit(1)))).alias("weight"))
    data = stored(vectors.transform(data).join(F.broadcast(weights), "y").select("y", "x", "fold", "weight"), "licence-vectors")
    regression = LogisticRegression(
        featuresCol="x", labelCol="y", weightCol="weight", family="multinomial", maxIter=60, regParam=5e-4,
        elasticNetParam=1.0, standardization=False,
    )
    scored = [
        regression.fit(data.filter(F.col("fold") != k)).transform(data.filter(F.col("fold") == k)).select(
            F.col("y").cast("int").alias("y"), vector_to_array("rawPrediction").alias("raw"), "weight"
        ) for k in (0, 1)
    ]
    held = stored(scored[0].unionByName(scored[1]), "licence-held-out")
    temperatures = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0, 5.6, 8.0]

    def notice(t: float) -> Column:
        return 1 - F.element_at(_softmax(F.col("raw"), t), labels.index(OTHER) + 1)

    def loss(t: float) -> Column:
        right = F.when(F.col("y") == labels.index(OTHER), 1 - notice(t)).otherwise(notice(t))
        return F.sum(F.col("weight") * -F.log(F.greatest(right, F.lit(1e-12))))

    losses = held.agg(*[loss(t).alias(f"t{i}") for i, t in enumerate(temperatures)]).collect()[0]
    temperature = min(zip(losses, temperatures, strict=True), key=lambda x: math.inf if x[0] is None else x[0])[1]
    plain = held.filter(F.col("y") == labels.index(OTHER))
    wrong = plain.agg(F.percentile(notice(temperature), F.lit(1 - WRONG))).collect()[0][0]
    model = regression.fit(data)
    cues = cue_words(vectors.vocabulary, model.coefficientMatrix.toArray(), model.interceptVector.toArray(), labels.index(OTHER))
    return Classifier(vectors, model, labels, temperature, min(0.99, max(0.5, wrong or 0.0)), cues)


def scan(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """``(doc_id, paragraph, family, probability, similarity, confirmed, first_word, last_word)`` per notice.

    One row per paragraph (from 0, between lines without a letter or digit) and family in
    it, with the words (from 0, of the paragraph) that the windows telling so span. A
    family is one of the three likeliest of a window that is no other text, and a template
    confirms it; one of at most ``WINDOW - STRIDE`` words in the window itself, a longer one
    with ``AROUND`` more words on both sides. ``unknown`` stands for windows above the
    threshold that overlap none where a family is confirmed. ``similarity`` is the largest
    share of a template's n-grams found, ``probability`` the family's, or of a notice at all
    where it is unknown. Several families of one paragraph give a row each; equal
    probabilities go by the family's name. Texts that are null, empty or hold no notice give
    no row; rows that repeat give a row each; other columns are left behind.
    """
    docs = docs.select("doc_id", "text")
    classifier = classifier or fit(docs)
    found = windows(paragraphs(docs), classifier.cues).withColumn("grams", ngrams(F.col("words")))
    found = classifier.classify(found).filter(F.col("label") != OTHER)
    found = found.select(
        "row", "doc_id", "paragraph", "start", F.size("words").alias("n"), "notice", "families", "grams",
        ngrams(F.col("context")).alias("wide"),
    )
    found = stored(found, "notices")
    place = ["row", "doc_id", "paragraph", "start", "n", "notice"]
    near = found.select(*place, "grams", "wide", F.explode("families").alias("f")).join(
        F.broadcast(template_table(docs.sparkSession)), F.col("f.label") == F.col("label")
    )
    text = F.when(F.col("short"), F.col("grams")).otherwise(F.col("wide"))
    whole = F.size(F.array_except("required", text)) == 0
    share = F.size(F.array_intersect(text, "template")) / F.size("template")
    compared = near.select(*place, "label", "f.p", share.alias("share"), whole.alias("whole"))
    sure = F.col("whole") & (F.col("share") >= CONFIRMED)
    by_family = compared.groupBy(*place, "label").agg(
        F.max("p").alias("p"), F.max("share").alias("similarity"), F.bool_or(sure).alias("sure")
    )
    around = W.partitionBy("row", "paragraph").orderBy("start").rangeBetween(1 - WINDOW, WINDOW - 1)
    told = by_family.withColumn("settled", F.max("sure").over(around))
    lines = told.filter(F.col("sure") | (~F.col("settled") & (F.col("notice") > classifier.threshold)))
    family = F.when(F.col("sure"), F.col("label")).otherwise(UNKNOWN)
    out = lines.groupBy("row", "doc_id", "paragraph", family.alias("family"), F.col("sure").alias("confirmed")).agg(
        F.max(F.when(F.col("sure"), F.col("p")).otherwise(F.col("notice"))).alias("probability"),
        F.max("similarity").alias("similarity"),
        F.min("start").alias("first_word"), (F.max(F.col("start") + F.col("n")) - 1).alias("last_word"),
    )
    return out.select("doc_id", "paragraph", "family", "probability", "similarity", "confirmed", "first_word", "last_word")
