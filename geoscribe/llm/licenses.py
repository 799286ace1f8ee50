"""License scan: a trained paragraph classifier with template confirmation, all native.

Every line is a paragraph, and so is every run of hard-wrapped lines: neighbours
of at most ``WRAP`` characters, with no line without a letter or digit between
them (so a line of comment marks ends a paragraph).  Line breaks and
comment marks inside it do not count.  A paragraph becomes a sparse set of word 2- and 3-grams over those of the
notices below.  Multinomial logistic regression (Spark ML, in the JVM)
separates the licence families, an ``unknown`` licence and ``none``.  It is
trained on notices with words dropped and cut, against at most
``NEGATIVE_DOCS`` documents of the corpus (smallest id hashes), less
those that hold a licence cue (each distinct line counts once).  A predicted family counts when its probability passes a
threshold, calibrated so that held-out texts of families the model does not
know stay unknown, and when the paragraph holds at least ``MIN_CONTAINMENT`` of
the 3-grams of a notice of that family; otherwise the paragraph is ``unknown``.

The weights decide what must be scored: without an n-gram that speaks for a
family against ``none`` a paragraph is ``none``, so one word of each such
n-gram (the one that plain text uses least) forms an exact filter which the
scan applies to whole texts and paragraphs before any n-gram is built.

The result has one row per licence paragraph: its confirmed lines, and a
wrapped paragraph whose confirmed family none of its lines shows; lines that are
not confirmed only where the wrapped paragraph is not either.  ``paragraph`` is
the number of its first line and ``n_lines`` how many it has.  Null and empty
texts have none; null ids are returned as they are, repeated rows repeat their
rows, an empty table gives no rows, and other columns are not read.  Of equally
probable families the first of ``NOTICES`` is reported.  A text is split in its
own row, whole, at any length.
"""

from __future__ import annotations

import random
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import documents, materialize

NEGATIVE_DOCS = 400
VARIANTS = 24
SEED = 41
MIN_CONTAINMENT = 0.5
#: Lines up to this long may be parts of a hard-wrapped paragraph.
WRAP = 160
MAX_FALSE_KNOWN = 0.05
NGRAMS = (2, 3)
NONE, UNKNOWN = "none", "unknown"

# Short notices as they stand in files, by family.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ],
    "AGPL-3.0": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "BSD": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
# Licences outside the families, for the unknown class.
OTHER_NOTICES = [
    "Licensed under the Artistic License 2.0.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "This file is distributed under the terms of the zlib license.",
    "Licensed under the Open Software License version 3.0.",
    "This work is licensed under the Academic Free License, version 3.0.",
    "Licensed under the terms of the Microsoft Public License.",
    "Released under the Do What The Fuck You Want To Public License.",
    "This document is licensed under the Open Publication License, version 1.0.",
    "Licensed under the Eclipse Public License 2.0.",
    "Distributed under the Boost Software License, Version 1.0.",
]
PLAIN_TEXT = [
    "The work was finished in the spring and the general public came to see it.",
    "She is free to use the software of her choice at any time.",
    "A new version of the file is on the table, and all of it was read.",
    "They will meet under the bridge at four and go home by the river.",
]
_CUE = r"(?i)licen[sc]|copyright|spdx|rights reserved|redistribut|public domain|creative commons"
_JAVA_WORDS = r"[a-z0-9]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_JAVA_WORDS), F.lit(0))


def _ngrams(words: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
    return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
        F.array().cast("array<string>"))


def _terms(words: Column) -> Column:
    """Distinct 2- and 3-grams."""
    return F.array_distinct(F.concat(*[_ngrams(words, n) for n in NGRAMS]))


def _driver_terms(text: str) -> list[str]:
    w = re.findall(_JAVA_WORDS, text.lower())
    return sorted({" ".join(w[i:i + n]) for n in NGRAMS for i in range(len(w) - n + 1)})


def training_paragraphs(seed: int = SEED, variants: int = VARIANTS) -> list[tuple[str, str, bool]]:
    """``(text, label, held_out)``: notices whole, with words dropped or changed, and inside other text."""
    rnd = random.Random(seed)
    out = []
    labelled = [(f, t) for f, ts in NOTICES.items() for t in ts] + [(UNKNOWN, t) for t in OTHER_NOTICES]
    for k, (label, text) in enumerate(labelled):
        held = label == UNKNOWN and k % 2 == 0
        out.append((text, label, held))
        words = text.split()
        for v in range(variants):
            kept = [w for w in words if rnd.random() > 0.08] or words
            if v % 3 == 1:
                kept = kept[: max(3, int(len(kept) * rnd.uniform(0.7, 1.0)))]
            if v % 3 == 2:
                kept = [f"w{rnd.randrange(10 ** 6)}" for _ in range(rnd.randrange(12))] + kept
            out.append((" ".join(kept), label, held or v % 4 == 0))
    return out + [(t, NONE, False) for t in PLAIN_TEXT]


class LicenseModel:
    """A fitted classifier: ``classes``, the two Spark ML models, the filter words and the threshold."""

    def __init__(self, corpus: DataFrame):
        spark = corpus.sparkSession
        rows = spark.createDataFrame(training_paragraphs(), "text string, label string, held boolean")
        # The few ids are chosen without reading texts; at most NEGATIVE_DOCS of them are broadcast.
        chosen = corpus.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(NEGATIVE_DOCS)
        sample = corpus.join(F.broadcast(chosen), "id", "left_semi").where(~F.col("text").rlike(_CUE))
        sample = sample.orderBy(F.xxhash64("text"), "text").limit(NEGATIVE_DOCS)       # an id may have many rows
        plain = sample.select(F.explode(F.split("text", "\n")).alias("text"), F.lit(NONE).alias("label"),
                              F.lit(False).alias("held")).distinct()       # a line repeated often weighs once
        self.classes = [NONE, UNKNOWN, *NOTICES]
        number = F.array_position(F.array(*[F.lit(c) for c in self.classes]), F.col("label")) - 1
        vocabulary = sorted({t for ts in [*NOTICES.values(), OTHER_NOTICES] for x in ts for t in _driver_terms(x)})
        self.vectorizer = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="features",
                                                               minTF=1.0)
        self.vectorizer.setBinary(True)
        data = rows.unionByName(plain).withColumn("words", _words(F.col("text"))).where(F.size("words") > 0)
        data = data.select("label", "held", number.cast("double").alias("y"), "words", _terms(F.col("words")).alias("terms"))
        data = materialize(self.vectorizer.transform(data).drop("terms"), "license_training")
        fitted = LogisticRegression(featuresCol="features", labelCol="y", family="multinomial", maxIter=60,
                                    regParam=0.002, elasticNetParam=0.95, standardization=False).fit(
            data.where(~F.col("held")))
        self.model = fitted
        self.words = self._filter_words(data, vocabulary)
        self.threshold = self._calibrate(data.where("held"))

    def _filter_words(self, data: DataFrame, vocabulary: list[str]) -> list[str]:
        """Words without which a paragraph is surely ``none``.

        The n-grams whose weights together cannot outweigh the intercept of
        ``none`` need no word; those with a word common in plain text go first.
        """
        w, b = self.model.coefficientMatrix.toArray(), self.model.interceptVector.toArray()
        gap = float(b[0] - b[1:].max())
        if gap <= 0:
            return []                                     # no filter: even an empty paragraph is not ``none``
        margin = (w[1:] - w[0]).max(0)
        parts = sorted({x for t in vocabulary for x in t.split()})
        plain = {r.word: r.n for r in data.where(F.col("label") == NONE)
                 .select(F.explode(F.array_distinct("words")).alias("word"))
                 .where(F.col("word").isin(parts)).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
        rarest = {t: min(t.split(), key=lambda x: (plain.get(x, 0), -len(x), x)) for t in vocabulary}
        for_license = [(t, float(m)) for t, m in zip(vocabulary, margin) if m > 0]
        spent, words = 0.0, set()
        for t, m in sorted(for_license, key=lambda tm: (-plain.get(rarest[tm[0]], 0), tm[1], tm[0])):
            if not words and spent + m < gap:
                spent += m
            else:
                words.add(rarest[t])
        return sorted(words)

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """Add ``p``, an array of class probabilities, to rows with ``features``."""
        scored = self.model.transform(rows)
        return scored.withColumn("p", vector_to_array("probability")).drop(
            "features", "rawPrediction", "probability", "prediction")

    def verdict(self, rows: DataFrame) -> DataFrame:
        """Add ``p_license`` and the best known family with its share of the licence mass."""
        p = self.probabilities(rows).withColumn("p_license", 1 - F.get("p", F.lit(0)))
        best = F.array_max(F.transform(F.slice("p", 3, len(self.classes) - 2), lambda x, i: F.struct(x.alias("x"), (-i).alias("i"))))
        names = F.array(*[F.lit(c) for c in NOTICES])
        return (p.withColumn("_best", best).withColumn("family", F.get(names, -F.col("_best")["i"]))
                .withColumn("p_family", F.col("_best")["x"] / F.greatest(F.col("p_license"), F.lit(1e-12)))
                .withColumn("is_license", F.array_max("p") > F.get("p", F.lit(0))).drop("_best", "p"))

    def _calibrate(self, held: DataFrame) -> float:
        """The least share at which few held-out unknown licences pass for a known family."""
        shares = sorted(r.p_family for r in self.verdict(held.where(F.col("label") == UNKNOWN)).select("p_family").collect())
        if not shares:
            return 0.5
        return max(0.5, min(0.99, shares[min(len(shares) - 1, int((1 - MAX_FALSE_KNOWN) * len(shares)))]))


def _containment(words: Column, family: Column) -> Column:
    """Largest share of a notice's 3-grams (2-grams of a short one) that the paragraph holds."""
    terms = _terms(words)
    out = F.lit(0.0)
    for name, notices in NOTICES.items():
        parts = []
        for text in notices:
            want = [t for t in _driver_terms(text) if t.count(" ") == 2] or _driver_terms(text)
            parts.append(F.size(F.array_intersect(terms, F.array(*[F.lit(t) for t in want]))) / F.lit(float(len(want))))
        out = F.when(family == name, F.greatest(*parts) if len(parts) > 1 else parts[0]).otherwise(out)
    return out


def _paragraphs(text: Column) -> Column:
    """Array of strings: single lines, and hard-wrapped lines together; each line as ``number \\x01 line``.

    The marks are first blanked in the text, where they are no part of a word.
    """
    line, cut = "\x01", "\x1e"
    lines = F.split(F.translate(text, line + cut, "  "), "\n")
    alone = lambda x: (F.length(x) > WRAP) | ~x.rlike(r"[\p{L}\p{N}]")
    marked = F.transform(lines, lambda x, i: F.when(alone(x), F.concat(F.lit(cut), i.cast("string"), F.lit(line), x, F.lit(cut)))
                         .otherwise(F.concat(i.cast("string"), F.lit(line), x, F.lit("\n"))))
    return F.split(F.array_join(marked, ""), cut)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_containment: float = MIN_CONTAINMENT) -> DataFrame:
    """``(id, paragraph, n_lines, family, p_license, p_family, containment, confirmed)`` per licence paragraph."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = LicenseModel(rows)
    cue = r"(?<![a-z0-9])(?:" + "|".join(model.words) + r")(?![a-z0-9])"

    def may_be_license(df: DataFrame, text: str) -> DataFrame:
        return df.where(F.lower(text).rlike(cue)) if model.words else df

    blocks = may_be_license(rows, "text").select("id", F.explode(_paragraphs(F.col("text"))).alias("block"))
    blocks = may_be_license(blocks, "block").withColumn("number", F.monotonically_increasing_id())
    lines = F.split(F.rtrim(F.col("block"), F.lit("\n")), "\n")
    wrapped = F.when(F.size(lines) > 1, F.array("block")).otherwise(F.array().cast("array<string>"))
    units = may_be_license(blocks.select("id", "number", F.explode(F.concat(lines, wrapped)).alias("unit")), "unit")
    start, mark = F.substring_index("unit", "\x01", 1).cast("int"), F.regexp_count("unit", F.lit("\x01"))
    terms = (units.select("id", "number", start.alias("paragraph"), mark.alias("n_lines"),
                          _words(F.regexp_replace("unit", "[0-9]+\x01", "")).alias("words"))
             .where(F.size("words") > 0).withColumn("terms", _terms(F.col("words"))))
    # Written once: Catalyst would otherwise inline the n-grams into every use of the probabilities.
    features = materialize(model.vectorizer.transform(terms).drop("terms"), "license_features")
    hits = model.verdict(features).where("is_license").withColumn(
        "containment", _containment(F.col("words"), F.col("family")))
    known = (F.col("p_family") >= model.threshold) & (F.col("containment") >= min_containment)
    hits = hits.withColumn("confirmed", known)
    # A paragraph of one text at a time: its families, and whether it is confirmed as a whole.
    block, whole = Window.partitionBy("number"), F.col("n_lines") > 1
    of_lines = F.collect_set(F.when(F.col("confirmed") & ~whole, F.col("family"))).over(block)
    kept = (F.when(whole, F.when(F.col("confirmed"), ~F.array_contains(of_lines, F.col("family")))
                   .otherwise(F.min(whole).over(block)))
            .otherwise(F.col("confirmed") | ~F.max(whole & F.col("confirmed")).over(block)))
    return hits.withColumn("_kept", kept).where("_kept").select(
        F.col("id").alias(id_col), "paragraph", "n_lines",
        F.when(F.col("confirmed"), F.col("family")).otherwise(UNKNOWN).alias("family"),
        "p_license", "p_family", "containment", "confirmed")


def op10_license_paragraphs(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))
