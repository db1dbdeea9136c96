"""Licence scans: a trained paragraph classifier over sparse word n-grams (DataFrame functions only).

A paragraph is a line, or a run of lines without a blank one between them, as notices are wrapped in licence
files and source headers. Its features are the distinct words and word pairs that the training
vocabulary holds. Multinomial logistic regression with an L1 penalty learns one class
per licence family and a class for everything else, from variations of the templates below
and from every line of half the corpus's documents that the model can be asked about (those with a cue). The threshold of a family's
probability is calibrated on all lines of the other half; below it a paragraph is unknown. A prediction counts
only if the paragraph also covers enough of one of the family's templates. SPDX identifiers are read by their id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, StringIndexer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vendorscope.llm.common import saved

# Notices as their publishers and common practice word them, per family.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under the Creative Commons Attribution license.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Non-commercial use only under the terms of CC BY-NC.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0.",
        "Released into the public domain.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
# Sentences that use the words of notices and license nothing.
OTHERS = [
    "The license of the driver was checked at the border.",
    "She has a license to practise medicine in the state.",
    "Version 2.0 of the software was released in the public beta.",
    "The work is in progress and under review by the author.",
    "The general public may use the library free of charge on sundays.",
    "Copyright law is a difficult subject and all rights are debated.",
    "You must agree to the terms and conditions of sale.",
    "The commons of the university are open to international students.",
    "The museum released the source of the rumour.",
]
NONE = "none"
VARIANTS = 24
LEAST_COVER = 0.6       # of a template's words and pairs that a paragraph must have
FALSE_RATE = 0.001      # share of unlicensed calibration paragraphs above the threshold
OTHERS_WEIGHT = 2000.0  # what all lines of the corpus weigh together in training, beside a weight of 1 for each variation of a template
STEPS = 10_000          # the threshold is one of so many even steps of probability


# Families of SPDX ids, the first that fits.
SPDX = [("apache-2.0", "Apache-2\\.0"), ("bsd", "0?BSD(-.*)?"), ("cc-by-nc", "CC-BY-NC(-.*)?"), ("cc-by-sa", "CC-BY-SA(-.*)?"),
        ("cc-by", "CC-BY-[0-9].*"), ("cc0", "CC0(-.*)?"), ("gpl", "GPL-.*"), ("lgpl", "LGPL-.*"), ("mit", "MIT(-.*)?"),
        ("mpl-2.0", "MPL-2\\.0.*")]
SPDX_LINE = r"(?i)SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)"


def words_of(text):
    """Lower-case words: letters, digits and the signs that licence names use; a final full stop is no part of a word."""
    flat = F.regexp_replace(F.lower(text), r"[^\p{L}\p{Nd}.+-]+", " ")
    flat = F.regexp_replace(flat, r"[.+-]+( |$)", " ")
    return F.filter(F.split(flat, " +"), lambda w: w != "")


def grams_of(words):
    """Distinct words and pairs of neighbouring words."""
    n = F.size(words)
    pairs = F.when(n > 1, F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(1))),
                                     F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(1))),
                                     lambda a, b: F.concat(a, F.lit(" "), b)))
    return F.array_distinct(F.concat(words, F.coalesce(pairs, F.array().cast("array<string>"))))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, paragraph, line): the lines of all texts, numbered from 0."""
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\r?\n")).alias("paragraph", "line"))


def spdx_families(line):
    """The distinct families that a line's SPDX expression names; ids after WITH are exceptions and no licences."""
    ids = F.filter(F.split(F.regexp_replace(F.regexp_extract(line, SPDX_LINE, 1), r"(?i)\bwith[ \t]+[^ \t)]+", " "), r"[() \t]+"),
                   lambda x: x != "")

    def family(x):
        out = F.lit(None).cast("string")
        for name, form in reversed(SPDX):
            out = F.when(x.rlike(f"(?i)^(?:{form})$"), F.lit(name)).otherwise(out)
        return out

    return F.array_distinct(F.filter(F.transform(ids, family), lambda x: x.isNotNull()))


def runs(lines, cued, sizes, longest: int):
    """Array of (paragraph, last, line): from every line that others follow without a blank one, the text up to ``longest`` words.

    ``cued`` and ``sizes`` are columns: whether each line has a cue, and its words, 0 if it is blank. A run is as many lines as hold the words of the longest template, however
    narrow they are, since a line that isn't blank has a word. Runs of one line, and runs with no cue near, are left out.
    """
    def run(i):
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("size"), F.lit(True).alias("open"))

        def step(acc, j):
            size = F.get(sizes, j)
            more = acc["open"] & (size > 0) & (acc["size"] < longest)
            return F.struct((acc["n"] + F.when(more, 1).otherwise(0)).alias("n"),
                            (acc["size"] + F.when(more, size).otherwise(0)).alias("size"), more.alias("open"))

        n = F.aggregate(F.sequence(i, F.least(i + longest, F.size(lines)) - 1), start, step)["n"]
        return F.struct(i.alias("paragraph"), (i + n - 1).alias("last"),
                        F.array_join(F.transform(F.slice(lines, i + 1, F.greatest(n, F.lit(0))), lambda x: F.regexp_replace(
                            x, r"(?i)^\s*(?:dnl|rem)\b", "")), "\n").alias("line"))

    at = F.filter(F.sequence(F.lit(0), F.size(lines) - 1),
                  lambda i: (F.get(sizes, i) > 0) & (F.get(sizes, i) < longest) & (F.coalesce(F.get(sizes, i + 1), F.lit(0)) > 0)
                  & F.exists(F.slice(cued, i + 1, longest), lambda x: x))
    return F.filter(F.transform(at, run), lambda r: r["last"] > r["paragraph"])


@dataclass(frozen=True)
class LicenseModel:
    classes: list[str]
    intercepts: list[float]
    weights: dict[str, list[float]]                 # n-gram -> weight per class, only those not all zero
    threshold: float
    templates: dict[str, list[list[str]]]           # family -> n-grams of each template
    cues: list[str]                                 # a line without one of these words covers no template enough


def _logits(grams, classes: int, intercepts: list[float], weights: dict[str, list[float]]):
    """Logit per class of the n-grams (all in the vocabulary)."""
    by = F.create_map(*[x for g, w in weights.items() for x in (F.lit(g), F.lit(w))])
    rows = F.transform(grams, lambda g: by[g])
    return F.aggregate(rows, F.lit(intercepts), lambda a, w: F.zip_with(a, w, lambda x, y: x + y))


def _scored(df: DataFrame, m_classes: list[str], intercepts: list[float], weights: dict[str, list[float]],
            templates: dict[str, list[list[str]]]) -> DataFrame:
    """``df`` (with ``grams``) with ``family`` and ``probability`` of the most probable class but ``none``.

    ``hits`` are the n-grams that the model or a template knows: one look through the line's n-grams. Rows of which the model knows none
    are kept with a null family and probability: a filter here would be pushed below all this, which would then be computed again for each
    of its conditions.
    """
    known = sorted(set(weights) | {g for ts in templates.values() for t in ts for g in t})
    df = df.withColumn("hits", F.array_intersect("grams", F.lit(known))).drop("grams")
    df = df.withColumn("seen", F.array_intersect("hits", F.lit(sorted(weights))))
    logits = _logits(F.col("seen"), len(m_classes), intercepts, weights)
    df = df.withColumn("logit", F.when(F.size("seen") > 0, logits))
    top = F.array_max("logit")
    # The names ride along in the order of classes; ``none`` can't win here.
    best = F.array_max(F.filter(F.arrays_zip(F.col("logit").alias("l"), F.lit(m_classes).alias("c")), lambda x: x["c"] != NONE))
    rest = F.aggregate("logit", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return (df.withColumn("best", best).withColumn("family", F.col("best")["c"])
            .withColumn("probability", F.exp(F.col("best")["l"] - top) / rest).drop("best"))


def _cues(templates: dict[str, list[list[str]]]) -> list[str]:
    """Words of which a line must have one to cover ``LEAST_COVER`` of any template, long ones (mostly rare) preferred.

    Per template words are taken until the n-grams without any of them are too few to cover it.
    """
    cues: set[str] = set()
    for grams in (t for ts in templates.values() for t in ts):
        words = sorted((g for g in grams if " " not in g), key=lambda w: (-len(w), w))
        taken: set[str] = set()
        while sum(not taken & set(g.split(" ")) for g in grams) >= LEAST_COVER * len(grams):
            taken.add(words[len(taken)])
        cues |= taken
    return sorted(cues)


def _any_of(words: list[str]) -> str:
    """A pattern for exactly these words that shares their beginnings, so that few are tried at each place of a text."""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    parts = [re.escape(c) + _any_of(rest) for c, rest in sorted(heads.items())] + [""] * ("" in words)
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def _cue_pattern(cues: list[str]) -> str:
    return r"(?iu)(?<![\p{L}\p{Nd}])" + _any_of(cues) + r"(?![\p{L}\p{Nd}])"


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenseModel:
    """A model from the templates' variations and all lines of ``docs``: one half of the documents trains, the other calibrates.

    Lines without a cue cover no template enough whatever the model says, so only those with one are looked into; the others count among
    the calibration lines. A line that covers half of any template is not used as an example of ``none``. Lines with the same
    known n-grams are one row with their number as its weight, so nothing is left out.
    """
    spark: SparkSession = docs.sparkSession
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(NONE, t) for t in OTHERS]
    base = spark.createDataFrame(rows, "label string, line string").withColumn("words", words_of(F.col("line")))
    varied = base.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS))))
    # Variation 0 is the template; the others lose about one word in eight.
    kept = F.when(F.col("v") == 0, F.col("words")).otherwise(F.filter(
        "words", lambda w, i: F.pmod(F.xxhash64(w, i, F.col("v"), "line"), F.lit(8)) != 0))
    varied = varied.select("label", grams_of(kept).alias("grams"))
    templates: dict[str, list[list[str]]] = {}
    for r in base.where(F.col("label") != NONE).select("label", grams_of(F.col("words")).alias("g")).collect():
        templates.setdefault(r["label"], []).append(list(r["g"]))  # the rows of TEMPLATES
    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=4096, minDF=2.0, binary=True).fit(
        varied.where(F.col("label") != NONE))
    every = sorted({g for ts in templates.values() for t in ts for g in t} | set(vocabulary.vocabulary))
    cues = _cues(templates)
    cue = _cue_pattern(cues)
    # One pass over the texts: how many lines each half has, and the lines with a cue.
    half = F.pmod(F.xxhash64(F.col(id_col), F.lit("half")), F.lit(2)) == 1
    split = docs.select(half.alias("calibrate"), F.col(text_col).rlike(cue).alias("may"), F.split(F.col(text_col), "\r?\n").alias("l")).select(
        "calibrate", F.size(F.filter("l", lambda x: F.trim(x) != "")).alias("n"),
        F.when(F.col("may"), F.filter("l", lambda x: x.rlike(cue))).alias("cued"))
    # Rows without lines go when read back: a filter on ``n`` before would split every text twice.
    split = saved(split, "licence-lines").where(F.col("n") > 0)
    count = split.where("calibrate").agg(F.sum("n")).first()[0] or 0
    lines = split.select("calibrate", F.explode("cued").alias("line"))
    lines = lines.select("calibrate", F.array_sort(F.array_intersect(grams_of(words_of(F.col("line"))), F.lit(every))).alias("grams"))
    lines = lines.groupBy("calibrate", "grams").agg(F.count("*").alias("n"))
    near = F.lit(False)
    for g in (t for ts in templates.values() for t in ts):
        near = near | (F.size(F.array_intersect("grams", F.lit(g))) >= 0.5 * len(g))
    lines = saved(lines.withColumn("near", near), "licence-others")
    licensed = lines.where("calibrate AND near").agg(F.sum("n")).first()[0] or 0
    free = lines.where(~F.col("near"))
    others = free.where("NOT calibrate")
    total = others.agg(F.sum("n")).first()[0] or 1
    known = saved(varied.withColumn("weight", F.lit(1.0)).unionByName(
        others.select(F.lit(NONE).alias("label"), "grams", (F.col("n") * (OTHERS_WEIGHT / total)).alias("weight"))), "licence-known")
    names = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc").fit(varied)
    fitted = LogisticRegression(labelCol="y", featuresCol="features", weightCol="weight", family="multinomial", elasticNetParam=1.0,
                                regParam=0.002, maxIter=60).fit(names.transform(vocabulary.transform(known)))
    matrix = fitted.coefficientMatrix.toArray()
    weights = {g: [float(x) for x in matrix[:, i]] for i, g in enumerate(vocabulary.vocabulary) if abs(matrix[:, i]).max() > 0}
    intercepts, classes = [float(x) for x in fitted.interceptVector], list(names.labels)
    tested = _scored(free.where("calibrate").select("grams", "n"), classes, intercepts, weights, templates)
    # At most ``STEPS`` + 1 numbers: the unlicensed lines by the step of their probability, the largest first.
    steps = tested.groupBy(F.ceil(F.col("probability") * STEPS).alias("step")).agg(F.sum("n").alias("n")).orderBy(F.col("step").desc()).collect()
    allowed, threshold = int((count - licensed) * FALSE_RATE), 0.5
    for r in steps:
        if r["step"] is None:  # no n-gram that the model knows
            continue
        allowed -= r["n"]
        if allowed < 0:
            threshold = r["step"] / STEPS
            break
    return LicenseModel(classes, intercepts, weights, max(0.5, min(0.99, threshold)), templates, cues)


def license_lines(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, paragraph, family, probability, cover, line): the licence paragraphs of all texts.

    ``paragraph`` is the (first) line's number from 0, ``cover`` the largest share of one of the family's templates
    (words and pairs) that the paragraph has. Lines that confirm a family alone are given as they are; a run of lines
    is given where no line of it does so for its family, and of runs that overlap the one of largest cover, the last of
    equals. Paragraphs without a known n-gram, below the calibrated threshold or
    that cover less than ``LEAST_COVER`` of every template of the family give no row. A line with an SPDX identifier of a known
    family gives a row of probability and cover 1 for each family named. Null and empty texts
    give none; null ids are kept; repeated rows give repeated rows; an empty table gives an empty one.
    Other columns are not read. Only the few paragraphs found are shuffled, to settle runs that overlap.
    """
    # A text, and then a line, without any cue has no line that could be confirmed: what follows costs much more.
    cue = _cue_pattern(model.cues)
    longest = max((sum(" " not in g for g in t) for ts in model.templates.values() for t in ts), default=1) * 2
    lines = F.split(F.col(text_col), "\r?\n")
    texts = (docs.where(F.col(text_col).rlike(cue) | F.col(text_col).rlike(SPDX_LINE))
             .select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), lines.alias("lines"))
             .withColumns({"cued": F.transform("lines", lambda x: x.rlike(cue) | x.rlike(SPDX_LINE)),
                           # A line of comment signs alone is blank.
                           "sizes": F.transform("lines", lambda x: F.when(
                               x.rlike(r"[\p{L}\p{Nd}]"), F.size(F.split(F.trim(x), r"\s+"))).otherwise(0))}))
    single = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("paragraph"), i.alias("last"), x.alias("line"))),
                      lambda x: F.get("cued", x["paragraph"]))
    parts = texts.select("doc_id", "row", F.explode(F.concat(
        single, runs(F.col("lines"), F.col("cued"), F.col("sizes"), longest))).alias("p"))
    parts = parts.select("doc_id", "row", "p.*").where(
        (F.col("paragraph") == F.col("last")) | F.col("line").rlike(cue)).withColumn(
        "named", F.when(F.col("paragraph") == F.col("last"), spdx_families(F.col("line"))).otherwise(F.array().cast("array<string>")))
    # Identifiers and predictions come from one pass over the texts: what a paragraph gives is exploded, with no union and no filter between.
    words = F.when(F.size("named") == 0, words_of(F.col("line")))
    scored = _scored(parts.withColumn("words", words).withColumn("grams", grams_of(F.col("words"))).drop("words"), model.classes,
                     model.intercepts, model.weights, model.templates)
    cover = F.lit(0.0)
    for family, ts in model.templates.items():
        shares = [F.size(F.array_intersect("hits", F.lit(g))) / float(len(g)) for g in ts]
        cover = F.when(F.col("family") == family, F.greatest(*shares, F.lit(0.0))).otherwise(cover)
    scored = scored.withColumn("cover", F.when(F.col("probability") >= model.threshold, cover))

    def answer(family, probability, cover):
        return F.struct(family.alias("family"), probability.alias("probability"), cover.alias("cover"))

    answers = F.when(F.size("named") > 0, F.transform("named", lambda f: answer(f, F.lit(1.0), F.lit(1.0)))).when(
        F.col("cover") >= LEAST_COVER, F.array(answer(F.col("family"), F.col("probability"), F.col("cover"))))
    found = scored.select("doc_id", "row", "paragraph", "last", "line", F.explode(answers).alias("a")).select(
        "doc_id", "row", "paragraph", "last", "a.*", "line")
    # Paragraphs of a text and family that overlap are one group: none of them starts after all before have ended.
    order = Window.partitionBy("row", "family").orderBy("paragraph", "last")
    ended = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce(F.col("paragraph") > ended, F.lit(True)).cast("int"))
    found = found.withColumn("group", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    group = Window.partitionBy("row", "family", "group")
    alone = F.col("paragraph") == F.col("last")
    found = (found.withColumn("alone", alone).withColumn("any", F.max(alone).over(group))
             .withColumn("place", F.row_number().over(group.orderBy(F.col("cover").desc(), F.col("paragraph").desc()))))
    return found.where(F.col("alone") | (~F.col("any") & (F.col("place") == 1))).select(
        "doc_id", "paragraph", "family", "probability", "cover", "line")
