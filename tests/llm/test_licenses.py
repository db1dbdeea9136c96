"""Licence scans: every template line of the corpus is found, prose isn't, awkward rows are defined."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from vendorscope.llm import licenses as L
from vendorscope.llm.common import table


@pytest.fixture(scope="module")
def model(spark):
    return L.train(table(spark, SF_CHECK, "documents"))


def test_corpus_lines(spark, model):
    docs = table(spark, SF_CHECK, "documents")
    exact = {t: f for f, ts in L.TEMPLATES.items() for t in ts}
    want = {(r.doc_id, n, exact[line]) for r in docs.collect() for n, line in enumerate((r.text or "").split("\n")) if line in exact}
    got = {(r.doc_id, r.paragraph, r.family) for r in L.license_lines(docs, model).collect()}
    assert want and got == want


def test_variants_and_negatives(spark, model, odd_docs, no_docs):
    lines = ["this file is licensed under the apache license, version 2.0", "Permission is hereby granted, free of charge, to any person obtaining "
             "a copy of this software and associated documentation files", "licensed under cc by-sa 4.0", "Released under the BSD 3-clause license",
             "The general public may read version 3 of the work.", "He is under no license to release the work.", "", "plain words"]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, None)], "doc_id long, text string")
    got = {r.paragraph: r.family for r in L.license_lines(docs, model).collect()}
    assert got == {0: "apache-2.0", 1: "mit", 2: "cc-by-sa", 3: "bsd"}
    assert L.license_lines(odd_docs, model).collect() == []
    assert L.license_lines(no_docs, model).collect() == []


def test_training_on_nothing(no_docs, odd_docs):
    assert L.license_lines(odd_docs, L.train(no_docs)).collect() == []


def test_wrapped_notices_and_identifiers(spark, model):
    mit = """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 */"""
    bsd = """Copyright (c) 2020, The Authors

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice."""
    gpl = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
    ids = "// SPDX-License-Identifier: GPL-2.0-only\nx\n# SPDX-License-Identifier: (MIT OR Apache-2.0)\n# SPDX-License-Identifier: AGPL-3.0-only"
    prose = "The state of the museum was\nreviewed in the public\nlibrary on sundays."
    texts = [mit, bsd, gpl, ids, prose]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.paragraph, r.family) for r in L.license_lines(docs, model).collect())
    assert got == [(0, 1, "mit"), (1, 2, "bsd"), (2, 0, "gpl"), (3, 0, "gpl"), (3, 2, "apache-2.0"), (3, 2, "mit")]


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_one_pass_over_the_texts(spark, model):
    # Texts were read and searched twice, once for identifiers, and words cut anew for each condition on what was made of them.
    plan = _plan(L.license_lines(table(spark, SF_CHECK, "documents"), model))
    assert plan.count("Relation [") == 1
    assert plan.count(r"[^\p{L}\p{Nd}.+-]+") == 1


def test_training_splits_a_text_once(spark, monkeypatch):
    seen, keep = {}, L.saved
    monkeypatch.setattr(L, "saved", lambda df, name: seen.setdefault(name, _plan(df)) and keep(df, name))
    L.train(table(spark, SF_CHECK, "documents"))
    assert seen["licence-lines"].count("split(") == 1


def test_cue_pattern_finds_the_cues_alone(spark, model):
    texts = sorted({x for c in model.cues for x in (c, c.upper(), f"a {c}, b", f"x{c}", f"{c}x", f"é{c}", f"{c}4", c[:-1], c[1:])})

    def plain(text):
        return any(re.search(rf"(?<![^\W_]){re.escape(c)}(?![^\W_])", text, re.I) for c in model.cues)

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.m for r in df.select("t", F.col("t").rlike(L._cue_pattern(model.cues)).alias("m")).collect()}
    assert got == {t: plain(t) for t in texts} and set(got.values()) == {True, False}


def test_identifiers_beside_notices_and_repeated_rows(spark, model):
    text = "Licensed under CC BY-SA 4.0.\r\n\r\nxSPDX-License-Identifier: (MIT OR Apache-2.0)\r\n\r\nreleased under the library"
    rows = [(None, text), (None, text), (5, None), (6, ""), (7, "SPDX-License-Identifier: none-such")]
    got = sorted((str(r.doc_id), r.paragraph, r.family, r.probability == 1.0, r.cover) for r in L.license_lines(
        spark.createDataFrame(rows, "doc_id long, text string"), model).collect())
    once = [("None", 0, "cc-by-sa", False, 1.0), ("None", 2, "apache-2.0", True, 1.0), ("None", 2, "mit", True, 1.0)]
    assert got == sorted(once * 2)
