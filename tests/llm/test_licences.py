"""Licence notices: known lines found exactly, held-out variants, texts that only sound like notices."""

import re
import textwrap

import numpy as np
import pytest

from tidemark.llm import licences
from tidemark.llm.queries import op2_license_scan, table

SF = "/root/testdata/sf0.01"
# Lines that the given documents carry.
KNOWN = {
    "this work is licensed under the gnu general public license, version 3.": "gpl", "all rights reserved.": "proprietary",
    "licensed under cc by-nc 4.0.": "cc-by-nc", "released under the mit license.": "mit",
    "licensed under the apache license, version 2.0.": "apache-2.0",
}


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(table(spark, SF, "documents"))


def families(spark, model, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, families string")
    return [r.families for r in licences.scan(df, model).orderBy("doc_id").collect()]


def test_given_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = op2_license_scan(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        lines = texts[r.doc_id].lower().split("\n")
        want = [KNOWN[x] for x in lines if x in KNOWN]
        raw = texts[r.doc_id].lower().encode()
        spans = [n.rsplit(":", 2) for n in r.notices.split(",") if n]
        assert [f for f, _, _ in spans] == want and r.families == ",".join(sorted(set(want))) and r.n_notices == len(want)
        assert all(KNOWN[raw[int(a) : int(b)].decode()] == f for f, a, b in spans)
        assert r.n_paragraphs == sum(bool(re.search(r"[0-9a-z]|[^\x00-\x7f]", x)) for x in lines)


def test_held_out_variants(spark, model):
    rng = np.random.default_rng(99)
    texts, want = [], []
    for family, templates in licences.TEMPLATES.items():
        for t in templates:
            for v in licences._variants(t, rng, 6)[1:]:
                texts.append("Some heading\n" + v + "\nmore text")
                want.append(family)
    got = families(spark, model, texts)
    assert np.mean([g == w for g, w in zip(got, want)]) > 0.85
    assert np.mean([g not in ("", w) for g, w in zip(got, want)]) < 0.06


def test_unknown_and_edge_cases(spark, model):
    texts = [
        None, "", "\n\n . \n", "The driver showed his license to the officer.", "Version 2.0 of the report is free of charge.",
        "The general public may use this work.", "x " * 100_000 + "\nReleased under the MIT License.\n" + "y" * 100_000,
        "MIT is a university.", "All Rights Reserved.\nLicensed under CC BY-NC 4.0.\nAll rights reserved.",
    ]
    assert families(spark, model, texts) == ["", "", "", "", "", "", "mit", "", "cc-by-nc,proprietary"]
    df = spark.createDataFrame([(None, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert [r.n_notices for r in licences.scan(df, model).collect()] == [1, 1]
    assert licences.scan(df.where("false"), model).count() == 0
    assert len(licences.train(df.where("false"), max_background=5, per_template=3, steps=5).keys)


# Notices as licence files and source headers carry them.
REAL = {
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.',
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
}


def test_wrapped_notices(spark, model):
    texts, want = [], []
    for family, notice in REAL.items():
        for width in (40, 60, 70, 80):
            for mark in ("", "# ", " * ", "// "):
                body = [mark + x for x in textwrap.wrap(notice, width)]
                for before, after in (("", ""), ("A tool for trees.\n\n", "\n\nThe end of the story."), ("int main of the tree\n", "\nnothing of the kind")):
                    texts.append(before + "\n".join(body) + after)
                    want.append(family)
    got = families(spark, model, texts)
    missed = [(w, g) for g, w in zip(got, want) if g != w]
    assert len(missed) <= 0.1 * len(want), missed


def test_span_of_a_wrapped_notice(spark, model):
    body = "\n".join(" * " + x for x in textwrap.wrap(REAL["bsd"], 60))
    text = "The state of the art\nin the use of forms\n\n" + body + "\n\nAnd the rest"
    r = licences.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()[0]
    (family, a, b), = [n.rsplit(":", 2) for n in r.notices.split(",")]
    assert family == "bsd" and text[int(a) : int(b)] == body and r.n_notices == 1
    # Blank lines part paragraphs, also within a comment, and texts never meet.
    parts = textwrap.wrap(REAL["bsd"], 60)
    apart = [body.replace("\n", "\n\n"), body.replace("\n", "\n *\n"), *parts]
    assert families(spark, model, apart) == [""] * len(apart)
