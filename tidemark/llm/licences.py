"""Licence scan: a trained paragraph classifier, then a comparison with the family's templates.

Paragraphs are single lines and, for notices wrapped over several lines, runs of adjoining lines that
hold word pairs of one template. They are scored by multinomial logistic regression on sparse hashed
word 1-, 2- and 3-grams. One class is ``unknown``: ordinary paragraphs. Probabilities are calibrated by
a temperature fitted on rows that did not train. A predicted family counts when a template of that
family shares enough of its word pairs with the paragraph.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import END, Lookup, Words, blocks, closed, mixed

# Notices by family.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the MIT License.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced or transmitted in any form without prior written permission.",
        "Copyright. All rights reserved.",
        "This document is confidential and proprietary.",
    ),
}
FAMILIES = ("unknown", *TEMPLATES)
BITS = 16  # of hashed features in training


@dataclass(frozen=True)
class Model:
    """Weights of the n-grams of training, the bias, the temperature and the templates' word pairs."""

    keys: np.ndarray
    weights: np.ndarray  # (keys, families)
    bias: np.ndarray
    temperature: float
    pair_keys: np.ndarray
    pair_of: np.ndarray  # (pairs, templates), whether the template has the pair
    pair_count: np.ndarray
    family_of: np.ndarray


def _column(texts: list[str]) -> pa.Array:
    return pa.array([t.lower().encode() + bytes([END]) for t in texts], pa.binary())


class Paragraphs:
    """Non-empty lines of one block with the hashes of their word n-grams (paragraph, hash)."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        data = words.data[:-8]
        end = np.flatnonzero((data == 10) | (data == END))
        start = np.concatenate([[0], end[:-1] + 1])
        first = np.searchsorted(words.start, np.append(start, len(data)))
        keep = np.diff(first) > 0
        self.start, self.end, self.line = start[keep], end[keep], np.flatnonzero(keep)
        self.text = np.searchsorted(words.bounds, self.start, "right") - 1
        self.bounds, self.data = words.bounds, data
        h = words.hashes()
        self.of_word = paragraph = np.searchsorted(self.start, words.start, "right") - 1
        self.grams = []
        for n in (1, 2, 3):
            out = np.zeros(max(0, len(h) - n + 1), np.uint64)
            for k in range(n):
                out = mixed(out + h[k : len(h) - n + 1 + k] + np.uint64(n))
            if n == 2:
                self.pairs = out  # those across two lines, too
            inside = paragraph[: len(out)] == paragraph[n - 1 :][: len(out)]
            self.grams.append((paragraph[: len(out)][inside], out[inside]))

    def __len__(self) -> int:
        return len(self.start)

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether line ``b`` stands right below line ``a``, without a wordless line between."""
        return (self.line[b] == self.line[a] + 1) & (self.text[a] == self.text[b])

    def joined(self, runs: list[tuple[int, int]]) -> Paragraphs:
        """Each run of lines, first and last included, as one paragraph."""
        raw = [self.data[self.start[a] : self.end[b]].tobytes().replace(b"\n", b" ") for a, b in runs]
        return Paragraphs(pa.array([x + bytes([END]) for x in raw], pa.binary()))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([g[0] for g in self.grams]), np.concatenate([g[1] for g in self.grams])


def _variants(template: str, rng: np.random.Generator, n: int) -> list[str]:
    """The template as it stands in the wild: parts dropped, words in front and after, other case."""
    words, out = template.split(), [template]
    around = ["Copyright", "(c)", "2021", "Authors", "see", "the", "file", "project", "code", "and", "docs", "Note:"]
    while len(out) < n:
        kept = [w for w in words if rng.random() > 0.08] or words
        if len(words) > 12 and rng.random() < 0.3:
            kept = kept[: len(kept) * 2 // 3]
        before = rng.choice(around, rng.integers(0, 4)).tolist()
        text = " ".join([*before, *kept, *rng.choice(around, rng.integers(0, 3)).tolist()])
        out.append(text.upper() if rng.random() < 0.1 else text)
    return out


def _negatives(rng: np.random.Generator, n: int) -> list[str]:
    """Paragraphs of licence-like words that are no notice."""
    pool = sorted({w for ts in TEMPLATES.values() for t in ts for w in t.lower().split()})
    plain = ["the", "driver", "showed", "his", "license", "to", "officer", "public", "version", "of", "work", "and", "was", "free", "software"]
    return [" ".join(rng.choice(pool if k % 2 else plain, rng.integers(2, 16))) for k in range(n)]


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", max_background: int = 300, per_template: int = 60, steps: int = 120) -> Model:
    """Fit on variants of the templates and on the paragraphs of at most ``max_background`` documents.

    Background paragraphs with a template's word triple are left out; the others are ``unknown``.
    Which documents serve is decided by a hash of key and text.
    """
    rng = np.random.default_rng(11)
    texts, label = [], []
    flat = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    for family, template in flat:
        for v in _variants(template, rng, per_template):
            texts.append(v)
            label.append(FAMILIES.index(family))
    made = _negatives(rng, 1_500)
    hashed = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("t"), F.xxhash64(key, text).alias("h"))
    # At most max_background hashes: safe to broadcast. Texts leave their tasks only once they are chosen.
    chosen = F.broadcast(hashed.select("h").distinct().orderBy("h").limit(max_background))
    some = [r.t for r in hashed.join(chosen, "h").dropDuplicates(["h"]).orderBy("h").collect()]
    lines = [x for t in some for x in t.split("\n") if x.strip()]
    triples = set()
    for _, t in flat:
        triples.update(Paragraphs(_column([t])).grams[2][1].tolist())
    if lines:
        p = Paragraphs(_column([x.replace("\n", " ") for x in lines]))
        noted = np.zeros(len(p), bool)
        at, h = p.grams[2]
        noted[at[np.isin(h, np.array(sorted(triples), np.uint64))]] = True
        lines = [lines[t] for t in p.text[~noted]]
    texts += made + lines
    label += [0] * (len(made) + len(lines))

    y = np.array(label)
    p = Paragraphs(_column([t.replace("\n", " ") for t in texts]))
    y = y[p.text]
    at, h = p.features()
    # Only n-grams of notices carry weight, in training, calibration and use; paragraphs without any are never scored.
    keep = np.isin(h, np.unique(h[y[at] > 0]))
    rows, at = np.unique(at[keep], return_inverse=True)
    h, y = h[keep], y[rows]
    slot = (h >> np.uint64(64 - BITS)).astype(np.int64)
    fits = rng.random(len(y)) < 0.8
    share = np.bincount(y, minlength=len(FAMILIES)).astype(float)
    weight = 1 / np.maximum(share, 1)[y]
    w, b = np.zeros((1 << BITS, len(FAMILIES))), np.zeros(len(FAMILIES))
    gw, gb = np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    order = np.argsort(at, kind="stable")
    at, h, slot = at[order], h[order], slot[order]
    cut = np.searchsorted(at, np.arange(len(y)))
    one = np.eye(len(FAMILIES))[y]
    used = np.unique(slot)
    where = np.searchsorted(used, slot)
    w, gw = w[used], gw[used]

    def margins() -> np.ndarray:
        return np.add.reduceat(w[where], cut, 0) + b

    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    by_slot = np.argsort(where, kind="stable")
    slot_cut = np.searchsorted(where[by_slot], np.arange(len(used)))
    for _ in range(steps):
        d = (softmax(margins()) - one) * (weight * fits)[:, None]
        g = np.add.reduceat(d[at[by_slot]], slot_cut, 0) + 1e-5 * w
        gw += g * g
        w -= 0.1 * g / np.sqrt(gw)
        g = d.sum(0)
        gb += g * g
        b -= 0.1 * g / np.sqrt(gb)
    # Calibration on the rows that did not train.
    z, held = margins(), ~fits
    scale = np.linspace(0.3, 4, 38)
    loss = [-(weight[held] * np.log(softmax(z[held] / t)[np.arange(held.sum()), y[held]] + 1e-12)).sum() for t in scale]
    temperature = float(scale[int(np.argmin(loss))])

    keys, place = np.unique(h, return_index=True)
    pairs = [np.unique(Paragraphs(_column([t])).grams[1][1]) for _, t in flat]
    pair_keys = np.unique(np.concatenate(pairs))
    return Model(
        keys, w[where[place]], b, temperature, pair_keys, np.stack([np.isin(pair_keys, x) for x in pairs], 1),
        np.array([len(x) for x in pairs]), np.array([FAMILIES.index(f) for f, _ in flat]),
    )


def classify(p: Paragraphs, model: Model, lookup: Lookup, pairs: Lookup, least: float, confirm: float) -> tuple[np.ndarray, ...]:
    """Paragraphs that are notices: (place, family, probability, share of the template found)."""
    at, h = p.features()
    row = lookup(h)
    hit = np.flatnonzero(row)
    z = np.zeros((len(p), len(FAMILIES)))
    np.add.at(z, at[hit], model.weights[row[hit] - 1])
    some = np.unique(at[hit])
    z = (z[some] + model.bias) / model.temperature
    e = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
    probability = e / e.sum(1, keepdims=True) if len(z) else z
    family = probability.argmax(1) if len(z) else np.zeros(0, np.int64)
    sure = (family > 0) & (probability[np.arange(len(some)), family] >= least)
    some, family, probability = some[sure], family[sure], probability[np.arange(len(sure)), family][sure]
    # Templates of the family, by the share of their word pairs in the paragraph.
    at, h = p.grams[1]
    row = pairs(h)
    keep = (row > 0) & np.isin(at, some)
    seen = np.unique(np.stack([at[keep], row[keep] - 1]), axis=1) if keep.any() else np.zeros((2, 0), np.int64)
    found = np.zeros((len(some), len(model.pair_count)))
    np.add.at(found, np.searchsorted(some, seen[0]), model.pair_of[seen[1]])
    share = np.where(model.family_of == family[:, None], found / model.pair_count, 0).max(1, initial=0)
    good = share >= confirm
    return some[good], family[good], probability[good], share[good]


def wrapped(p: Paragraphs, model: Model, pairs: Lookup, confirm: float) -> list[tuple[int, int]]:
    """Runs of two or more adjoining lines that together hold enough word pairs of one template.

    Each line of a run holds such a pair, whole or as one end of a pair across lines. Lines at either
    end whose pairs all recur within the run are left out.
    """
    row = pairs(p.pairs)
    at = np.flatnonzero(row)
    first, last = p.of_word[at], p.of_word[at + 1]
    on = first == last
    on[~on] = p.follows(first[~on], last[~on])
    at, first, last = at[on], first[on], last[on]
    hit, template = np.nonzero(model.pair_of[row[at] - 1])
    pair = row[at][hit]
    if not len(hit):
        return []
    many = len(model.pair_keys) + 1
    held = np.unique((np.tile(template, 2) * len(p) + np.concatenate([first[hit], last[hit]])) * many + np.tile(pair, 2))
    template, line, pair = held // many // len(p), held // many % len(p), held % many
    new = (template[1:] != template[:-1]) | ((line[1:] != line[:-1]) & ~p.follows(line[:-1], line[1:]))
    run = np.concatenate([[0], np.cumsum(new)])
    distinct = np.bincount(np.unique(run * many + pair) // many)
    cut = np.append(np.flatnonzero(np.concatenate([[True], new])), len(run))
    enough = distinct >= confirm * model.pair_count[template[cut[:-1]]]
    out = set()
    for k in np.flatnonzero(enough & (line[cut[1:] - 1] > line[cut[:-1]])).tolist():
        lines, of = line[cut[k] : cut[k + 1]].tolist(), pair[cut[k] : cut[k + 1]].tolist()
        seen = Counter(of)
        low, high = 0, len(lines)
        for step in (1, -1):
            while lines[low] < lines[high - 1]:
                end = lines[low] if step == 1 else lines[high - 1]
                n = next((i for i in range(high - low) if (lines[low + i] if step == 1 else lines[high - 1 - i]) != end), high - low)
                gone = of[low : low + n] if step == 1 else of[high - n : high]
                if any(seen[x] == 1 for x in gone):
                    break
                seen.subtract(gone)
                low, high = (low + n, high) if step == 1 else (low, high - n)
        if lines[low] < lines[high - 1]:
            out.add((lines[low], lines[high - 1]))
    return sorted(out)


def notices(p: Paragraphs, model: Model, lookup: Lookup, pairs: Lookup, least: float, confirm: float) -> list[tuple[int, int, int]]:
    """(first line, last line, family) of every notice; a run counts unless it meets a better notice of its family.

    Single lines come before runs, then the greater share of the template, the shorter run, the earlier one.
    """
    place, family, _, _ = classify(p, model, lookup, pairs, least, confirm)
    found = [(i, i, f) for i, f in zip(place.tolist(), family.tolist())]
    runs = wrapped(p, model, pairs, confirm)
    if not runs:
        return found
    place, family, _, share = classify(p.joined(runs), model, lookup, pairs, least, confirm)
    better = sorted((-x, runs[i][1] - runs[i][0], *runs[i], f) for i, f, x in zip(place.tolist(), family.tolist(), share.tolist()))
    taken = {(i, f) for i, _, f in found}
    for _, _, a, b, f in better:
        if not any((i, f) in taken for i in range(a, b + 1)):
            taken.update((i, f) for i in range(a, b + 1))
            found.append((a, b, f))
    return sorted(found)


def scan(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = 0.5, confirm: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: (key, n_paragraphs, n_notices, families, notices).

    ``families`` lists the families found, sorted and comma-joined; ``notices`` lists
    ``family:start:end`` in UTF-8 bytes of the lower-cased text, by line. ``n_paragraphs`` counts
    lines with a word; a notice is one such line or a run of adjoining ones; whole texts are read. Null and empty texts have none. Repeated rows stay
    repeated, other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.keys, np.arange(1, len(model.keys) + 1))
        pairs = Lookup(model.pair_keys, np.arange(1, len(model.pair_keys) + 1))
        for block in blocks(batches, "text"):
            p = Paragraphs(block.column("text"))
            found: list[list[str]] = [[] for _ in range(block.num_rows)]
            names: list[set[str]] = [set() for _ in range(block.num_rows)]
            for first, last, f in notices(p, model, lookup, pairs, least, confirm):
                t = p.text[first]
                found[t].append(f"{FAMILIES[f]}:{p.start[first] - p.bounds[t]}:{p.end[last] - p.bounds[t]}")
                names[t].add(FAMILIES[f])
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"), pa.array(np.bincount(p.text, minlength=block.num_rows), pa.int64()),
                    pa.array([len(x) for x in found], pa.int64()), pa.array([",".join(sorted(x)) for x in names], pa.string()),
                    pa.array([",".join(x) for x in found], pa.string()),
                ],
                names=["id", "n_paragraphs", "n_notices", "families", "notices"],
            )

    rows = docs.select(F.col(key).alias("id"), closed(F.col(text)).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_paragraphs long, n_notices long, families string, notices string")
    return out.withColumnRenamed("id", key)
