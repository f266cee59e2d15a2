"""Embedding links against all pairs; components against a plain search."""

import random

import numpy as np
import pytest

from tidemark.llm import vectors
from tidemark.llm.components import components
from tidemark.llm.queries import op9_embedding_dedup, table


def brute(rows, threshold=0.93):
    """rows: (id, vector, label), ids unique."""
    use = [
        r for r in rows
        if r[0] is not None and r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    ]
    links = {r[0]: set() for r in rows}
    for place, (i, v, y) in enumerate(use):
        v = np.array(v, np.float64)
        for j, w, z in use[:place]:
            if y == z and len(v) == len(w):
                w = np.array(w, np.float64)
                if v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = {}
    for start in sorted((k for k in links if k is not None)):
        if start not in out:
            todo = [start]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = start
                    todo += links[x]
    return {i: (len(links[i]), out[i]) for i in out}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_given_vectors(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, folder, "embeddings").collect()]
    out = op9_embedding_dedup(spark, folder)
    assert found(out) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.collect())


@pytest.mark.parametrize("block", [2_000, 7])
def test_planted_vectors(spark, block):
    rng = np.random.default_rng(4)
    rows = []
    for group in range(12):
        base = rng.normal(size=12)
        for copy in range(10):
            noise = rng.normal(size=12) * rng.choice([0, 0.1, 0.25])
            rows.append((len(rows), [float(np.float32(x)) for x in (base + noise) * rng.choice([1, 30])], group % 3))
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 12, 1), (503, [None] + [1.0] * 11, 1), (504, [float("nan")] * 12, 1)]
    rows += [(505, rows[0][1], None), (506, rows[0][1][:3], 0), (507, rows[0][1][:3], 0), (508, [1e30] * 12, 2), (509, [1e30] * 12, 2)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    assert found(vectors.near_duplicates(df, block=block)) == brute(rows)


def test_nulls_repeats_and_empty(spark):
    v = [1.0, 2.0]
    df = spark.createDataFrame([(1, v, 1), (1, v, 1), (None, v, 1), (2, [1.0, 2.1], 1)], "vec_id long, embedding array<double>, label int")
    rows = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect())
    assert rows == [("1", 2, 1, True), ("1", 2, 1, True), ("2", 2, 1, False), ("None", 0, None, True)]
    assert vectors.near_duplicates(df.where("false")).count() == 0


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(50)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
