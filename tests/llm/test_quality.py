"""The quality network: held-out accuracy, responses by hand, edge cases."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality as q
from tidemark.llm.queries import op13_quality, table

SF = "/root/testdata/sf0.1"


def test_held_out_rows_are_told_apart(spark):
    out = op13_quality(spark, SF)
    rows = out.join(table(spark, SF, "labels"), "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    good = [r for r in rows if r.held_out and r.quality]
    bad = [r for r in rows if r.held_out and not r.quality]
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in good for b in bad]
    assert np.mean(pairs) > 0.97
    assert np.mean([r.predicted for r in good]) > 0.9 and np.mean([r.predicted for r in bad]) < 0.2


def test_scores_are_those_of_the_network(spark):
    model = q.Model.fresh(3)
    model.scale = np.array([3.0, 0.25], np.float32)
    texts = ["", None, "a", "Plain words. " * 3, "é" * 100 + "x" * 157, "x" * q.CHUNK, "x" * (q.CHUNK + 1), "long text of words " * 300]
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t in enumerate(texts)], "doc_id long, text string, score double, _key int")
    out = {r.doc_id: r for r in q.score(docs.unionByName(docs), model).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        scores, a = [], 0
        while True:
            piece = list(raw[a : a + q.CHUNK])
            piece += [q.PAD] * (q.CHUNK + q.WIDTH - 1 - len(piece))
            best = np.full(q.FILTERS, -np.inf)
            for at in range(q.CHUNK):
                window = np.concatenate([model.embedding[b] for b in piece[at : at + q.WIDTH]])
                best = np.maximum(best, window @ model.filters)
            h = np.tanh(np.maximum(best + model.floor, 0) @ model.hidden + model.hidden_floor)
            scores.append(math.tanh(h @ model.out))
            if a + q.CHUNK >= len(raw):
                break
            a += q.STEP
        assert out[i].n_chunks == len(scores)
        assert math.isclose(out[i].score, 1 / (1 + math.exp(-3 * np.mean(scores) - 0.25)), abs_tol=1e-4)


def test_training_follows_the_slope():
    """One step on one document moves the loss down as its slope says."""
    data = np.frombuffer(b"some words here, and more words there. " * 20, np.uint8)
    start, _ = q.chunks(data, np.array([0, len(data)]))
    tables = [q.cut(data, start, np.full(len(start), len(data))), q.cut(np.full(300, 65, np.uint8), np.array([0]), np.array([300]))]
    y = np.array([1.0, 0.0], np.float32)

    def loss(model):
        out = 0
        for table, label in zip(tables, y):
            u = q._chunk_scores(model, q.pooled(model, table)[0])[0].mean()
            p = 1 / (1 + np.exp(-(model.scale[0] * u + model.scale[1])))
            out -= label * np.log(p) + (1 - label) * np.log(1 - p)
        return out

    losses = [loss(q.fit(tables, y, epochs=n, batch=2)) for n in (1, 10, 60)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.1


def test_chunks_cover_every_byte():
    for size in (0, 1, q.STEP, q.CHUNK, q.CHUNK + 1, q.CHUNK + q.STEP, q.CHUNK + q.STEP + 1, 5000):
        start, first = q.chunks(np.zeros(size + 7, np.uint8), np.array([7, 7 + size]))
        assert first[-1] == len(start) and start[0] == 7
        assert start[-1] + q.CHUNK >= 7 + size and (len(start) == 1 or start[-1] + q.CHUNK - q.STEP < 7 + size)


def test_no_labels_empty_tables_repeated_and_null_keys(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a c"), (None, "c"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (4, 1), (None, 0)], "doc_id long, quality int")
    model = q.train(docs, labels)
    assert [r.score for r in q.score(docs, model).collect()] == [0.5] * 4
    assert q.score(docs.where("false"), model).count() == 0 and q.train(docs.where("false"), labels).scale.sum() == 0
    both = spark.createDataFrame([(1, 0), (1, 1), (4, 0)], "doc_id long, quality int")
    assert q.score(docs, q.train(docs, both, skip_held_out=False)).count() == 4
    assert docs.select(q.held_out(F.col("doc_id")).alias("h")).where("doc_id is null").first().h


def test_labelled_rows_are_bounded(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    seen = []
    fit, q.fit = q.fit, lambda tables, y: seen.append((len(tables), float(y.sum()))) or q.Model.fresh(0)
    try:
        q.train(docs, labels, max_labelled=40)
    finally:
        q.fit = fit
    assert seen == [(40, 20.0)]
