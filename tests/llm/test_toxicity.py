"""The toxicity model: held-out accuracy, noisy-or by hand, edge cases."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.queries import op10_toxicity, table
from tidemark.llm.words import END, Words

SF = "/root/testdata/sf0.01"


def key_of(text, k=None):
    words = Words(pa.array([text.encode() + bytes([END])], pa.binary()))
    return int((words.hashes() if k is None else words.heads(k))[0])


def test_held_out_rows_are_told_apart(spark):
    out = op10_toxicity(spark, SF)
    assert out.count() == table(spark, SF, "documents").count()
    rows = out.join(table(spark, SF, "labels"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    clean = [r for r in held if not r.toxic]
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean]
    assert np.mean(pairs) > 0.85


def test_scores_are_noisy_or_of_sentences(spark):
    texts = ["You are scum. Nice day! scum\nscums", "", None, "clean words only.", "Scum " * 3 + "é" * 4000, "...", "tail scum"]
    weights = {key_of("scum"): 9.5, key_of("scum", 4): 0.25, key_of("nice"): -2.0}
    model = toxicity.Model(np.array(list(weights), np.uint64), np.array(list(weights.values())), -9.0)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    out = {r.doc_id: r for r in toxicity.score(docs.unionByName(docs), model).collect()}
    for i, text in enumerate(texts):
        none = 1.0
        for sentence in re.findall(r"[^.!?\n]*[.!?\n]|[^.!?\n]+$", (text or "").lower()):
            z = -9.0
            for word in re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", sentence):
                z += weights.get(key_of(word), 0)
                z += sum(weights.get(key_of(word, k), 0) for k in toxicity.HEADS if len(word.encode()) >= k)
            none *= 1 - (1 / (1 + math.exp(-z)) if len(sentence) > 1 else 0)
        assert math.isclose(out[i].score, 1 - none, abs_tol=1e-9)
        assert out[i].predicted == int(1 - none >= 0.7)
    raw = texts[0].encode()
    spans = [tuple(map(int, s.split(":"))) for s in out[0].offending.split(",")]
    assert [raw[a:b].strip() for a, b in spans] == [b"You are scum.", b"scum"]


def test_no_labels_empty_tables_repeated_keys(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert all(r.score < 1e-9 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert docs.select(toxicity.held_out(F.col("doc_id")).alias("h")).where("doc_id is null").first().h


def test_length_alone_is_not_toxic(spark):
    weights = {key_of("scum"): 9.5, key_of("nice"): -1.0}
    model = toxicity.Model(np.array(list(weights), np.uint64), np.array(list(weights.values())), toxicity.MOST_BIAS)
    texts = ["a clean line\n" * 100_000, "a nice line\n" * 100_000, "a clean line\n" * 100_000 + "scum scum"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert [out[i].predicted for i in range(3)] == [0, 0, 1] and out[0].n_sentences == 100_001
    assert sorted(r.doc_id for r in toxicity.drop_toxic(docs, model).collect()) == [0, 1]


def test_training_counts_sentences_without_features_once():
    keys = np.array([3], np.uint64)

    def fit(length):
        n = np.array([2, 2, length, length])
        first = np.concatenate([[0], np.cumsum(n)])
        return toxicity._fit(np.array([1.0, 1, 0, 0]), first, first[:2], np.zeros(2, np.int64), keys, 50, 4e-4)

    short, long = fit(2), fit(50_000)
    assert short.bias == long.bias and (short.weights == long.weights).all()
