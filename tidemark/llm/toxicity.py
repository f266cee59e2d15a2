"""Toxicity by multiple-instance learning: sentences are scored, labels are known for documents only.

A sentence's probability is logistic in its words and word beginnings; a document's is the noisy-or
of its sentences, where all those without evidence count as one. Training follows the gradient of the documents' likelihood, so that the model itself
finds out which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.clashes import set_aside
from tidemark.llm.words import END, Lookup, Words, blocks, closed
from tidemark.session import stage

HEADS = (4, 5, 6)  # word beginnings of so many bytes are features beside whole words
# All sentences without evidence count as one, which stays below this log-odds: length alone makes no document toxic.
MOST_BIAS = -9.0
# Chi-squared that a feature's excess in toxic rows must reach; of a million features none gets there by chance.
LEAST_CHI = 24.0
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"] + [END]] = True


def held_out(key: Column) -> Column:
    """Rows that never train: crc32 of the key's text leaves 1 modulo 3. A null key is held out."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 3 == 1, F.lit(True))


class Sentences:
    """Features of the sentences of one block; a sentence ends at ``. ! ?``, a line's or the text's end."""

    def __init__(self, column: pa.Array):
        words = Words(column)
        ends = np.flatnonzero(_ENDS[words.data[:-8]]) + 1
        self.end = ends
        self.start = np.concatenate([[0], ends[:-1]])
        self.first = np.searchsorted(ends, words.bounds[:-1], "right")
        self.first = np.concatenate([self.first, [len(ends)]])
        self.bounds = words.bounds
        self.sentence = np.searchsorted(ends, words.start, "right")
        self.features = [words.hashes(), *[words.heads(k) for k in HEADS]]


@dataclass(frozen=True)
class Model:
    """Weights of feature hashes and the bias; small, and fitted once."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each feature of a block the rows, and the toxic rows, that it stands in."""
    for block in blocks(batches, "text"):
        s = Sentences(block.column("text"))
        text = np.searchsorted(s.first, s.sentence, "right") - 1
        h, text = np.concatenate(s.features), np.concatenate([text] * len(s.features))
        h, text = h[h != 0], text[h != 0]
        order = np.lexsort((text, h))
        h, text = h[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        h, bad = h[new], block.column("toxic").to_numpy()[text[new]]
        keys, first, n = np.unique(h, return_index=True, return_counts=True)
        bad = np.add.reduceat(bad, first) if len(h) else bad
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(n, pa.int64()), pa.array(bad.astype(np.int64))], names=["h", "n", "bad"]
        )


def _hits(keys: np.ndarray):
    """For each row its sentences, and the places of ``keys`` in them as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(keys, np.arange(1, len(keys) + 1))
        for block in blocks(batches, "text"):
            s = Sentences(block.column("text"))
            place = np.concatenate([lookup(f) for f in s.features])
            sentence = np.concatenate([s.sentence] * len(s.features))[place > 0]
            pairs = np.unique(sentence << 32 | place[place > 0] - 1)
            sentence, place = pairs >> 32, pairs & 0xFFFFFFFF
            cut = np.searchsorted(sentence, s.first)
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": block.column("toxic"),
                    "sentences": pa.array(np.diff(s.first), pa.int64()),
                    "at": [(sentence[a:b] - f).tobytes() for a, b, f in zip(cut, cut[1:], s.first)],
                    "place": [place[a:b].tobytes() for a, b in zip(cut, cut[1:])],
                }
            )

    return run


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_labelled: int = 4_000, least: int = 3, steps: int = 200, l1: float = 4e-4, skip_held_out: bool = True,
) -> Model:
    """Fit on at most ``max_labelled`` labelled rows, half of either label where there are so many.

    Which rows is decided by a hash of the key, never by their order. Null labels and
    keys do not train; of a repeated key one label counts, the greater one. Features must
    stand in ``least`` of the rows. Without labels of both kinds every score is below 1e-9.
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & F.col("_key").isNotNull())
    if skip_held_out:
        known = known.where(~held_out(F.col("_key")))
    known = known.groupBy("_key").agg(F.max("toxic").alias("toxic"))
    half = [
        known.where(F.col("toxic") == y).orderBy(F.xxhash64("_key"), "_key").limit(max_labelled // 2) for y in (0, 1)
    ]
    # At most max_labelled keys: safe to broadcast.
    chosen = F.broadcast(half[0].unionByName(half[1]))
    rows = docs.select(F.col(key).alias("_key"), closed(F.col(text)).alias("text")).join(chosen, "_key")
    rows = stage(rows.select("toxic", "text"), "labelled")
    all_bad, all_good = rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not all_bad or not all_good:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -50.0)

    # Features are counted by Spark; only the telling ones reach the driver, some thousand at most.
    counts = rows.mapInArrow(_presence, "h long, n long, bad long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    bad, good = F.col("bad").cast("double"), (F.col("n") - F.col("bad")).cast("double")
    telling = counts.where((F.col("n") >= least) & _telling(bad, good, float(all_bad), float(all_good)))
    keys = np.sort(telling.select("h").toPandas()["h"].to_numpy(np.int64).view(np.uint64))
    out = rows.mapInArrow(_hits(keys), "toxic int, sentences long, at binary, place binary").toPandas()
    y = out["toxic"].to_numpy(np.float64)
    first = np.concatenate([[0], np.cumsum(out["sentences"].to_numpy())])
    at = np.concatenate([np.frombuffer(a, np.int64) + f for a, f in zip(out["at"], first)])
    place = np.frombuffer(b"".join(out["place"]), np.int64)
    return _fit(y, first, at, place, keys, steps, l1)


def _telling(bad: Column, good: Column, all_bad: float, all_good: float) -> Column:
    """Features that stand in toxic documents clearly more often than in others."""
    rest_bad, rest_good = all_bad - bad, all_good - good
    across = bad * rest_good - good * rest_bad
    scale = (bad + good) * (rest_bad + rest_good) * all_bad * all_good
    chi = (all_bad + all_good) * across * across / F.greatest(scale, F.lit(1e-9))
    return (chi > LEAST_CHI) & (bad * all_good > 3 * good * all_bad)


def _fit(y, first, at, place, keys, steps, l1) -> Model:
    """Adaptive gradient steps with soft thresholds on the documents' mean log-likelihood."""
    w, b = np.zeros(len(keys)), MOST_BIAS
    gw, gb = np.full(len(keys), 1e-8), 1e-8
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    of = np.repeat(np.arange(len(y)), np.diff(first))
    full = np.diff(first) > 0
    # Sentences with a feature count each for itself; of the others the first of each document stands for all.
    counts = np.bincount(at, minlength=first[-1]) > 0
    bare = np.flatnonzero(~counts)
    counts[bare[np.unique(of[bare], return_index=True)[1]]] = True
    for _ in range(steps):
        z = np.clip(b + np.bincount(at, w[place], first[-1]), -30, 30)
        p = counts / (1 + np.exp(-z))
        none = np.zeros(len(y))  # log of the chance that no sentence offends
        none[full] = np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-9)), first[:-1][full])
        none = np.minimum(none, -1e-9)
        toxic = -np.expm1(none)
        d = share * np.where(y == 1, -np.exp(none) / np.maximum(toxic, 1e-9), 1.0)
        slope = np.maximum(d, -1e3)[of] * p
        g = np.bincount(place, slope[at], len(keys))
        gw += g * g
        rate = 0.3 / np.sqrt(gw)
        w = w - rate * g
        w = np.sign(w) * np.maximum(0, np.abs(w) - rate * l1)
        g = slope.sum()
        gb += g * g
        b = min(MOST_BIAS, b - 0.3 / np.sqrt(gb) * g)
    keep = w != 0
    return Model(keys[keep], w[keep], float(b))


def _probabilities(s: Sentences, lookup: Lookup, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each sentence, and by noisy-or of each text.

    Sentences that no feature raises above the bias count together as the most probable of them.
    """
    z = np.zeros(len(s.end))
    for f in s.features:
        weight = lookup(f)
        hit = np.flatnonzero(weight)
        z += np.bincount(s.sentence[hit], weight[hit], len(z))
    p = 1 / (1 + np.exp(-np.clip(z + bias, -30, 30)))
    p[s.end - s.start <= 1] = 0  # nothing but its end
    log_none = np.log1p(-np.minimum(p, 1 - 1e-12))
    raised = z > 0
    each = np.add.reduceat(np.where(raised, log_none, 0), s.first[:-1])
    return p, -np.expm1(each + np.minimum.reduceat(np.where(raised, 0, log_none), s.first[:-1]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Every row: (key, score, predicted, n_sentences, offending).

    ``offending`` lists the byte spans ``start:end`` of sentences of at least ``threshold`` / 2.
    A null or empty text scores 0. Repeated rows stay repeated; other columns are ignored.
    """
    lookup = Lookup(model.keys, model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            s = Sentences(block.column("text"))
            p, scores = _probabilities(s, lookup, model.bias)
            bad = np.flatnonzero(p >= threshold / 2)
            row = np.searchsorted(s.first, bad, "right") - 1
            spans = [[] for _ in range(block.num_rows)]
            for r, a, b in zip(row, s.start[bad] - s.bounds[row], s.end[bad] - s.bounds[row]):
                spans[r].append(f"{a}:{b}")
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"), pa.array(scores), pa.array(np.diff(s.first), pa.int64()),
                    pa.array([",".join(x) for x in spans], pa.string()),
                ],
                names=["id", "score", "n_sentences", "offending"],
            )

    rows = docs.select(F.col(key).alias("id"), closed(F.col(text)).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, score double, n_sentences long, offending string"
    out = rows.mapInArrow(run, schema)
    return out.select(
        F.col("id").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_sentences", "offending"
    )


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows whose text scores below ``threshold``, with all their columns; no row is moved."""
    lookup = Lookup(model.keys, model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "_closed"):
            _, scores = _probabilities(Sentences(block.column("_closed")), lookup, model.bias)
            yield block.drop_columns(["_closed"]).filter(pa.array(scores < threshold))

    return set_aside(docs, lambda rows: rows.withColumn("_closed", closed(F.col(text))).mapInArrow(run, rows.schema), text)
