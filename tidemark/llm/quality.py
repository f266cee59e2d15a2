"""Quality by a byte-level convolutional network, trained and applied in numpy.

A document is cut into overlapping chunks that cover all of its bytes. In a chunk each learned filter
slides over embedded bytes and keeps its greatest response; a small hidden layer makes one score of
them. The document's probability is logistic in the mean of its chunks' scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import blocks, content

CHUNK, STEP = 256, 192  # bytes of a chunk, and from one chunk to the next
PAD = 256  # stands for the bytes that a short last chunk lacks
WIDTH, EMBEDDED, FILTERS, HIDDEN = 8, 8, 32, 16
_AT_ONCE = 64  # chunks whose responses are in memory at the same time


def held_out(key: Column) -> Column:
    """Rows that never train: crc32 of the key's text leaves 2 modulo 4. A null key is held out."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 4 == 2, F.lit(True))


def chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start of each chunk, and the bounds of the texts' chunks among them. An empty text has one, of padding alone."""
    size = np.diff(bounds)
    n = np.maximum(1, -(-(size - (CHUNK - STEP)) // STEP))
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], n)
    return np.repeat(bounds[:-1], n) + at * STEP, first


def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The bytes of chunks as a table of numbers, padded where their text ends."""
    at = start[:, None] + np.arange(CHUNK)
    inside = at < end[:, None]
    out = np.full(at.shape, PAD, np.int16)
    out[inside] = data[at[inside]]
    return out


@dataclass
class Model:
    """Parameters of the network; some kilobytes."""

    embedding: np.ndarray  # (257, EMBEDDED)
    filters: np.ndarray  # (WIDTH * EMBEDDED, FILTERS)
    floor: np.ndarray  # (FILTERS,)
    hidden: np.ndarray  # (FILTERS, HIDDEN)
    hidden_floor: np.ndarray  # (HIDDEN,)
    out: np.ndarray  # (HIDDEN,)
    scale: np.ndarray  # (2,): factor and offset of the mean of a document's chunks

    @staticmethod
    def fresh(seed: int) -> Model:
        r = np.random.default_rng(seed)
        embedding = r.normal(0, 0.5, (257, EMBEDDED))
        embedding[PAD] = 0
        return Model(*(x.astype(np.float32) for x in (
            embedding, r.normal(0, 0.25, (WIDTH * EMBEDDED, FILTERS)), np.zeros(FILTERS), r.normal(0, 0.25, (FILTERS, HIDDEN)),
            np.zeros(HIDDEN), r.normal(0, 0.4, HIDDEN), np.array([4.0, 0.0]),
        )))


def _responses(model: Model, table: np.ndarray) -> np.ndarray:
    """(chunks, positions, filters): every filter at every place of the chunks."""
    e = model.embedding[np.concatenate([table, np.full((len(table), WIDTH - 1), PAD, table.dtype)], 1)]
    windows = np.lib.stride_tricks.sliding_window_view(e.reshape(len(table), -1), WIDTH * EMBEDDED, 1)[:, ::EMBEDDED]
    return np.ascontiguousarray(windows).reshape(-1, WIDTH * EMBEDDED).dot(model.filters).reshape(len(table), -1, FILTERS)


def pooled(model: Model, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The greatest response of each filter in each chunk, and where it is."""
    best, at = [], []
    for a in range(0, len(table), _AT_ONCE):
        z = _responses(model, table[a : a + _AT_ONCE])
        best.append(z.max(1))
        at.append(z.argmax(1))
    return np.concatenate(best), np.concatenate(at)


def _chunk_scores(model: Model, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.tanh(np.maximum(best + model.floor, 0) @ model.hidden + model.hidden_floor)
    return np.tanh(h @ model.out), h


def probabilities(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, and how many chunks it has; a long text is read in parts of a few chunks."""
    start, first = chunks(data, bounds)
    end = np.repeat(bounds[1:], np.diff(first))
    sums = np.zeros(len(bounds) - 1)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    for a in range(0, len(start), _AT_ONCE):
        z = _responses(model, cut(data, start[a : a + _AT_ONCE], end[a : a + _AT_ONCE])).max(1)
        np.add.at(sums, of[a : a + _AT_ONCE], _chunk_scores(model, z)[0])
    z = model.scale[0] * sums / np.maximum(1, np.diff(first)) + model.scale[1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), np.diff(first)


def fit(tables: list[np.ndarray], y: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> Model:
    """Train on the chunks of each document by Adam on the cross-entropy, either label weighing the same."""
    model, r = Model.fresh(seed), np.random.default_rng(seed)
    names = [f.name for f in fields(Model)]
    m = {n: np.zeros_like(getattr(model, n)) for n in names}
    v = {n: np.zeros_like(getattr(model, n)) for n in names}
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    step, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = r.permutation(len(y))
        for a in range(0, len(y), batch):
            pick = order[a : a + batch]
            table = np.concatenate([tables[i] for i in pick])
            n = np.array([len(tables[i]) for i in pick])
            of = np.repeat(np.arange(len(pick)), n)
            best, at = pooled(model, table)
            raised = np.maximum(best + model.floor, 0)
            u, h = _chunk_scores(model, best)
            mean = np.bincount(of, u, len(pick)) / n
            p = 1 / (1 + np.exp(-(model.scale[0] * mean + model.scale[1])))
            d = ((p - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
            g = {"scale": np.array([d @ mean, d.sum()], np.float32)}
            du = (d * model.scale[0] / n)[of] * (1 - u * u)
            g["out"] = h.T @ du
            dh = du[:, None] * model.out * (1 - h * h)
            g["hidden"], g["hidden_floor"] = raised.T @ dh, dh.sum(0)
            dz = (dh @ model.hidden.T) * (raised > 0)
            g["floor"] = dz.sum(0)
            # Only the place of a filter's greatest response learns.
            wide = np.concatenate([table, np.full((len(table), WIDTH - 1), PAD, table.dtype)], 1)
            seen = wide[np.arange(len(table))[:, None, None], at[:, :, None] + np.arange(WIDTH)]  # chunks, filters, WIDTH
            windows = model.embedding[seen].reshape(len(table), FILTERS, -1)
            g["filters"] = np.einsum("cfk,cf->kf", windows, dz)
            back = (dz[:, :, None] * model.filters.T[None]).reshape(-1, EMBEDDED)
            flat = seen.reshape(-1)
            g["embedding"] = np.stack([np.bincount(flat, back[:, e], 257) for e in range(EMBEDDED)], 1)
            g["embedding"][PAD] = 0
            step += 1
            now = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
            for name in names:
                x = g[name].astype(np.float32)
                m[name] += 0.1 * (x - m[name])
                v[name] += 0.01 * (x * x - v[name])
                change = (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.99**step)) + 1e-8)
                setattr(model, name, (getattr(model, name) - now * change).astype(np.float32))
    return model


def _sample(chunks_each: int):
    """Of each text at most ``chunks_each`` chunks, evenly over the whole text, as rows of 2 * CHUNK bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            data, bounds = content(block.column("text"))
            start, first = chunks(data, bounds)
            n = np.diff(first)
            take = np.minimum(n, chunks_each)
            edge = np.concatenate([[0], np.cumsum(take)])
            place = np.arange(edge[-1]) - np.repeat(edge[:-1], take)
            at = np.repeat(first[:-1], take) + place * np.repeat(n, take) // np.repeat(take, take)
            table = cut(data, start[at], np.repeat(bounds[1:], take))
            yield pa.RecordBatch.from_pydict(
                {"good": block.column("good"), "chunks": pa.array([table[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary())}
            )

    return run


def _raw(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "utf-8")


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    max_labelled: int = 3_000, chunks_each: int = 6, skip_held_out: bool = True,
) -> Model:
    """Fit on at most ``max_labelled`` labelled rows, half of either label where there are so many, and ``chunks_each`` chunks of each.

    Which rows is decided by a hash of the key, never by their order. Null labels and keys do not
    train; of a repeated key the greater label counts. Without labels of both kinds every score is 0.5.
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("good"))
    known = known.where(F.col("good").isin(0, 1) & F.col("_key").isNotNull())
    if skip_held_out:
        known = known.where(~held_out(F.col("_key")))
    known = known.groupBy("_key").agg(F.max("good").alias("good"))
    half = [known.where(F.col("good") == y).orderBy(F.xxhash64("_key"), "_key").limit(max_labelled // 2) for y in (0, 1)]
    # At most max_labelled keys: safe to broadcast.
    chosen = F.broadcast(half[0].unionByName(half[1]))
    rows = docs.select(F.col(key).alias("_key"), _raw(F.col(text)).alias("text")).join(chosen, "_key")
    # A key that stands in many rows trains with one of them, chosen before texts are moved.
    rows = rows.groupBy("_key", "good").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    out = rows.select("good", "text").mapInArrow(_sample(chunks_each), "good int, chunks binary").toPandas()
    out = out.assign(size=out["chunks"].str.len()).sort_values(["good", "size", "chunks"], kind="stable")
    y = out["good"].to_numpy(np.float32)
    if len(set(y.tolist())) < 2:
        silent = Model.fresh(0)
        silent.scale = np.zeros(2, np.float32)
        return silent
    return fit([np.frombuffer(c, np.int16).reshape(-1, CHUNK) for c in out["chunks"]], y)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Every row: (key, score, predicted, n_chunks), the score being the probability of label 1.

    A null text counts as empty, and an empty one is a chunk of padding alone. Repeated rows stay
    repeated; other columns, of any name, are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            p, n = probabilities(model, *content(block.column("text")))
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(p), pa.array(n, pa.int64())], names=["id", "score", "n_chunks"])

    rows = docs.select(F.col(key).alias("id"), _raw(F.col(text)).alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double, n_chunks long")
    return out.select(F.col("id").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_chunks")
