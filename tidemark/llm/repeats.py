"""Removal of repeated byte strings: suffix arrays per shard, merged across shards by binary search.

A position repeats if the ``LENGTH`` bytes from it on also start earlier: in a document of smaller key,
or earlier in the same one. Each such window is governed by an anchor, the leftmost of the least-hashed
32-byte pieces in it, and neighbouring windows with one anchor make a span of at most 168 bytes. Equal
windows have equal anchors, so:

1. spans that are equal as a whole are settled by their first occurrence, first within a task's block
   of text, then in the bucket of their anchor;
2. what is left is one span per distinct content; anchors with several of them are contested, and only
   their bytes go into shards, each with a suffix array whose common prefixes show the equal windows;
3. an anchor with too many spans for one shard is spread over several; their windows are merged by
   binary search among the sorted windows of a range of keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.suffixes import SuffixArray
from tidemark.llm.words import END, blocks, closed, content, mixed
from tidemark.session import stage

LENGTH, PIECE = 100, 32
_WINDOW = LENGTH - PIECE + 1  # pieces in a window
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)
# A span of content: anchor hash, content hash, document, variant, start, bytes, whether its anchor is spread.
SPAN = np.dtype([("h", "<u8"), ("t", "<u8"), ("doc", "<i8"), ("v", "<i8"), ("s", "<i4"), ("n", "u1"), ("spread", "?")])
PART = "to int, doc long, v long, a long, b long, spans binary"
FOUND = "doc long, v long, a long, b long, shard long, cross boolean"
WINDOWS = "doc long, v long, a long, b long, k1 long, k2 long, shard long"


def _piece_hashes(eights: np.ndarray) -> np.ndarray:
    """Hashes of the 32 bytes from each position on; ``eights`` has 24 entries more."""
    n = len(eights) - 24
    h = eights[:n].copy()
    for k in (8, 16, 24):
        h *= _ODD
        h ^= h >> np.uint64(32)
        h += eights[k : k + n]
    return mixed(h)


def _combined(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = mixed(out * _ODD + p)
    return out


def spans_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans (text, first window, last window, anchor hash, content hash) of texts data[start:end]."""
    n = len(data)
    padded = np.concatenate([data, np.full(PIECE, END, np.uint8)])
    eights = np.ascontiguousarray(np.ndarray(n + 24, "<u8", padded.data, 0, (1,)))
    h = _piece_hashes(eights)
    # The least hash decides, then the leftmost place.
    key = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
    key = np.concatenate([key, np.full(_WINDOW, ~np.uint64(0), np.uint64)])
    width = 1
    while width * 2 <= _WINDOW:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[: n], key[_WINDOW - width : n + _WINDOW - width])
    count = np.maximum(end - start - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(start)), count)
    at = np.arange(len(text)) + np.repeat(start - (np.cumsum(count) - count), count)
    anchor = (key[at] & _PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    a, b = at[first], at[last]
    parts = [h[a], h[a + PIECE], h[a + 2 * PIECE]]
    parts += [h[b + LENGTH - k * PIECE] for k in (1, 2, 3)] + [(b - a).astype(np.uint64)]
    return text[first], a, b, h[anchor[first]], _combined(parts)


def _order(x: np.ndarray) -> np.ndarray:
    return np.lexsort((x["s"], x["doc"], x["t"], x["h"]))


def _first_of_content(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted spans, and which of them start as early as the first of their content."""
    x = x[_order(x)]
    new = np.ones(len(x), bool)
    new[1:] = (x["h"][1:] != x["h"][:-1]) | (x["t"][1:] != x["t"][:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(x) else np.zeros(0, np.int64)
    return x, (x["doc"] == x["doc"][head]) & (x["s"] == x["s"][head])


def _joined(doc: np.ndarray, v: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of each text with those that touch made one."""
    order = np.lexsort((a, v, doc))
    doc, v, a, b = doc[order], v[order], a[order], b[order]
    if not len(a):
        return doc, v, a, b
    same = (doc[1:] == doc[:-1]) & (v[1:] == v[:-1])
    # Within a text, ends are lifted to the largest so far; texts are kept apart by a large step.
    group = np.concatenate([[0], np.cumsum(~same)])
    step = int(b.max()) + 1
    reach = np.maximum.accumulate(b + group * step) - group * step
    new = np.concatenate([[True], ~same | (a[1:] > reach[:-1])])
    head = np.flatnonzero(new)
    return doc[head], v[head], a[head], reach[np.append(head[1:], len(a)) - 1]


def _batch(names: str, **columns: np.ndarray) -> pa.RecordBatch:
    fields = [f.split() for f in names.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields],
        names=[name for name, _ in fields],
    )


def _intervals(names: str, doc: np.ndarray, v: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    doc, v, a, b = _joined(doc, v, a, b)
    return _batch(names, doc=doc, v=v, a=a, b=b)


def _cut(buckets: int, chunk: int, many: int):
    """Spans of a chunk of text by bucket, without those that repeat within it."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        x, first = _first_of_content(np.concatenate(held))
        gone, x = x[~first], x[first]
        if len(gone):
            a = gone["s"].astype(np.int64)
            doc, v, a, b = _joined(gone["doc"], gone["v"], a, a + gone["n"])
            to = (mixed(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield _batch(PART, to=to, doc=doc, v=v, a=a, b=b)
        # An anchor with many contents is spread; its bucket gets a mark (of no bytes) that says so.
        new = np.ones(len(x), bool)
        new[1:] = x["h"][1:] != x["h"][:-1]
        group = np.cumsum(new) - 1
        x["spread"] = np.bincount(group)[group] > many
        marks = x[new & x["spread"]]
        marks["n"] = 0
        salt = np.where(x["spread"], x["t"] % np.uint64(64) + np.uint64(1), 0)
        to = np.concatenate([mixed(x["h"] + salt * _ODD), mixed(marks["h"])]) % np.uint64(buckets)
        x = np.concatenate([x, marks])
        order = np.argsort(to, kind="stable")
        to, x = to[order], x[order]
        ends = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(ends))
        yield _batch(PART, to=full.astype(np.int32), spans=[x[ends[k] : ends[k + 1]].tobytes() for k in full])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block in blocks(batches, "text"):
            data, bounds = content(block.column("text"))
            doc, v = block.column("doc").to_numpy(), block.column("v").to_numpy()
            # Windows of a very long text are taken in stretches; a span ends where a stretch ends.
            stretch = 8 << 20
            for at in range(0, max(1, int(bounds[-1])), stretch):
                start = np.clip(bounds[:-1], at, None)
                end = np.minimum(bounds[1:] - 1, at + stretch + LENGTH - 1)
                use = np.flatnonzero(end - start >= LENGTH)
                if not len(use):
                    continue
                low, high = start[use[0]], end[use[-1]]
                text, a, b, h, t = spans_of(data[low:high], start[use] - low, end[use] - low)
                text = use[text]
                x = np.zeros(len(text), SPAN)
                x["h"], x["t"], x["doc"], x["v"] = h, t, doc[text], v[text]
                x["s"], x["n"] = a + low - bounds[text], b - a + LENGTH
                held.append(x)
                size += int(high - low)
            if size >= chunk and held:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _settle(per_shard: int):
    """Of the spans of some buckets: intervals of later copies, and the contested spans that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, SPAN)]
        for batch in batches:
            passed = batch.filter(batch.column("spans").is_null())
            if passed.num_rows:
                yield _batch(FOUND, **{c: passed.column(c).to_numpy() for c in ("doc", "v", "a", "b")})
            held += [np.frombuffer(s, SPAN) for s in batch.column("spans").drop_null().to_pylist()]
        x = np.concatenate(held)
        del held
        spread = np.unique(x["h"][x["spread"]])
        x, first = _first_of_content(x[x["n"] > 0])
        gone, x = x[~first], x[first]
        if len(gone):
            a = gone["s"].astype(np.int64)
            yield _intervals(FOUND, gone["doc"], gone["v"], a, a + gone["n"])
        new = np.ones(len(x), bool)
        new[1:] = x["h"][1:] != x["h"][:-1]
        group = np.cumsum(new) - 1
        count = np.bincount(group)
        everywhere = np.isin(x["h"], spread)
        x, everywhere, place, count = (
            y[everywhere | (count[group] > 1)] for y in (x, everywhere, np.arange(len(x)) - np.flatnonzero(new)[group] if len(x) else group, count[group])
        )
        cross = everywhere | (count > per_shard)
        # A contested anchor's shard; one that is spread has several, by content.
        salt = np.where(cross, x["t"] % np.uint64(64) + (place // per_shard).astype(np.uint64) * np.uint64(64) + np.uint64(1), 0)
        shard = mixed(x["h"] + salt * _ODD).view(np.int64)
        a = x["s"].astype(np.int64)
        for k in range(0, len(x), 50_000):
            to = slice(k, k + 50_000)
            yield _batch(FOUND, doc=x["doc"][to], v=x["v"][to], a=a[to], b=(a + x["n"])[to], shard=shard[to], cross=cross[to])

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contested spans of each text."""
    for block in blocks(batches, "text"):
        data, bounds = content(block.column("text"))
        asked = block.column("spans")
        row = np.repeat(np.arange(block.num_rows), np.diff(asked.offsets.to_numpy()))
        spans = asked.flatten()
        a, b = (spans.field(c).to_numpy() for c in ("a", "b"))
        raw = data.tobytes()
        low, high = a + bounds[row], b + bounds[row]
        yield pa.RecordBatch.from_arrays(
            [
                spans.field("shard"), block.column("doc").take(pa.array(row)), block.column("v").take(pa.array(row)), pa.array(a),
                spans.field("cross"), pa.array([raw[x:y] for x, y in zip(low.tolist(), high.tolist())], pa.binary()),
            ],
            names=["shard", "doc", "v", "a", "cross", "bytes"],
        )


def _compare(size: int = 1 << 20):
    """Repeated windows within each shard by its suffix array, and the first windows of spread shards."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        strings = [r[5] for r in rows]
        array = SuffixArray(strings)
        shard, doc, v, start = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 3))
        cross = np.array([r[4] for r in rows], bool)
        at = np.flatnonzero(array.left >= LENGTH)
        of = array.string[at]
        begins = start[of] + at - array.first[of]
        # The first of each group of equal windows, by document and start.
        group = array.groups(LENGTH)[at]
        order = np.lexsort((begins, doc[of], group))
        at, of, begins, group = at[order], of[order], begins[order], group[order]
        new = np.ones(len(at), bool)
        new[1:] = group[1:] != group[:-1]
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (doc[of] != doc[of][head]) | (begins != begins[head])
        if later.any():
            a = begins[later]
            yield _intervals(WINDOWS, doc[of[later]], v[of[later]], a, a + LENGTH)
        ask = ~later & cross[of]
        at, of, a = at[ask], of[ask], begins[ask]
        for k in range(0, len(at), 50_000):
            to = slice(k, k + 50_000)
            keys = [_combined([array.eights[at[to] + min(j, LENGTH - 8)] + np.uint64(salt) for j in range(0, LENGTH, 8)]) for salt in (1, 2)]
            k1, k2 = (x.view(np.int64) for x in keys)
            yield _batch(WINDOWS, doc=doc[of[to]], v=v[of[to]], a=a[to], b=a[to] + LENGTH, k1=k1, k2=k2, shard=shard[of[to]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                shards.setdefault(row[0], []).append(row)
        # Small shards share a suffix array: equal windows have one anchor, so shards do not mix.
        together, held = [], 0
        for shard in sorted(shards):
            together += shards[shard]
            held += sum(len(r[5]) for r in shards.pop(shard))
            if held >= size:
                yield from solve(together)
                together, held = [], 0
        if together:
            yield from solve(together)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that start earlier in another shard: each shard's run is searched in the merged windows."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    k = np.rec.fromarrays([whole.column(c).to_numpy() for c in ("k1", "k2")], names="k1,k2")
    doc, v, a, shard = (whole.column(c).to_numpy() for c in ("doc", "v", "a", "shard"))
    order = np.lexsort((a, doc, k.k2, k.k1))
    new = np.ones(len(order), bool)
    new[1:] = k[order][1:] != k[order][:-1]
    merged, first = k[order][new], order[new]
    runs = np.argsort(shard, kind="stable")
    for run in np.split(runs, np.flatnonzero(np.diff(shard[runs])) + 1):
        head = first[np.searchsorted(merged, k[run])]
        later = run[(doc[run] != doc[head]) | (a[run] != a[head])]
        if len(later):
            yield _intervals("doc long, v long, a long, b long", doc[later], v[later], a[later], a[later] + LENGTH)


def _remove(keep_text: bool):
    """Counts, the digest of what is left and, if asked, the remaining bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for block in blocks(batches, "text"):
            data, bounds = content(block.column("text"))
            out = []
            for row, spans in enumerate(block.column("gone").to_pylist()):
                raw = data[bounds[row] : bounds[row + 1] - 1].tobytes()
                kept, at, removed, runs = [], 0, 0, 0
                for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
                    if a > at or not runs:
                        kept.append(raw[at:a])
                        runs += 1
                        at = a
                    if b > at:
                        removed += b - at
                        at = b
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string()),
                    pa.array(columns[4], pa.binary()),
                ],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False, chunk: int = 16 << 20,
    many: int = 1_000, per_shard: int = 20_000,
) -> DataFrame:
    """One row per row of ``docs``: (key, n_bytes, n_removed, n_spans, kept_sha256), with ``kept`` if asked.

    Removed is every byte under a string of 100 bytes that also starts earlier, judged on
    the input. Null and empty texts have no bytes. Rows that repeat a key are one document:
    of two places at the same start neither is earlier, so equal rows keep the same bytes.
    Null keys come after all others and are one document likewise. Other columns are ignored.

    ``chunk`` bytes of text are settled in one task before anything moves; ``many`` contents
    of one anchor in a chunk spread it over buckets and ``per_shard`` over shards. None of
    them changes the result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    last = (1 << 63) - 1
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("doc", F.coalesce(F.col("id").cast("long"), F.lit(last)))
    again = rows.groupBy("doc").count().where("count > 1").select("doc")
    variant: Column = F.lit(0).cast("long")
    if not again.isEmpty():
        # The texts of a repeated key are told apart by a number for each, its digest being the key it is found by.
        rows = rows.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
        texts = rows.join(again, "doc", "left_semi").select("doc", "digest").distinct()
        texts = stage(texts.withColumn("number", F.monotonically_increasing_id() + 1), "repeat-texts")
        rows = rows.join(texts, ["doc", "digest"], "left")
        variant = F.coalesce("number", variant)
    rows = rows.select("id", "doc", variant.alias("v"), closed(F.col("text"), lower=False).alias("text"))

    cut = rows.select("doc", "v", "text").mapInArrow(_cut(8 * parts, chunk, many), PART)
    found = stage(cut.repartition(parts, "to").mapInArrow(_settle(per_shard), FOUND), "repeat-spans")

    span = F.struct("a", "b", "shard", "cross")
    asked = found.where("shard is not null").groupBy("doc", "v").agg(F.collect_list(span).alias("spans"))
    slices = rows.select("doc", "v", "text").dropDuplicates(["doc", "v"]) if not again.isEmpty() else rows.select("doc", "v", "text")
    slices = slices.join(asked, ["doc", "v"]).mapInArrow(_slices, "shard long, doc long, v long, a long, cross boolean, bytes binary")
    windows = stage(slices.repartition(parts, "shard").mapInArrow(_compare(), WINDOWS), "repeat-windows")
    open_windows = windows.where("k1 is not null").repartitionByRange(parts, "k1", "k2")
    merged = open_windows.mapInArrow(_merge, "doc long, v long, a long, b long")

    cover = ["doc", "v", "a", "b"]
    gone = found.where("shard is null").select(*cover)
    gone = gone.unionByName(windows.where("k1 is null").select(*cover)).unionByName(merged)
    gone = gone.groupBy("doc", "v").agg(F.collect_list(F.struct("a", "b")).alias("gone"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.join(gone, ["doc", "v"], "left").select("id", "text", "gone").mapInArrow(
        _remove(keep_text), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    out = out.withColumnRenamed("id", key)
    return out if keep_text else out.drop("kept")
