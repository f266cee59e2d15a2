"""Near copies by BagMinHash: signatures of shingle multisets, bands, exact overlap, components.

An element of weight w owns the range [0, w), cut into shells [0, 1), [1, 2), [2, 4), [4, 8), ... Each
shell carries a Poisson process whose rate is its width; a point has a time, a register and a place in
the shell, and counts for every document whose weight lies above its place. A register keeps the
earliest time, so two documents agree in a register with the probability of their weighted Jaccard
similarity. Points are drawn in order of time and only until no register can still improve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.clashes import set_aside
from tidemark.llm.components import components
from tidemark.llm.words import Words, blocks, closed, mixed, shingles
from tidemark.session import stage

REGISTERS, BAND = 128, 4
BANDS = REGISTERS // BAND
WIDTH = 5
BLOCK_BYTES = 2 << 20  # of text in a block of a tile, about; what is compared in a task does not grow with the texts
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NEXT = np.uint64(0xD1342543DE82EF95)


def multisets(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), sorted; a text without words has none."""
    words = Words(column)
    h, bounds = shingles(words.hashes(), words.first, width)
    text = np.repeat(np.arange(len(column)), np.diff(bounds))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def signatures(text: np.ndarray, h: np.ndarray, count: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """(n, registers) earliest times; infinite for texts without elements."""
    shells = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
    of = np.repeat(np.arange(len(h)), shells)
    shell = np.arange(len(of)) - np.repeat(np.cumsum(shells) - shells, shells)
    low = np.where(shell > 0, 1 << np.maximum(shell - 1, 0), 0)
    rate = np.maximum(low, 1).astype(np.float64)
    reach = (count[of] - low) / rate  # the covered share of the shell
    state = mixed(h[of] + shell.astype(np.uint64) * _ODD)
    doc, time = text[of], np.zeros(len(of))
    best = np.full((n, registers), np.inf)
    flat = best.reshape(-1)
    while len(doc):
        state = state + _NEXT
        draw, other = mixed(state), mixed(state ^ _ODD)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53) / rate
        register = (other & np.uint64(registers - 1)).astype(np.int64)
        place = (other >> np.uint64(11)).astype(np.float64) / 2**53
        hit = place < reach
        np.minimum.at(flat, doc[hit] * registers + register[hit], time[hit])
        go = time < best.max(1)[doc]
        state, doc, time, rate, reach = state[go], doc[go], time[go], rate[go], reach[go]
    return best


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band hashes and 14-bit prints of the registers; texts without words leave no row."""
    for block in blocks(batches, "text", 2 << 20):
        n = block.num_rows
        text, h, count = multisets(block.column("text"))
        some = np.unique(text)
        if not len(some):
            continue
        bits = mixed(signatures(text, h, count, n)[some].view(np.uint64))
        band = np.zeros((len(some), BANDS), np.uint64)
        for k in range(BAND):
            band = mixed(band * _ODD + bits[:, k::BAND])
        prints = (bits >> np.uint64(50)).astype(np.uint16)
        element = mixed(h * _ODD + count.astype(np.uint64))
        same = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
        np.add.at(same[0], text, element)
        np.add.at(same[1], text, mixed(element ^ _ODD))
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, BANDS), pa.int32()), pa.array(band.view(np.int64).ravel()))
        packed = prints.view(np.int64)
        prints_of = pa.ListArray.from_arrays(
            pa.array(np.arange(0, packed.size + 1, packed.shape[1]), pa.int32()), pa.array(packed.ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [
                block.column("id").take(pa.array(some)), block.column("place").take(pa.array(some)),
                *[pa.array(x[some].view(np.int64)) for x in same], listed, prints_of,
            ],
            names=["id", "place", "c1", "c2", "bands", "prints"],
        )


def _agreeing(a: Column, b: Column) -> Column:
    """The number of equal prints: adding 2**14 - 1 to a 16-bit lane of a xor b fills bit 14 unless it is zero."""

    def differing(x: Column, y: Column) -> Column:
        filled = x.bitwiseXOR(y) + F.lit(0x3FFF3FFF3FFF3FFF)
        return F.bit_count(filled.bitwiseAND(F.lit(0x4000400040004000)))

    return REGISTERS - F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weighted Jaccard similarity of the two texts of each row."""
    for block in blocks(batches, "text_a", 1 << 20):
        parts = [multisets(block.column(c)) for c in ("text_a", "text_b")]
        row = np.concatenate([p[0] for p in parts])
        h = np.concatenate([p[1] for p in parts])
        count = np.concatenate([parts[0][2], -parts[1][2]])
        total = np.bincount(row, np.abs(count), block.num_rows)
        order = np.lexsort((h, row))
        row, h, count = row[order], h[order], count[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        apart = np.bincount(row[at], np.abs(np.add.reduceat(count, at)) if len(at) else None, block.num_rows)
        similarity = (total - apart) / np.maximum(total + apart, 1)
        yield pa.RecordBatch.from_arrays([block.column("a"), block.column("b"), pa.array(similarity)], names=["a", "b", "similarity"])


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose exact similarity reaches the threshold."""
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_overlaps, "a long, b long, similarity double").where(F.col("similarity") >= threshold).select("a", "b")


def _tiles(df: DataFrame, keys: list[str], block: int, size: Column | None = None, most: int = 0) -> DataFrame:
    """Rows with the tiles (i, j), i <= j, that compare their block of a group with every block of it.

    A group of up to ``block`` rows, with ``size`` adding up to ``most``, is one tile; a larger one
    is as many tasks as it has pairs of blocks, none of more than about two blocks.
    """
    n = F.ceil(F.count(F.lit(1)) / block)
    n = n if size is None else F.greatest(n, F.ceil(F.sum(size) / most))
    sizes = df.groupBy(*keys).agg(n.cast("int").alias("n"))
    rows = df.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("n")).cast("int"))
    after = F.transform(F.sequence("block", F.col("n") - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j")))
    earlier = F.filter(F.sequence(F.lit(0), F.col("block")), lambda i: i < F.col("block"))
    before = F.transform(earlier, lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    return rows.select("*", F.inline(F.concat(after, before))).drop("n")


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each is connected with, by the pairs (i, j) and by what ``root`` says already."""
    i, j = np.concatenate([i, np.arange(len(root))]), np.concatenate([j, root])
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _forest(ids: np.ndarray, root: np.ndarray) -> pd.DataFrame:
    """Edges (a, b) that connect the rows as their roots do, one per row at most."""
    child = np.flatnonzero(root != np.arange(len(ids)))
    return pd.DataFrame({"a": ids[root[child]].astype(np.int64), "b": ids[child].astype(np.int64)})


def _loosely_linked(least: float):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        """Connections by estimate within a tile of one bucket; pairs are held for 64 rows at a time."""
        prints = np.array(tile["prints"].tolist(), np.int64).view(np.uint16)
        root = np.arange(len(prints))
        for at in range(0, len(prints), 64):
            agree = (prints[at : at + 64, None] == prints[None, at:]).sum(2)
            i, j = np.nonzero(agree >= least)
            root = _joined(root, i + at, j + at)
        return _forest(tile["id"].to_numpy(), root)

    return run


def _shared(row: np.ndarray, h: np.ndarray, count: np.ndarray, n: int, columns: int = 1024) -> np.ndarray:
    """(n, n) numbers of shingles that two texts share, each counted by its smaller multiplicity.

    A column stands for a shingle and a multiplicity of it: texts that have it so often have a one there,
    which weighs as much as the multiplicity exceeds the one before. Products of the rows then add up the
    smaller multiplicities, of about ``columns`` columns at a time.
    """
    order = np.lexsort((count, h))
    row, h, count = row[order], h[order], count[order]
    first = np.flatnonzero(np.diff(h, prepend=~h[:1]))
    several = np.repeat(np.diff(np.append(first, len(h))) > 1, np.diff(np.append(first, len(h))))
    row, h, count = row[several], h[several], count[several]
    new = np.diff(h, prepend=~h[:1]) != 0
    level = new | (np.diff(count, prepend=0) != 0)
    column = np.cumsum(level) - 1
    start = np.flatnonzero(new)
    lowest = np.append(column[start], column[-1:] + 1)  # the first column of each shingle
    weight = count[level] - np.where(new, 0, np.concatenate([count[:1], count[:-1]]))[level]
    shared, at = np.zeros((n, n)), 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(lowest, lowest[at] + columns, "right")) - 1)
        a, b = start[at], start[to] if to < len(start) else len(h)
        base = lowest[at:to][np.cumsum(new[a:b]) - 1]
        times = column[a:b] - base + 1
        place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(base, times) - lowest[at]
        weights = weight[lowest[at] : lowest[to]]
        part = np.zeros((n, len(weights)), np.float32 if weights.sum() < 1 << 24 else np.float64)  # exact either way
        part[np.repeat(row[a:b], times), place] = 1
        shared += (part * weights.astype(part.dtype)) @ part.T
        at = to
    return shared


def _exactly_linked(threshold: float):
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        """Connections by exact similarity within a tile of one loose group."""
        texts = pa.RecordBatch.from_arrays([pa.array(tile["text"], pa.binary())], names=["text"])
        parts, n = [], 0
        for block in blocks([texts], "text"):
            row, h, count = multisets(block.column("text"))
            parts.append(((row + n).astype(np.int32), h, count.astype(np.int32)))
            n += block.num_rows
        row, h, count = map(np.concatenate, zip(*parts))
        size = np.bincount(row, count, n)
        shared = _shared(row, h, count, n)
        total = size[:, None] + size[None] - shared
        i, j = np.nonzero((shared >= threshold * total - 1e-9) & (shared > 0))
        return _forest(tile["id"].to_numpy(), _joined(np.arange(n), i, j))

    return run


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, deviations: float = 4.0) -> DataFrame:
    """One row per row of ``docs``: (key, class_id, kept).

    Documents are linked where the weighted Jaccard similarity of their multisets of
    five-word shingles reaches ``threshold``; ``class_id`` is the smallest key a document
    is connected with and ``kept`` marks that one. Shorter texts are one shingle. Texts
    null, empty or without words, and rows with a null key, are linked with nothing.
    Rows that repeat a key are one document: all get the smallest class of their texts.
    Other columns are ignored.

    Equal multisets are one row until the end. In a bucket every member is estimated
    against a leader, which differs from band to band, and verified against the best.
    Only where a bucket then still holds several classes are its members put into
    loose groups by estimate, whose texts are compared exactly in tiles of bounded
    size that return no more links than they have rows. Pairs whose estimate lies more
    than ``deviations`` standard errors below the threshold are not compared.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    keyed = rows.where(F.col("id").isNotNull()).withColumn("place", F.xxhash64("text"))
    signed = keyed.select("id", "place", closed(F.col("text")).alias("text")).mapInArrow(
        _sign, "id long, place long, c1 long, c2 long, bands array<long>, prints array<long>"
    )
    signed = stage(signed, "bag-signatures")
    classes = signed.groupBy("c1", "c2").agg(
        F.min(F.struct("id", "place")).alias("rep"), F.first("bands").alias("bands"), F.first("prints").alias("prints")
    )
    # A class is a node of its own, by a number: a key whose texts differ stands for several classes.
    classes = classes.select("c1", "c2", F.col("rep.id").alias("doc"), "rep.place", "bands", "prints")
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "bag-classes")

    buckets = classes.select("id", F.posexplode("bands").alias("band", "bucket"))
    # Members' order differs between groups of bands, and with it the leader.
    turn = F.struct(F.xxhash64("id", F.col("band") % 4).alias("t"), F.col("id").alias("leader"))
    shared = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("m")).where("n > 1")
    members = stage(buckets.join(shared.select("band", "bucket", "m.leader"), ["band", "bucket"]), "bag-buckets")
    stars = members.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()

    prints = classes.select("id", "prints")
    least = REGISTERS * threshold - deviations * (REGISTERS * threshold * (1 - threshold)) ** 0.5
    estimated = (
        stars.join(prints.select(F.col("id").alias("a"), F.col("prints").alias("p")), "a")
        .join(prints.select(F.col("id").alias("b"), F.col("prints").alias("q")), "b")
        .select("a", "b", _agreeing(F.col("p"), F.col("q")).alias("agree"))
        .where(F.col("agree") >= least)
    )
    estimated = stage(estimated, "bag-stars")

    # Everything that may have to be compared exactly, read from the corpus once.
    wanted = members.select("id").distinct().join(classes.select("id", "doc", "place"), "id")
    texts = keyed.select(F.col("id").alias("doc"), "place", "text").join(wanted, ["doc", "place"])
    texts = texts.dropDuplicates(["id"]).select("id", closed(F.col("text")).alias("text"))
    texts = stage(texts, "bag-texts")

    best = estimated.groupBy("b").agg(F.min(F.struct((-F.col("agree")).alias("order"), "a")).alias("x")).select("x.a", "b")
    links = stage(_verified(best, texts, threshold), "bag-links")
    of = stage(components(links), "bag-components")

    def component(side: str) -> DataFrame:
        return of.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))

    # Members of one bucket that are still in different classes: loose groups by estimate.
    split = members.select("band", "bucket", "id").join(component("id"), "id", "left")
    split = split.withColumn("of", F.coalesce("of_id", "id")).drop("of_id").join(prints, "id")
    mixed_up = split.groupBy("band", "bucket").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo < hi")
    split = split.join(mixed_up.select("band", "bucket"), ["band", "bucket"], "left_semi")
    tiles = _tiles(split.drop("of"), ["band", "bucket"], 1_000).groupBy("band", "bucket", "i", "j")
    near = tiles.applyInPandas(_loosely_linked(least), "a long, b long").distinct()
    loose = components(estimated.select("a", "b").unionByName(near))
    # In a loose group with several classes every two texts are compared exactly, tile by tile.
    loose = stage(loose.select(F.col("node").alias("id"), F.col("component").alias("loose")).join(component("id"), "id", "left"), "bag-loose")
    several = loose.groupBy("loose").agg(F.min(F.coalesce("of_id", "id")).alias("lo"), F.max(F.coalesce("of_id", "id")).alias("hi"))
    open_groups = loose.join(several.where("lo < hi").select("loose"), "loose", "left_semi").select("loose", "id").join(texts, "id")
    tiles = _tiles(open_groups, ["loose"], 300, F.octet_length("text"), BLOCK_BYTES).groupBy("loose", "i", "j")
    exact = tiles.applyInPandas(_exactly_linked(threshold), "a long, b long")
    links = links.unionByName(stage(exact, "bag-links"))

    of = components(links)
    named = classes.select("c1", "c2", "id", "doc").join(component("id"), "id", "left").withColumn("of", F.coalesce("of_id", "id"))
    least_key = named.groupBy("of").agg(F.min("doc").alias("class_id"))
    named = named.join(least_key, "of")
    ids = signed.select(F.col("id").alias("doc"), "c1", "c2").join(named.select("c1", "c2", "class_id"), ["c1", "c2"])
    ids = ids.groupBy("doc").agg(F.min("class_id").alias("class_id"))
    out = rows.join(ids, F.col("id") == F.col("doc"), "left").select(F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("class_id")))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents without those that a smaller key of their class stands for; null keys stay."""
    gone = near_copies(docs, key, text, **how).where("not kept").select(F.col(key).alias("_gone")).distinct()
    return set_aside(docs, lambda rows: rows.join(gone, F.col(key) == F.col("_gone"), "left_anti"), key)
