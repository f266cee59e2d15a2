"""Phrases of two and three words that keep company more often than chance, by dynamic itemset counting.

The corpus is cut into shards that are scanned in turn, again and again. Single words are counted
from the first scan on. As soon as both subphrases of a longer phrase have reached the threshold,
wherever in the cycle that is, the phrase is counted from the next scan on, until each shard was
scanned once with it: one full cycle. Words, pairs and triples are so counted in the same scans, and
scanning ends when no phrase is left within its cycle.

The scans count 64-bit hashes of phrases. Numpy counts those of some blocks and cuts them by their
first bits into buckets, packed as one row each; Spark brings the rows of a bucket together, where
numpy adds the counts up. There are two buckets or more to each shuffle partition. Bloom filters of a
fixed size, one for each scan that found new frequent phrases, hold all phrases that were frequent by
then and tell a task when a longer phrase begins: in the scan after the first filters that hold its
subphrases. A filter holds whatever an earlier one does, by mistake too, so a phrase begins in the
same scan whichever filters a task still has: phrases of equal hashes, or held by mistake, only make
longer ones begin sooner, and each is counted for its full cycle. A last pass spells the phrases
whose hash got frequent and counts them as strings, so no count rests on a hash; rare phrases, which
are most, never travel as strings.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import END, blocks, closed, content, mixed, span_hashes
from tidemark.session import new_folder, stage

_BITS = 25  # a filter has 2 ** 25 bits, 4 MB, however many phrases are frequent; fuller filters let more through
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORD, _GAP, _CUT = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?\x0a\x0b\x0c\x0d", END]] = _CUT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_NEVER = 1 << 30
_SPELLED = ["lang", "size", "phrase", "n"]
_AT_ONCE = 1 << 21  # hashes that a task holds before it counts them
_LANES = 64  # the best phrases of a language are first found in so many parts of it


class _Filter:
    """Set membership without false negatives, in a table of fixed size."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def __getstate__(self) -> bytes:
        return zlib.compress(self.table.tobytes(), 1)  # every scan's tasks get the filters, which are sparse on small tables

    def __setstate__(self, packed: bytes) -> None:
        self.table = np.frombuffer(zlib.decompress(packed), np.uint64)

    @staticmethod
    def slots(h: np.ndarray, size: int = 0) -> np.ndarray:
        low = np.uint64((size or 1 << _BITS) - 1)
        return np.concatenate([h & low, (h >> np.uint64(32)) & low]).astype(np.int64)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = self.slots(h, 64 * len(self.table))
        found = (self.table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return (found[: len(h)] & found[len(h) :]).astype(bool)

    @staticmethod
    def union(filters: list[_Filter]) -> _Filter:
        return _Filter(reduce(np.bitwise_or, [f.table for f in filters], np.zeros(1 << (_BITS - 6), np.uint64)))


def _since(filters: dict[int, _Filter], h: np.ndarray) -> np.ndarray:
    """The first scan whose filter holds the phrase, or one past any scan."""
    since = np.full(len(h), _NEVER, np.int64)
    for scan in sorted(filters, reverse=True):
        since[filters[scan](h)] = scan
    return since


class _Words:
    """The words of a block of texts: a hash of language and word, and the piece each word stands in."""

    def __init__(self, lang: pa.Array, text: pa.Array):
        data, bounds = content(text)
        self.data = np.concatenate([_LOWER[data], np.full(8, END, np.uint8)])
        kind = _KIND[self.data]
        self.inside = kind == _WORD
        edge = np.flatnonzero(self.inside[1:] != self.inside[:-1]) + 1
        if self.inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[::2], edge[1::2]
        self.n = len(self.start)
        self.piece = np.searchsorted(np.flatnonzero(kind == _CUT), self.start)
        langs = lang.dictionary_encode()
        self.langs, row_lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.lang = row_lang[np.searchsorted(bounds, self.start, "right") - 1]
        eights = np.ndarray(len(self.data) - 7, "<u8", self.data.data, 0, (1,))
        seeds = np.array([_seed(x) for x in self.langs.to_pylist()], np.uint64)
        self.hash = mixed(span_hashes(eights, self.start, self.end) + seeds[self.lang]) if self.n else np.zeros(0, np.uint64)

    def within(self, k: int) -> np.ndarray:
        """Positions at which ``k`` words in a row stand in one piece."""
        return np.flatnonzero(self.piece[: max(0, self.n - k + 1)] == self.piece[k - 1 :])

    def pairs(self, at: np.ndarray) -> np.ndarray:
        return _joined(self.hash[at], self.hash[at + 1])

    def triples(self, at: np.ndarray) -> np.ndarray:
        return _joined(self.pairs(at), self.hash[at + 2])


def _joined(head: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its head and its last word."""
    return mixed(head * _ODD + last)


def _seed(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode() + bytes([END] * 8), np.uint8)
    eights = np.ndarray(len(raw) - 7, "<u8", raw.data, 0, (1,))
    return span_hashes(eights, np.zeros(1, np.int64), np.array([len(raw) - 8]))[0]


def _packed(bits: int, size: int, start: int, h: np.ndarray) -> pa.RecordBatch:
    """Counts of hashes: a row for each bucket of the first ``bits`` bits, its hashes in order."""
    h, n = np.unique(h, return_counts=True)
    edge = np.searchsorted(h, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    bucket = np.flatnonzero(np.diff(edge, append=len(h)))
    bounds = pa.py_buffer((8 * np.append(edge[bucket], len(h))).astype(np.int32))
    blobs = [pa.Array.from_buffers(pa.binary(), len(bucket), [None, bounds, pa.py_buffer(x)]) for x in (h, n.astype(np.int64))]
    columns = [bucket.astype(np.int32), np.full(len(bucket), size, np.int32), np.full(len(bucket), start, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns] + blobs, names=["bucket", "size", "start", "h", "n"])


def _counted(filters: dict[int, dict[int, _Filter]], begun: range, words: bool, bits: int):
    """Count the words of the texts, and the phrases, begun in these scans, of the sizes that have filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (size, start), hashes in held.items():
                yield _packed(bits, size, start, np.concatenate(hashes))
            held.clear()

        for block in blocks(batches, "text"):
            found = _Words(block.column("lang"), block.column("text"))
            if words:
                held.setdefault((1, 0), []).append(found.hash)
            if 2 in filters:
                since, at = _since(filters[2], found.hash), found.within(2)
                start = np.maximum(since[at], since[at + 1]) + 1
                for scan in begun:
                    held.setdefault((2, scan), []).append(found.pairs(at[start == scan]))
            if 3 in filters:
                since, at = np.full(found.n + 1, _NEVER, np.int64), found.within(2)
                since[at] = _since(filters[3], found.pairs(at))
                at = found.within(3)
                start = np.maximum(since[at], since[at + 1]) + 1
                for scan in begun:
                    held.setdefault((3, scan), []).append(found.triples(at[start == scan]))
            if sum(len(h) for hashes in held.values() for h in hashes) >= _AT_ONCE:
                yield from flush()
        yield from flush()

    return run


def _groups(rows: pa.Table, *keys: str) -> Iterator[tuple[tuple[int, ...], pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each value of the keys: it, its rows, their hashes in order, the counts and the row of each, and where new hashes begin."""
    values = np.stack([rows.column(k).to_numpy() for k in keys])
    for value in np.unique(values, axis=1).T:
        part = rows.filter(pa.array((values == value[:, None]).all(axis=0)))
        h, n = (np.concatenate([content(c)[0] for c in part.column(k).chunks]) for k in ("h", "n"))
        h, n = h.view(np.uint64), n.view(np.int64)
        row = np.repeat(np.arange(part.num_rows), pc.binary_length(part.column("h")).to_numpy() // 8)
        order = np.argsort(h)
        h = h[order]
        yield tuple(value.tolist()), part, h, n[order], row[order], np.flatnonzero(np.append(True, h[1:] != h[:-1]))


def _merged(full: int):
    """Add up the counts of a bucket. Hashes that the scan holds ``full`` times are in a row of their own."""

    def run(rows: pa.Table) -> pa.Table:
        out = []
        for (bucket, size, start), _, h, n, _, first in _groups(rows, "bucket", "size", "start"):
            h, n = h[first], np.add.reduceat(n, first)
            for often in (True, False):
                which = (n >= full) == often
                if which.any():
                    out.append((bucket, size, start, often, h[which].tobytes(), n[which].tobytes()))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=["bucket", "size", "start", "often", "h", "n"])

    return run


def _frequent(least: int, full: int, last: int):
    """Hashes of a bucket that are held ``least`` times by the scans, with the scan whose well-filled ones, or the last, made them so."""

    def run(rows: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for _, part, h, n, row, first in _groups(rows, "start"):
            scan, filled = part.column("scan").to_numpy()[row], np.where(n >= full, n, 0)
            since = np.full(len(first), last)
            for k in sorted(set(part.column("scan").to_pylist()), reverse=True):
                since[np.add.reduceat(np.where(scan <= k, filled, 0), first) >= least] = k
            enough = np.add.reduceat(n, first) >= least
            out.append((h[first][enough], since[enough]))
        h, since = map(np.concatenate, zip(*out))
        return pa.table([pa.array(h.view(np.int64)), pa.array(since.astype(np.int32))], names=["h", "since"])

    return run


class _Spelled(_Words):
    """Words with codes of (language, word), for those that a filter of the frequent words holds; others have -1."""

    def __init__(self, lang: pa.Array, text: pa.Array, words: _Filter):
        super().__init__(lang, text)
        offsets = np.concatenate([[0], np.cumsum(self.end - self.start)]).astype(np.int64)
        spelled = pa.Array.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(offsets), pa.py_buffer(self.data[self.inside])])
        held = np.flatnonzero(words(self.hash))
        spelled = spelled.take(pa.array(held)).dictionary_encode()
        several = max(1, len(spelled.dictionary))
        keys = self.lang[held] * several + spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        keys, code = np.unique(keys, return_inverse=True)
        self.code = np.full(self.n, -1, np.int64)
        self.code[held] = code
        self.code_lang = keys // several
        self.word = spelled.dictionary.take(pa.array(keys % several))

    def _rows(self, codes: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        phrase = self.word.take(pa.array(codes[0]))
        if len(codes) > 1:
            phrase = pc.binary_join_element_wise(phrase, *[self.word.take(pa.array(c)) for c in codes[1:]], pa.scalar(b" ", pa.large_binary()))
        lang = self.langs.take(pa.array(self.code_lang[codes[0]]))
        size = pa.array(np.full(len(n), len(codes), np.int32))
        return pa.RecordBatch.from_arrays([lang, size, phrase.cast(pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64))], names=_SPELLED)

    def totals(self) -> pa.RecordBatch:
        """The number of all words per language, as phrases of no words."""
        size, zero = len(self.langs), np.zeros(len(self.langs), np.int64)
        n = np.bincount(self.lang, minlength=size).astype(np.int64)
        return pa.RecordBatch.from_arrays([self.langs, pa.array(zero.astype(np.int32)), pa.array([""] * size, pa.string()), pa.array(n)], names=_SPELLED)

    def ones(self) -> pa.RecordBatch:
        size = len(self.word)
        return self._rows([np.arange(size)], np.bincount(self.code[self.code >= 0], minlength=size))

    def twos(self, held: _Filter) -> pa.RecordBatch:
        at, size = self.within(2), max(1, len(self.word))
        at = at[(self.code[at] >= 0) & (self.code[at + 1] >= 0)]
        at = at[held(self.pairs(at))]
        keys, n = np.unique(self.code[at] * size + self.code[at + 1], return_counts=True)
        return self._rows([keys // size, keys % size], n)

    def threes(self, held: _Filter) -> pa.RecordBatch:
        at, size = self.within(3), max(1, len(self.word))
        at = at[(self.code[at] >= 0) & (self.code[at + 1] >= 0) & (self.code[at + 2] >= 0)]
        at = at[held(self.triples(at))]
        # Pairs by number first: three codes in one whole number could pass 64 bits in a very long text.
        pairs, pair = np.unique(self.code[at] * size + self.code[at + 1], return_inverse=True)
        keys, n = np.unique(pair * size + self.code[at + 2], return_counts=True)
        first = pairs[keys // size] if len(keys) else keys
        return self._rows([first // size, first % size, keys % size], n)


def _spelled(held: dict[int, _Filter]):
    """Count the phrases that the filter of their size holds, spelled out, and all words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 2 << 20):
            found = _Spelled(block.column("lang"), block.column("text"), held[1])
            yield found.totals()
            yield found.ones()
            yield found.twos(held[2])
            yield found.threes(held[3])

    return run


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spelled phrases with the hash that the scans gave them; those of no words have 0."""
    for block in blocks(batches, "text"):
        words = _Words(block.column("lang"), block.column("text")).hash
        size = block.column("size").to_numpy()
        first, h = np.cumsum(size) - size, np.zeros(len(size), np.uint64)
        for k in range(int(size.max())):
            longer = size > k
            last = words[first[longer] + k]
            h[longer] = _joined(h[longer], last) if k else last
        columns = [block.column(k) for k in ("lang", "size", "phrase")] + [pa.array(h.view(np.int64)), block.column("n")]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "h", "n"])


def _filter(hashes: DataFrame) -> _Filter:
    """A filter of the column ``h``; its bits are put together by Spark, and reach the driver in its fixed size."""
    low = (1 << _BITS) - 1
    slots = hashes.select(F.expr(f"explode(array(h & {low}L, shiftrightunsigned(h, 32) & {low}L)) as slot"))
    bits = slots.groupBy(F.expr("shiftright(slot, 6) as place")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int))) as bits"))
    found = bits.toArrow()  # up to half a million rows: as Python objects they would fill the driver
    table = np.zeros(1 << (_BITS - 6), np.uint64)
    table[found["place"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return _Filter(table)


def part(words: int, name: str = "phrase") -> Column:
    """The first ``words`` words of a phrase, or the last ones where negative."""
    return F.substring_index(F.col(name), " ", words)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, shards: int = 3) -> tuple[dict[int, DataFrame], DataFrame]:
    """Stored tables (lang, phrase, n, since) of the frequent words, pairs and triples, and (lang, n) of all words.

    ``shards`` is the length of the cycle; it changes how soon longer phrases are begun, never the counts.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), closed(F.col(text), lower=False).alias("text")
    ).withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    path = new_folder(spark, "shards")
    rows.write.partitionBy("shard").parquet(path)
    corpus = spark.read.schema(rows.schema).parquet(path)
    full = -(-least // shards)  # a frequent phrase has a scan with so many; sums of such scans alone are never too high

    scans: dict[int, dict[int, DataFrame]] = {1: {}, 2: {}, 3: {}}
    bits = (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    ended: list[DataFrame] = []
    reached: dict[int, dict[int, _Filter]] = {1: {}, 2: {}}  # by scan that found some, the phrases frequent by its end

    def sums(size: int, cycle: dict[int, DataFrame], which: Column, filled: int, last: int) -> DataFrame:
        """Hashes that are frequent by these scans, with the scan in which those of ``filled`` counts, or the last, made them so."""
        columns = ["bucket", "start", "h", "n"]
        rows = reduce(DataFrame.unionByName, [df.where(which).select(*columns, F.lit(k).alias("scan")) for k, df in cycle.items()])
        found = rows.groupBy("bucket").applyInArrow(_frequent(least, filled, last), "h long, since int")
        return found.select(F.lit(size).alias("size"), "h", "since")

    for scan in count():
        begun = range(max(0, scan - shards + 1), scan + 1)
        filters = {}
        for size in (2, 3):
            recent = {k: f for k, f in reached[size - 1].items() if k + 1 in begun}
            if recent:
                older = [f for k, f in reached[size - 1].items() if k not in recent][-1:]
                filters[size] = recent | {begun.start - 2: f for f in older}
        if scan >= shards and not filters:
            break
        shard = corpus.where(F.col("shard") == scan % shards).select("lang", "text")
        counts = shard.mapInArrow(_counted(filters, begun, scan < shards, bits), "bucket int, size int, start int, h binary, n binary")
        merged = counts.groupBy("bucket").applyInArrow(_merged(full), "bucket int, size int, start int, often boolean, h binary, n binary")
        counts = stage(merged, "scan")
        for size in ([1] if scan < shards else []) + list(filters):
            scans[size][scan] = counts.where(F.col("size") == size).drop("size")
        for size in (1, 2):
            if scan not in scans[size]:
                continue
            first = scan - shards + 1
            cycle = {k: df for k, df in scans[size].items() if k >= first}
            new = [sums(size, cycle, (F.col("start") > first) & F.col("often"), full, scan)]
            if first >= 0:
                ended.append(stage(sums(size, cycle, F.col("start") == first, full, scan), "ended"))
                new.append(ended[-1])
            fresh = _filter(reduce(DataFrame.unionByName, new).where(F.col("since") == scan))
            if fresh.table.any():
                reached[size][scan] = _Filter.union([*list(reached[size].values())[-1:], fresh])
    held = {size: _Filter.union(list(reached[size].values())[-1:]) for size in (1, 2)} | {3: _Filter.union([])}
    # Nothing waits for triples: one sum when all cycles have ended.
    if scans[3]:
        ended.append(stage(sums(3, scans[3], F.lit(True), 1, _NEVER), "triples"))
        held[3] = _filter(ended[-1])
    spelled = corpus.select("lang", "text").mapInArrow(_spelled(held), "lang string, size int, phrase string, n long")
    spelled = spelled.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("size") == 0))
    # Hashes do not compress: those of the few phrases that are left are taken anew.
    spelled = spelled.withColumn("text", closed(F.col("phrase"), lower=False))
    spelled = stage(spelled.mapInArrow(_hashed, "lang string, size int, phrase string, h long, n long"), "spelled")
    begins = reduce(DataFrame.unionByName, ended).groupBy("size", "h").agg(F.min("since").alias("since"))
    found = stage(spelled.join(begins, ["size", "h"]).select("size", "lang", "phrase", "n", "since"), "frequent")
    words = spelled.where(F.col("size") == 0).select("lang", "n").where(F.col("n") > 0)
    return {size: found.where(F.col("size") == size).drop("size") for size in (1, 2, 3)}, words


def _score(a: str, left: str, right: str) -> Column:
    """floor(1,000,000 a a / (l r)) in whole numbers of up to 38 digits."""
    a, left, right = (f"cast({c} as decimal(15,0))" for c in (a, left, right))
    return F.expr(f"(cast(1000000 as decimal(7,0)) * {a} * {a}) div ({left} * {right})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, top: int = 2_000, shards: int = 3) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A null language counts as ``und``, a null text as empty; repeated rows all count; texts without
    words, and empty tables, give no rows. Ties go to the more frequent phrase, then by bytes. Other
    columns of any name are not read. A word of any length is a word.
    """
    found, words = frequent_phrases(docs, text, lang, least, shards)
    one, two, three = found[1], found[2], found[3]

    def counted(df: DataFrame, table: DataFrame, phrase: Column, out: str) -> DataFrame:
        return df.withColumn("sub", phrase).join(table.select("lang", F.col("phrase").alias("sub"), F.col("n").alias(out)), ["lang", "sub"]).drop("sub")

    pairs = counted(counted(two.select("lang", "phrase", F.col("n").alias("a")), one, part(1), "l"), one, part(-1), "r")
    pairs = pairs.withColumn("score", _score("a", "l", "r"))
    triples = three.select("lang", "phrase", F.col("n").alias("a"))
    for table, words_, out in ((one, 1, "l1"), (two, -2, "r1"), (two, 2, "l2"), (one, -1, "r2")):
        triples = counted(triples, table, part(words_), out)
    triples = triples.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    cuts = [F.when(F.col("s1") <= F.col("s2"), F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(name) for c, name in (("l", "l"), ("r", "r"), ("s", "score"))]
    triples = triples.select("lang", "phrase", "a", *cuts)

    # A pair falls where a triple around it is at least half as frequent.
    around = three.select("lang", F.explode(F.array(part(2), part(-2))).alias("phrase"), F.col("n").alias("longer"))
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    pairs = pairs.join(around, ["lang", "phrase"], "left").where(F.expr("longer is null or 2 * longer < a")).drop("longer")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    lane = F.pmod(F.xxhash64("phrase"), F.lit(_LANES))
    best = pairs.unionByName(triples).withColumn("rank", F.row_number().over(Window.partitionBy("lang", lane).orderBy(*order)))
    best = best.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    best = best.where(F.col("rank") <= top).join(words, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
worded as (select lang, [w for w in regexp_split_to_array(piece, '[\x20\x09]+') if w <> ''] as w from pieces),
grams as (
    select lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as phrase
    from worded, (values (1), (2), (3)) as sizes(k)),
f as materialized (select lang, k, phrase, count(*)::hugeint as n from grams group by all),
words as (select lang, sum(n)::bigint as n from f where k = 1 group by lang),
parts as (
    select c.lang, c.phrase, c.k as size, c.n as a, cut.k as cut_at, string_split(c.phrase, ' ') as w,
        array_to_string(w[1 : cut.k], ' ') as head, array_to_string(w[cut.k + 1 : c.k], ' ') as tail
    from f c join (values (1), (2)) as cut(k) on cut.k < c.k
    where c.k > 1 and c.n >= 10),
often as materialized (select lang, phrase, n from f where n >= 10),
cuts as (
    select p.lang, p.phrase, size, a, cut_at, l.n as l, r.n as r, (1000000::hugeint * a * a) // (l.n * r.n) as score
    from parts p
    join often l on l.lang = p.lang and l.phrase = head
    join often r on r.lang = p.lang and r.phrase = tail),
cut as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut_at) = 1),
around as (
    select lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) as phrase, a as longer
    from parts where size = 3 and cut_at = 1),
longest as (select lang, phrase, max(longer) as longer from around group by all),
kept as (
    select cut.* from cut left join longest using (lang, phrase)
    where size = 3 or longer is null or 100 * longer < 50 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, words.n as n, score::bigint as score
from ranked join words using (lang) where rank <= 2000
"""
