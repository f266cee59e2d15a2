"""Packing documents into windows with lexically close neighbours.

Documents are first dealt by a rare word that they share with others anywhere in the corpus. Each task
then cuts its rows into shards, indexes a shard's documents by BM25 and fills windows: a seed document
is followed by the unused documents that its terms retrieve, best first, and the last one is cut where
the window ends. Rows are sorted within their tasks, so a lost task repeats its shards alike.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import Words, blocks, closed, content
from tidemark.session import spread, stage

END_OF_DOCUMENT = 1  # fixed value: the id that closes every document
SKETCH_BITS = 20  # of the counters of words, 4 MB in every task whatever the corpus
ROUTE_WORDS = 16  # words of a document, the rarest by the counters, that are counted exactly
MOST_TOGETHER = 500  # documents of one route that are kept together; a larger group is split
_SPACE = np.isin(np.arange(256), [*range(9, 14), 32])
_ALNUM = np.array([chr(b).isalnum() for b in range(128)] + [False] * 128)
_MARK = (np.arange(256) > 0x20) & (np.arange(256) < 0x7F) & ~_ALNUM
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _solid(data: np.ndarray) -> np.ndarray:
    """Bytes that end a character which is surely no white space: beyond ASCII, those lead by C3-DF, E4-EF and F0 on."""
    solid = (data > 0x20) & (data < 0x7F)
    more = data >= 0x80
    for back, low, high in ((1, 0xC3, 0xDF), (2, 0xE4, 0xEF), (3, 0xF0, 0xFF)):
        solid[back:] |= more[back:] & (data[:-back] >= low) & (data[:-back] <= high)
    return solid


def _chunk_bounds(data: np.ndarray, bounds: np.ndarray, added: list[bytes]) -> np.ndarray:
    """Where texts begin and end, and places inside at which ``PATTERN`` always ends a match and looks no further.

    These lie before white space behind any other character, and before an ASCII mark behind an
    ASCII letter or digit. The pieces of a chunk are then those it has in its text. Added tokens stay whole.
    """
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = _SPACE[data[1:]] & _solid(data)[:-1] | _MARK[data[1:]] & _ALNUM[data[:-1]]
    raw = data.tobytes() if added else b""
    for token in added:
        at = raw.find(token)
        while at >= 0:
            cut[at + 1 : at + len(token)] = False
            at = raw.find(token, at + 1)
    cut[bounds] = True
    return np.flatnonzero(cut)


def byte_bpe(path: str, added_tokens: bool = False) -> Callable[[list[str]], list[np.ndarray]]:
    """Encoder of a byte-level BPE given as ``tokenizers`` JSON: the ids of each text.

    With ``added_tokens`` the JSON's added tokens get their ids wherever a text holds them, as
    ``tokenizers`` does by default; without, they are ordinary text. Ranks are read from the JSON's
    merges and run by tiktoken, which gives the ids that ``tokenizers`` gives (tested) about five times faster.
    The texts of a call are cut into chunks where the pattern ends a piece whatever stands around, and
    equal chunks are encoded once.
    """
    import json

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model = whole["model"]
    added = {t["content"]: t["id"] for t in whole.get("added_tokens", [])} if added_tokens else {}
    if any(t[k] for t in whole.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip") if added):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    # Byte-level vocabularies spell bytes as printable characters; the others move to 256 and up, in order.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(printable))}
    ranks = {}
    for piece, rank in model["vocab"].items():
        if all(c in byte_of for c in piece) and not (piece.startswith("<|") and piece.endswith("|>")):
            ranks[bytes(byte_of[c] for c in piece)] = rank
    encoding = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    names = [name.encode() for name in added]
    spaced = any(c.isspace() for name in added for c in name)  # chunks put side by side could spell such a token
    width = np.zeros(1 + max([*ranks.values(), *added.values()]), np.int64)
    width[list(ranks.values())] = [len(x) for x in ranks]
    width[list(added.values())] = [len(x) for x in names]

    def ids_of(data: bytes) -> np.ndarray:
        return encoding.encode_to_numpy(data.decode(), allowed_special="all", disallowed_special=())

    def encode(texts: list[str]) -> list[np.ndarray]:
        data, bounds = content(pa.array([t.encode() for t in texts], pa.large_binary()))
        cut = np.unique(bounds) if spaced else _chunk_bounds(data, bounds, names)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut), pa.py_buffer(data)])
        chunks = chunks.dictionary_encode()
        code, distinct = chunks.indices.to_numpy(), chunks.dictionary

        # Chunks between white space or an ASCII mark or letter and a solid end are encoded side by side, a line
        # feed before those that do not begin with white space; no match crosses their bounds. The few others stand alone.
        data, at = content(distinct)
        start = data[at[:-1]]
        plain = np.zeros(len(distinct), bool) if spaced else (_SPACE[start] | (start > 0x20) & (start < 0x7F)) & _solid(data)[at[1:] - 1]
        data, at = content(distinct.filter(pa.array(plain)))
        fed = ~_SPACE[data[at[:-1]]]
        moved = np.cumsum(fed)
        found = [ids_of(np.insert(data, at[:-1][fed], 0x0A).tobytes())]
        end = np.cumsum(width[found[0]])
        first, last = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        first[plain] = np.searchsorted(end, at[:-1] + moved, "right")
        last[plain] = np.searchsorted(end, at[1:] + moved, "right")
        held = len(end)
        for k in np.flatnonzero(~plain):
            found.append(ids_of(distinct[k].as_py()))
            first[k], held = held, held + len(found[-1])
            last[k] = held

        # Every chunk's ids, text by text.
        size = (last - first)[code]
        ends = np.cumsum(size)
        ids = np.concatenate(found)[np.arange(size.sum()) + np.repeat(first[code] - ends + size, size)].astype(np.uint32)
        edge = np.concatenate([[0], ends])[np.searchsorted(cut, bounds)]
        return [ids[a:b] for a, b in zip(edge[:-1], edge[1:])]

    return encode


class Index:
    """BM25 over one shard's documents, as term-sorted postings in arrays."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        size = np.array([len(d) for d in docs])
        pair = np.concatenate(docs).astype(np.int64) << 32 | np.repeat(np.arange(len(docs)), size)
        pair, tf = np.unique(pair, return_counts=True)
        self.doc = pair & 0xFFFFFFFF
        terms, first, df = np.unique(pair >> 32, return_index=True, return_counts=True)
        self.first, self.df, self.size = first, df, df
        self.alive = np.arange(len(docs))  # the documents that postings speak of, by their place among them
        idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5))
        norm = k1 * (1 - b + b * size[self.doc] / max(1.0, size.mean()))
        self.weight = np.repeat(idf, df) * tf * (k1 + 1) / (tf + norm)
        # A document's terms from the rarest on.
        term = np.repeat(np.arange(len(terms)), df)
        by_df = np.lexsort((np.arange(len(terms)), df))
        rank = np.empty(len(terms), np.int64)
        rank[by_df] = np.arange(len(terms))
        own = np.sort(self.doc * len(terms) + rank[term])
        self.terms = by_df[own % max(1, len(terms))]
        self.own = np.searchsorted(own, np.arange(len(docs) + 1) * len(terms))

        # Terms of an eighth of the documents and more are columns of a matrix.
        self.hot = np.flatnonzero(df * 8 > len(docs))
        self.column = np.full(len(terms), -1)
        self.column[self.hot] = np.arange(len(self.hot))
        self.dense = np.zeros((len(docs), len(self.hot)), np.float32)
        column = self.column[term]
        self.dense[self.doc[column >= 0], column[column >= 0]] = self.weight[column >= 0]

    def shrink(self, unused: np.ndarray) -> None:
        """Forget the postings of used documents; weights stay, so every later answer is the same."""
        stays = unused[self.alive]
        place = np.cumsum(stays) - 1
        keep = stays[self.doc]
        sums = np.concatenate([[0], np.cumsum(keep)])
        self.first, self.size = sums[self.first], sums[self.first + self.size] - sums[self.first]
        self.doc, self.weight = place[self.doc[keep]], self.weight[keep]
        self.dense, self.alive = self.dense[stays], self.alive[stays]

    def neighbours(self, seed: int, unused: np.ndarray, n_terms: int | None = None, most: int | None = None) -> np.ndarray:
        """Unused documents that share one of the seed's terms, best first; ties by place.

        ``n_terms`` looks only the seed's rarest shared terms up. At least the best ``most`` are returned, where so many are found.
        """
        terms = self.terms[self.own[seed] : self.own[seed + 1]]
        terms = terms[self.df[terms] > 1][:n_terms]
        if not len(terms):
            return terms
        column = self.column[terms]
        unused = unused[self.alive]
        score = np.zeros(len(unused))
        if (column >= 0).any():
            chosen = np.zeros(len(self.hot), np.float32)
            chosen[column[column >= 0]] = 1
            score += self.dense @ chosen
        terms = terms[column < 0]
        if len(terms):
            size = self.size[terms]
            at = np.arange(size.sum()) + np.repeat(self.first[terms] - np.cumsum(size) + size, size)
            score += np.bincount(self.doc[at], self.weight[at], len(unused))
        found = np.flatnonzero(unused & (score > 0))
        score = score[found]
        if most and len(found) > most:
            best = score >= np.partition(score, len(score) - most)[len(score) - most]
            found, score = found[best], score[best]
        return self.alive[found[np.lexsort((found, -score))]]


def pack_shard(ids: list[np.ndarray], window: int, n_terms: int | None = None) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold every id once.

    Whole windows of a long document stand alone; what is left of it is packed. All
    sequences are full but the shard's last, which is cut into powers of two, so
    nothing is padded.
    """
    pieces, sequence = [], 0
    left = np.zeros(len(ids), np.int64)  # where the unpacked rest of each document starts
    for d, x in enumerate(ids):
        for start in range(0, len(x) - window + 1, window):
            pieces.append((d, start, window, sequence, 0))
            sequence += 1
        left[d] = len(x) // window * window
    size = np.array([len(x) for x in ids])
    unused = left < size
    index = Index([x[:-1] if len(x) > 1 else x for x in ids])

    last: list[tuple[int, int, int]] = []  # pieces of the open sequence
    seeds = iter(range(len(ids)))
    carried = None  # a document cut at a window's end goes on in the next one
    filled = 0
    while True:
        seed = carried
        if seed is None:
            seed = next((d for d in seeds if unused[d]), None)
            if seed is None:
                break
        carried = None
        unused[seed] = False
        if 2 * np.count_nonzero(unused) < len(index.alive):
            index.shrink(unused)
        queue = [seed, *index.neighbours(seed, unused, n_terms, window).tolist()]
        for d in queue:
            take = int(min(size[d] - left[d], window - filled))
            unused[d] = False
            last.append((d, int(left[d]), take))
            left[d] += take
            filled += take
            if filled == window:
                offset = 0
                for piece in last:
                    pieces.append((*piece, sequence, offset))
                    offset += piece[2]
                sequence, last, filled = sequence + 1, [], 0
                if left[d] < size[d]:
                    carried = d
                break
    # The open sequence, in sequences of falling powers of two.
    room = 0
    for d, start, length in last:
        while length:
            if not room:
                room = width = 1 << (filled.bit_length() - 1)
                filled -= width
                sequence += 1
            take = min(length, room)
            pieces.append((d, start, take, sequence - 1, width - room))
            start, length, room = start + take, length - take, room - take
    return pieces


def _counters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts the words of each counter stand, of one task."""
    n = np.zeros(1 << SKETCH_BITS, np.int64)
    for block in blocks(batches, "text"):
        words = Words(block.column("text"))
        slot = (words.hashes() >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
        pairs = np.sort(words.text() << SKETCH_BITS | slot)
        pairs = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
        n += np.bincount(pairs & (1 << SKETCH_BITS) - 1, minlength=len(n))
    slot = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(n[slot])], names=["slot", "n"])


def dealt(rows: DataFrame) -> DataFrame:
    """Rows (id, text) with those that share a rare word in one task, side by side.

    Fixed counters of hashed words over the whole corpus name the words of each document
    that may be rare; how many documents have each of those is then counted exactly, and a
    document goes by the rarest that it shares. A group of more than ``MOST_TOGETHER``
    documents is split. Documents that share none of them are spread. No row is lost.
    Routes are kept by a hash of the text: equal texts have equal words.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("_row", F.xxhash64("text"))
    bare = rows.select("_row", closed(F.col("text")).alias("text"))
    counted = bare.select("text").mapInArrow(_counters, "slot int, n long").groupBy("slot")
    counted = counted.agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n")).toArrow()
    n = np.zeros(1 << SKETCH_BITS, np.int32)
    n[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    counters = spark.sparkContext.broadcast(n)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = counters.value
        for block in blocks(batches, "text"):
            words = Words(block.column("text"))
            h, text = words.hashes(), words.text()
            df = n[h >> np.uint64(64 - SKETCH_BITS)]
            h, text, df = h[df > 1], text[df > 1], df[df > 1]
            # Texts of a block, counts and hashes in one number: the rarest first in each text, equal words side by side.
            rank = text.astype(np.uint64) << np.uint64(43) | np.minimum(df, (1 << 15) - 1).astype(np.uint64) << np.uint64(28)
            order = np.argsort(rank | h >> np.uint64(36))
            h, text = h[order], text[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
            h, text = h[new], text[new]
            place = np.arange(len(h)) - np.searchsorted(text, text)
            keep = place < ROUTE_WORDS
            yield pa.RecordBatch.from_arrays(
                [block.column("_row").take(pa.array(text[keep])), pa.array(h[keep].view(np.int64))], names=["_row", "h"]
            )

    words = stage(bare.mapInArrow(rare, "_row long, h long"), "packing-words")
    shared = words.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    routes = words.join(shared, "h").groupBy("_row").agg(F.min(F.struct("df", "h")).alias("_by"))
    # Without a route a row is a group of its own.
    pieces = F.ceil(F.col("_by.df") / MOST_TOGETHER)
    routed = rows.join(routes, "_row", "left").select(
        "id", "text", "_row", F.coalesce("_by.h", F.xxhash64("id", "text")).alias("_route"),
        F.coalesce(F.pmod(F.xxhash64("id", "text"), pieces), F.lit(0)).alias("_piece"),
    )
    return spread(routed, "_route", "_piece").sortWithinPartitions("_route", "_piece", "_row", "id").select("id", "text")


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = 2048, shard_bytes: int = 4 << 20,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``tokenizer`` is the path of the vocabulary, readable where tasks run. Null and empty texts have the closing
    id alone. Repeated rows are packed each for itself; other columns are ignored.
    ``shard_bytes`` of text, or one longer document, make a shard: it bounds a task's
    memory, and drops nothing; ``dealt`` brings neighbours together before. Sequence numbers
    start at the partition's number times 2**33. ``added_tokens`` as in ``byte_bpe``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(tokenizer, added_tokens)
        sequence = TaskContext.get().partitionId() << 33
        keys, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, keys, texts, held
            ids = [np.concatenate([x, np.array([END_OF_DOCUMENT], np.uint32)]) for x in encode(texts)]
            pieces = pack_shard(ids, window)
            doc, start, length, own, offset = map(np.array, zip(*pieces))
            crc = [zlib.crc32(ids[d][a : a + n].astype("<u4")) for d, a, n, *_ in pieces]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, id_type).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                    pa.array(np.array([len(x) for x in ids])[doc]), pa.array(own + sequence), pa.array(offset),
                ],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )
            sequence += int(own.max()) + 1
            keys, texts, held = [], [], 0
            return out

        for batch in batches:
            id_type = batch.schema.field("id").type
            for one in range(0, batch.num_rows, 256):
                part = batch.slice(one, 256)
                for k, t in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    if keys and held + len(t) > shard_bytes:
                        yield flush()
                    keys.append(k)
                    texts.append(t)
                    held += len(t)
        if keys:
            yield flush()
        batch = part = None
        pa.default_memory_pool().release_unused()  # else the idle worker keeps it

    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return dealt(rows).mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", key)
