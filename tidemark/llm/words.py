"""Words of whole Arrow batches as numpy arrays: bytes, bounds and hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

END = 0xFF  # never a byte of UTF-8: closes every text

_CHARS = np.arange(256)
IS_WORD = ((_CHARS >= 48) & (_CHARS <= 57)) | ((_CHARS >= 97) & (_CHARS <= 122)) | ((_CHARS >= 128) & (_CHARS < END))
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def closed(text: Column, lower: bool = True) -> Column:
    """The text, lower-cased if asked, as UTF-8 bytes followed by END; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(F.encode(F.lower(text) if lower else text, "utf-8"), F.lit(bytearray([END])))


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of ``column``, or one longer row.

    After the last one Arrow gives back what it holds for reuse: the worker waits for its next task without it.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = content(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    batch = None
    pa.default_memory_pool().release_unused()


def content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column, uncopied, and the bounds of its rows in them."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    bounds = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every bit depends on all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words of the texts of one block.

    A word is a maximal run of ASCII letters and digits and of non-ASCII characters.
    ``start`` and ``end`` are byte positions, ``first[i]:first[i + 1]`` are the words of text i.
    """

    def __init__(self, column: pa.Array):
        data, self.bounds = content(column)
        self.data = np.concatenate([data, np.full(8, END, np.uint8)])
        inside = IS_WORD[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.bounds)
        self.eights = np.ndarray(len(self.data) - 7, "<u8", self.data.data, 0, (1,))

    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def heads(self, k: int) -> np.ndarray:
        """Hashes of the first ``k`` bytes, at most 8, of each word; 0 for shorter words."""
        long_enough = self.end - self.start >= k
        return np.where(long_enough, mixed((self.eights[self.start] & _MASKS[k]) + np.uint64(k * 0x9E3779B9)), 0)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.eights, self.start, self.end)


def span_hashes(eights: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of spans; ``eights[i]`` holds the eight bytes from i on."""
    size = end - start
    h = mixed((eights[start] & _MASKS[np.minimum(size, 8)]) + size.astype(np.uint64) * _ODD)
    at, rest = start + 8, np.flatnonzero(size > 8)
    while len(rest):
        left = end[rest] - at[rest]
        h[rest] = mixed(h[rest] * _ODD + (eights[at[rest]] & _MASKS[np.minimum(left, 8)]))
        at[rest] += 8
        rest = rest[left > 8]
    return h


def shingles(h: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row, and the bounds of each text's shingles.

    A text of fewer words has one shingle of all of them; without words it has none.
    """
    count = np.diff(first)
    n = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    bounds = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], n)
    last = np.repeat(first[1:], n) - 1
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        inside = at + k <= last
        out = mixed(out * _ODD + np.where(inside, h[np.minimum(at + k, last)], np.uint64(k)))
    return out, bounds


class Lookup:
    """Values by 64-bit key, for whole arrays of keys; absent keys give 0. Key 0 is absent."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, int(len(keys)).bit_length() + 1)
        keep = keys != 0
        keys, values = keys[keep], values[keep]
        while True:
            slot = keys >> np.uint64(64 - bits)
            if bits >= 22 or len(np.unique(slot)) == len(keys):
                break
            bits += 1
        # The rare keys that share a slot even in a large table are kept in order beside it.
        _, lone = np.unique(slot, return_index=True)
        rest = np.setdiff1d(np.arange(len(keys)), lone)
        rest = rest[np.argsort(keys[rest])]
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.asarray(values).dtype)
        self.keys[slot[lone]], self.values[slot[lone]] = keys[lone], values[lone]
        self.more, self.more_values = keys[rest], values[rest]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> self.shift
        out = np.where(self.keys[slot] == keys, self.values[slot], 0)
        if len(self.more):
            place = np.minimum(np.searchsorted(self.more, keys), len(self.more) - 1)
            out = np.where(self.more[place] == keys, self.more_values[place], out)
        return np.where(keys == 0, 0, out)
