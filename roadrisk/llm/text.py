"""Vectorised words and shingles of Arrow text columns, used inside ``mapInArrow`` tasks.

A word is a maximal run of ASCII digits, ASCII letters (A-Z lower-cased) and non-ASCII
characters, i.e. ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Words are
found on the UTF-8 bytes of a whole batch at once. 64-bit hashes only select candidates
where an operator goes on to compare the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

Batches = Iterator[pa.RecordBatch]

#: Bytes of text handled at once; a longer single text is a chunk of its own.
CHUNK_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    h = (h ^ (h >> np.uint64(32))) * _MUL
    h ^= h >> np.uint64(29)
    h *= _MUL2
    return h ^ (h >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n+1 offsets (a null text is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    if off is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    base = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return base[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


@dataclass
class Words:
    """Words of a chunk of rows: byte ranges into ``low``, 64-bit hashes, and per row the
    range of its words (``first[r]`` .. ``first[r + 1]``)."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def joined(self, lo: int, n: int) -> bytes:
        """Words ``lo`` .. ``lo + n`` joined by one space."""
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.start[lo:lo + n], self.end[lo:lo + n]))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index of the first word) of every run of ``size`` words within a row."""
        n = len(self.hash)
        if n < size:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            acc = self.hash[:n - size + 1].copy()
            for j in range(1, size):
                acc = mix(acc * _MUL + self.hash[j:n - size + 1 + j])
        last = np.repeat(self.first[1:], np.diff(self.first))  # end of each word's row
        at = np.flatnonzero(np.arange(size, n + 1) <= last[:n - size + 1])
        return acc[at], at


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that ``offsets`` cuts out of ``data``."""
    low = _LOWER[data[offsets[0]:offsets[-1]]]
    off = offsets - offsets[0]
    n = len(low)
    if n == 0:
        e = np.zeros(0, np.int64)
        return Words(low, e, e, np.zeros(0, np.uint64), np.zeros(len(off), np.int64))
    is_word = _IS_WORD[low]
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True  # a word never runs over the end of a text
    before = np.empty(n + 1, dtype=bool)
    before[0] = False
    before[1:] = is_word
    here = np.empty(n + 1, dtype=bool)
    here[:n] = is_word
    here[n] = False
    start = np.flatnonzero(here & (~before | cut))
    end = np.flatnonzero(before & (~here | cut))
    return Words(low, start, end, _hash(low, start, end), np.searchsorted(start, off))


def _hash(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes a step over the ranges still open."""
    size = end - start
    with np.errstate(over="ignore"):
        h = size.astype(np.uint64) * _MUL2
        padded = np.zeros(len(low) + 8, np.uint8)
        padded[:len(low)] = low
        word8 = np.ndarray((len(low) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
        open_ = np.arange(len(start))
        k = 0
        while len(open_):
            if k >= 64 and len(open_) < 64:  # a few very long words: in one go
                for i in open_:
                    tail = low[start[i] + k:end[i]]
                    full = np.zeros(-(-len(tail) // 8) * 8, np.uint8)
                    full[:len(tail)] = tail
                    v = int(h[i])
                    for x in full.view("<u8").tolist():
                        v = ((v ^ x) * int(_MUL) + (v >> 29)) & 0xFFFFFFFFFFFFFFFF
                    h[i] = v
                break
            rest = size[open_] - k
            value = word8[start[open_] + k] & _MASKS[np.minimum(rest, 8)]
            g = h[open_]
            h[open_] = (g ^ value) * _MUL + (g >> np.uint64(29))
            open_ = open_[rest > 8]
            k += 8
        return mix(h)


def releasing(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, giving Arrow's unused memory back when its task ends. A
    Python worker lives on between tasks, and what it still held would lie idle beside the
    executor's next stages, whatever they run."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return task


def batch_words(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of a text column, in chunks of bounded bytes."""
    data, offsets = utf8(column)
    for lo, hi in chunks(offsets):
        yield lo, hi, words(data, offsets[lo:hi + 1])
