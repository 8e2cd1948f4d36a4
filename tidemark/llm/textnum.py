"""Vectorised word and shingle hashing over Arrow string buffers.

A batch of texts is one byte buffer plus offsets; words, word hashes and k-gram hashes are numpy
arrays over all words of the batch, so no Python code runs per word. Null texts count as empty.
Hashes are 64-bit and depend on the bytes alone: equal on every executor, run and input path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes that separate words: space and 0x09-0x0D. All bytes above 0x7F belong to words.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_SEP = np.zeros(256, dtype=bool)
_SEP[list(SEPARATORS)] = True
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_M3, _ROLL = np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of length n + 1) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch in text order. ``first[d]:first[d + 1]`` are those of document d."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    padded: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.first)

    def lead(self) -> np.ndarray:
        """Eight bytes from each word's start on, little-endian (bytes past its end included)."""
        return self._at(self.start)

    def _at(self, where: np.ndarray) -> np.ndarray:
        view = np.ndarray((len(self.padded) - 7,), dtype="<u8", buffer=self.padded, strides=(1,))
        return view[where]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, eight bytes a step; the longest words come last."""
        size = self.end - self.start
        h = size.astype(np.uint64) * _M1
        todo, at = np.arange(len(size)), 0
        while len(todo):
            left = size[todo] - at
            part = self._at(self.start[todo] + at) & _LOW[np.minimum(left, 8)]
            h[todo] = mix((h[todo] ^ part) * _M1 + _M3)
            todo, at = todo[left > 8], at + 8
        return h


def words(column: pa.Array | pa.ChunkedArray, separators: np.ndarray = _SEP, fold: bool = False) -> Words:
    """Words (maximal runs without separator bytes, by default SEPARATORS) of every text of a batch.

    ``fold``: in lower case, for ASCII and Latin-1 letters.
    """
    data, offsets = utf8(column)
    if fold and len(data):
        upper = (data >= 0x41) & (data <= 0x5A)
        upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data = data + upper.view(np.uint8) * np.uint8(0x20)
    inside = ~separators[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(data), dtype=bool)
    if len(data):
        after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, doc, first, np.concatenate([data, np.zeros(8, np.uint8)]))


def grams(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the k words from each word on, whether they lie in one document)."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _ROLL + h[j : j + n]
    return mix(out), doc[:n] == doc[k - 1 : k - 1 + n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out, have = np.minimum(out[: len(out) - step], out[step:]), have + step
    return out
