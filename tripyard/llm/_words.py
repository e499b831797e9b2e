"""Vectorised words, hashes and shingles over Arrow text columns (numpy).

A chunk of texts is one byte buffer. Words are maximal runs of bytes that are
not separators; every separator is ASCII, so UTF-8 bytes can be scanned
directly. A word's 64-bit hash is multilinear: the sum of its bytes' random
codes, each times a random number of its place in the word, taken from one
prefix sum of the words' bytes, so the cost does not depend on word counts.
(Powers of one number in place of the random numbers would give words that
mirror each other in blocks the same hash modulo 2^64, whatever the number.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_CHUNK_BYTES = 1 << 21
_MASK = (1 << 64) - 1
_rng = np.random.default_rng(20240229)
_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_CODES[65:91] = _CODES[97:123]  # A-Z as a-z
_GRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)

#: Bytes that separate words: ASCII white space.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes that separate words: all ASCII but letters and digits.
NON_ALNUM = np.zeros(256, dtype=bool)
NON_ALNUM[:128] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    NON_ALNUM[_a:_b] = False

PLACES = 1 << 12


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser; each salt gives another order of the values."""
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_places = mix(np.arange(PLACES, dtype=np.uint64), 77)


def _place_numbers(at: np.ndarray) -> np.ndarray:
    """The random numbers of places in words."""
    if not len(at) or int(at.max()) < PLACES:
        return _places[at]
    return mix(at.astype(np.uint64), 77)


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows) for runs of rows of about 2 MB;
    a longer text is a chunk of its own. Nulls are empty texts."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + _CHUNK_BYTES, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        lo = offsets[first]
        yield first, data[lo:offsets[end]], offsets[first:end + 1] - lo
        first = end


class Words:
    """The words of a chunk: byte spans, and per row the range of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
        inside = np.zeros(len(data) + 1, dtype=bool)
        np.logical_not(separators[data], out=inside[:-1])
        edge = np.empty(len(data) + 1, dtype=bool)
        edge[0] = inside[0]
        np.not_equal(inside[1:], inside[:-1], out=edge[1:])
        cuts = offsets[1:-1]  # a word also ends where its row ends
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
        at = np.flatnonzero(edge)
        if len(cuts):
            at = np.sort(np.concatenate([at, cuts, cuts]))
        self.data, self.start, self.end, self.inside = data, at[0::2], at[1::2], inside[:-1]
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash a word, A-Z taken as a-z."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        sizes = self.end - self.start
        cut = np.concatenate([[0], np.cumsum(sizes)])
        codes = _CODES[self.data[self.inside]]
        codes *= _place_numbers(np.arange(len(codes)) - np.repeat(cut[:-1], sizes))
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes, out=total[1:])
        return mix(total[cut[1:]] - total[cut[:-1]])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text's word hashes; with fewer
    words the whole sequence is one shingle, without words there is none."""
    if not len(h):
        return h
    if len(h) < k:
        k = len(h)
    total = h[:len(h) - k + 1] * _GRAM[0]
    for j in range(1, k):
        total = total + h[j:len(h) - k + 1 + j] * _GRAM[j % 64]
    return mix(total, k)


def text_rows(batch: pa.RecordBatch, name: str, separators: np.ndarray):
    """(row number, word hashes) of every row of an Arrow batch."""
    for first, data, offsets in chunks(batch.column(batch.schema.get_field_index(name))):
        words = Words(data, offsets, separators)
        h, cut = words.hashes(), words.first
        for i in range(len(offsets) - 1):
            yield first + i, h[cut[i]:cut[i + 1]]
