"""Words of whole Arrow text columns as numpy arrays, a block of texts at a time.

A word is a run of bytes that are not ASCII white space (in UTF-8 that is the same as a run
of characters outside [\\x20\\x09-\\x0D]). Blocks hold whole texts and about ``BLOCK_BYTES``
bytes; a longer text is hashed in slices cut at white space, so memory follows the
longest word and the number of words, not eight times the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Letters, digits and all bytes of non-ASCII characters: words without punctuation.
ALNUM_BYTE = np.array([chr(b).isalnum() or b >= 128 for b in range(128)] + [True] * 128)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


with np.errstate(over="ignore"):
    _BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept per process in sizes that are powers of two."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


@dataclass
class Block:
    """Words of some texts. Word i is data[start[i]:end[i]]; text k has words first[k]:first[k + 1]."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def room(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))

    def hashes(self, translate: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes, after a bytewise translation."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        parts, i, n = [], 0, len(self.start)
        while i < n:
            base = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, base + BLOCK_BYTES, "right")))
            stop = int(self.end[j - 1])
            raw = self.data[base:stop]
            raw = raw if translate is None else translate[raw]
            begin, length = (self.start[i:j] - base), (self.end[i:j] - self.start[i:j])
            sums = np.concatenate(([_U(0)], np.cumsum(_BYTE_VALUE[raw] * powers(_BASE, stop - base), dtype=np.uint64)))
            h = (sums[begin + length] - sums[begin]) * powers(_INVERSE, stop - base)[begin]
            parts.append(mix(h + length.astype(np.uint64) * _U(0xD1342543DE82EF95)))
            i = j
        return np.concatenate(parts)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array, word_byte: np.ndarray = WORD_BYTE, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of whole texts, in order, that cover all rows of a text column."""
    if not len(column):
        return
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        upto = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        upto = min(upto, rows)
        yield block(data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row], slice(row, upto), word_byte)
        row = upto


def block(data: np.ndarray, offsets: np.ndarray, rows: slice, word_byte: np.ndarray = WORD_BYTE) -> Block:
    """The words of texts that lie one after the other in ``data``."""
    word = word_byte[data]
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = word[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after = np.zeros(len(data), bool)
    if len(data):
        after[:-1] = word[1:]
    after[edges - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return Block(rows, data, offsets, start, end, np.searchsorted(start, offsets))


def gram_hashes(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """A 64-bit hash of each run of n words, by its first word; shorter by n - 1 (none, if too short)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if n <= 8:
        out = words[:count].copy()
        for k in range(1, n):
            out *= _U(base)
            out += words[k : k + count]
        return mix(out)
    sums = np.concatenate(([_U(0)], np.cumsum(words * powers(base, len(words)), dtype=np.uint64)))
    return mix((sums[n:] - sums[:-n]) * powers(pow(base, -1, 1 << 64), len(words))[:count])
