"""Words of a batch of texts as numpy arrays.

A word is a maximal run of ``[^\\x20\\x09-\\x0D]``.  The six separators are
single bytes in UTF-8 and never part of another character, so words are found
on the bytes of an Arrow string column without decoding it.  Word and span
hashes are 64-bit polynomial hashes (random byte table, prefix sums modulo
2**64, then a finaliser), the same in every task.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are worked on in runs of rows of about this many bytes; a longer text is a run of its own.
CHUNK_BYTES = 1 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTES_FOLDED = _BYTES.copy()
_BYTES_FOLDED[65:91] = _BYTES[97:123]
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), U64(base))
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 2 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class SpanHash:
    """Hashes of any spans of a sequence, from prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(_BASE, n), out=self.sums[1:])
        self.inverse = powers(pow(_BASE, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string array (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each."""
    _, offsets = text_bytes(texts)
    lo, n = 0, len(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Words:
    """Words of a run of texts: byte spans ``start``/``end`` into ``data``;
    row ``r`` has the words ``rows[r]:rows[r + 1]``."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = text_bytes(texts)
        data, offsets = self.data, self.offsets
        word = ~SEPARATOR[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        full = np.flatnonzero(np.diff(offsets))
        heads, tails = offsets[full], offsets[full + 1] - 1
        first[heads] = word[heads]
        last[tails] = word[tails]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.start, offsets)

    def hashes(self, fold: bool = False) -> np.ndarray:
        """One hash per word; ``fold`` takes A-Z as a-z."""
        table = _BYTES_FOLDED if fold else _BYTES
        return SpanHash(table[self.data]).of(self.start, self.end)


def strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())
