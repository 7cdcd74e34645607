"""Vectorised words and word-window hashes over Arrow string columns.

Words are runs of bytes other than space and 0x09-0x0D; that is the same as the
character class [^\\x20\\x09-\\x0D]+ on the decoded text.  Hashes are 64-bit: a
polynomial in an odd base over random byte (or word) values, taken as differences
of prefix sums, then mixed.  They depend on the words alone, so they agree between
batches, tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
U = np.uint64
_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F     # odd bases
_MASK = (1 << 64) - 1

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalising mix of 64-bit values."""
    h = h ^ U(salt & _MASK)
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def _byte_values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93), seed)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            both.append(np.cumprod(p))
        known = (both[0], both[1])
        if n <= 2 * CHUNK_BYTES:
            _POWERS[base] = known
    return known


@dataclass
class Words:
    """Words of the documents of one chunk.

    rows: index of the chunk's first document in the batch and the number of
    documents; first: index of each document's first word (one more entry at the
    end); start, end: byte positions in data; hash: one value a word.
    """

    lo: int
    n_docs: int
    data: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts())

    def windows(self, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(word index, hash) of each window of `size` words inside one document."""
        m = len(self.hash)
        if m < size:
            return np.zeros(0, np.int64), np.zeros(0, U)
        power, inverse = _powers(_Q, m)
        sums = np.zeros(m + 1, U)
        np.cumsum(mix(self.hash, salt) * power[:m], out=sums[1:])
        at = np.arange(m - size + 1)
        last = np.repeat(self.first[1:], self.counts())[: len(at)]
        at = at[at + size <= last]
        return at, mix((sums[at + size] - sums[at]) * inverse[at], size)

    def whole(self, doc: int) -> np.ndarray:
        """Hash of the whole word sequence of one document, as an array of one."""
        a, b = self.first[doc], self.first[doc + 1]
        power, _ = _powers(_Q, b - a)
        return mix(np.sum(mix(self.hash[a:b]) * power[: b - a], dtype=U, keepdims=True), int(b - a))


def chunks(column: pa.Array, lower: bool = False, seed: int = 1, breaks: np.ndarray = _SPACE) -> Iterator[Words]:
    """Words of a string column without nulls, in chunks of about CHUNK_BYTES.

    A document is never divided; one longer than a chunk is a chunk by itself.
    `breaks` marks the byte values that separate words (white space by default).
    """
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, off_buf, data_buf = column.buffers()
    offs = np.frombuffer(off_buf, np.int64, n + 1, column.offset * 8)
    whole = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    values = _byte_values(seed)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + CHUNK_BYTES, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        data = whole[offs[lo]: offs[hi]]
        yield _words(lo, hi - lo, _LOWER[data] if lower else data, offs[lo: hi + 1] - offs[lo], values, breaks)
        lo = hi


def _words(lo: int, n_docs: int, data: np.ndarray, offs: np.ndarray, values: np.ndarray,
           breaks: np.ndarray = _SPACE) -> Words:
    n = len(data)
    inside = ~breaks[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[offs[:-1][offs[:-1] < n]] = False
        after[offs[1:][offs[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    power, inverse = _powers(_P, n)
    sums = np.zeros(n + 1, U)
    np.cumsum(values[data] * power[:n], out=sums[1:])
    h = mix((sums[end] - sums[start]) * inverse[start])
    return Words(lo, n_docs, data, np.searchsorted(start, offs), start, end, h)
