"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z: ASCII
letters and digits and every character beyond ASCII. In UTF-8 that is a test on
single bytes, so no text is decoded.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240131)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in one array, and where each text begins (one more entry for the end). Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """The words of an array of texts.

    ``start`` and ``end`` are byte positions in ``data``; the words of text i are those
    from ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, texts: pa.Array):
        raw, self.bounds = utf8(texts)
        self.data = _LOWER[raw]
        n = len(self.data)
        inside = np.zeros(n + 1, dtype=bool)
        inside[:n] = _IS_WORD[self.data]
        begins = inside[:n].copy()
        begins[1:] &= ~inside[: n - 1]
        edges = self.bounds[:-1][self.bounds[:-1] < n]
        begins[edges] = inside[edges]
        ends = inside[:n].copy()
        ends &= ~inside[1:]
        inner = self.bounds[1:][self.bounds[1:] > 0] - 1
        ends[inner] = inside[inner]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.bounds)

    @cached_property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.count)), self.count)

    @cached_property
    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def phrase(self, i: int, n: int) -> bytes:
        """Words i to i + n - 1, joined by single spaces."""
        return b" ".join(self.word(k) for k in range(i, i + n))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every n consecutive words, and where each text's begin.

        A text of fewer words than n, but not none, has one shingle of all its words.
        """
        per_text = np.where(self.count >= n, self.count - n + 1, np.minimum(self.count, 1))
        first = np.concatenate([[0], np.cumsum(per_text)])
        out = np.empty(first[-1], dtype=np.uint64)
        total = len(self.hashes)
        factors = powers(0xD6E8FEB86659FD93, n + 1)[1:]
        if total >= n:
            sums = self.hashes[: total - n + 1] * factors[0]
            for k in range(1, n):
                sums += self.hashes[k : total - n + 1 + k] * factors[k]
            owner = self.text_of[: total - n + 1]
            whole = np.flatnonzero(owner == self.text_of[n - 1 :])
            owner = owner[whole]
            out[whole - self.first[owner] + first[owner]] = sums[whole]
        for i in np.flatnonzero((self.count > 0) & (self.count < n)):
            own = self.hashes[self.first[i] : self.first[i + 1]]
            out[first[i]] = np.sum(own * factors[: len(own)], dtype=np.uint64) + np.uint64(len(own))
        return mixed(out), first


class Spans:
    """64-bit hashes of spans of some bytes: differences of one running sum, so any number of spans may overlap."""

    def __init__(self, data: np.ndarray):
        self.running = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data] * powers(_BASE, len(data)), out=self.running[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = (self.running[end] - self.running[start]) * powers(_INVERSE, len(self.running))[start]
        return mixed(sums + (end - start).astype(np.uint64))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Spans(data).hashes(start, end)
