"""Words of many texts at once, as offsets into their bytes, with hashes of words and windows.

Everything here works on one Arrow array of texts inside a task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

#: Bytes that end a word: ASCII white space, or every ASCII byte but letters and digits.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:0x80] = [not chr(b).isalnum() for b in range(0x80)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_WORD_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, from prefix sums modulo 2**64."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(base, n), out=sums[1:])
    undo = _powers(pow(base, -1, 1 << 64), n + 1)
    return (sums[ends] - sums[starts]) * undo[starts]


@dataclass
class Words:
    """Words ``data[starts[i]:ends[i]]``; those of text ``d`` are ``first[d]`` to ``first[d + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    _hashes: dict = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        if which not in self._hashes:
            rolled = _rolling(
                self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends, _BASES[which]
            )
            self._hashes[which] = mix(rolled + (self.ends - self.starts).astype(np.uint64))
        return self._hashes[which]

    def windows(self, starts: np.ndarray, size: int | np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of the windows of ``size`` words from each given word on."""
        values = self.hashes(which)
        return mix(_rolling(values, starts, starts + size, _WORD_BASES[which]))

    def window_starts(self, size: int) -> np.ndarray:
        """Words from which ``size`` words of the same text follow."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        return np.flatnonzero(left >= size)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each one starts; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, ends_word: np.ndarray = WHITE, lower: bool = False) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~ends_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    before[offsets] = False
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))
