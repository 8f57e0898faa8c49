"""Words and word hashes of a batch of texts, computed on whole byte buffers with numpy.

A text is taken as UTF-8 bytes with A-Z lower-cased. A word kind is a table of the bytes that
belong to words, so word limits are exact for any UTF-8 text. Word hashes are 64-bit and depend on
the bytes alone: they are equal in every process and on every run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 2 << 20          # texts are hashed in buffers of about this size; a longer text is a buffer of its own
BASE = 0x9E3779B97F4A7C15 | 5  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)


def _kind(separators: Iterable[int]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: ``[^\x20\x09-\x0D]+``
SPACED = _kind([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing
ALNUM = _kind([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of several texts in reading order; text ``i`` has words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray    # lower-cased bytes of all texts, one space between two
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def text(self, low: int, high: int) -> list[bytes]:
        raw = self.data
        return [raw[s:e].tobytes() for s, e in zip(self.start[low:high], self.end[low:high])]


class Hasher:
    """Splits and hashes texts by one word kind; keeps its tables of powers between calls."""

    def __init__(self, kind: np.ndarray):
        self.kind = kind
        self.power = self.inverse = np.ones(1, dtype=U64)

    def __call__(self, texts: list[bytes]) -> Words:
        data = LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
        n = len(data)
        if len(self.power) <= n:
            self.power, self.inverse = _powers(BASE, n + 1), _powers(INVERSE, n + 1)
        inside = self.kind[data]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        start, end = edge[0::2], edge[1::2]
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum(BYTE_VALUE[data] * self.power[:n], out=total[1:])
        value = mix((total[end] - total[start]) * self.inverse[start] + (end - start).astype(U64))
        offset = np.cumsum([0, *[len(t) + 1 for t in texts]])
        return Words(data, start, end, value, np.searchsorted(start, offset))


def grams(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbouring words; order counts."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    total = np.full(n, k, dtype=U64)
    for i in range(k):
        total += word_hash[i:i + n] * U64(pow(BASE, 2 * i + 3, 1 << 64))
    return mix(total)


def encoded(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8 bytes, null as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Slices of neighbouring texts of about ``limit`` bytes, each with the index of its first text."""
    low = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield low, texts[low:i]
            low, size = i, 0
        size += len(text) + 1
    if low < len(texts):
        yield low, texts[low:]
