"""Words of many texts at once, as arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of word bytes inside one text; its hash is a 64-bit polynomial of its
bytes, taken from running sums, and then mixed.  Hashes do not depend on the process, the batch or
the place of a text in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_RADIX = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK_BYTES = 1 << 19

#: Bytes of words: all but white space (0x20, 0x09-0x0D), or ASCII letters and digits and all beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


class Words(NamedTuple):
    """Words of the texts ``first`` to ``first + len(bounds) - 2`` of a batch.

    ``bounds[i]:bounds[i + 1]`` are the words of the i-th text; ``start``/``end`` are byte places
    in ``data`` (the lower-cased bytes) and ``hash`` the words' hashes.
    """
    first: int
    bounds: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (one more than texts) and bytes of a string column; nulls are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_string(column.type):
        if column.null_count:
            column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return at.astype(np.int64), np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def words(column: pa.Array, word_bytes: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a string column, a chunk of whole texts at a time (A-Z lower-cased)."""
    offsets, data = texts_of(column)
    n, i = len(column), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk_bytes, "right")) - 1)
        lo, hi = offsets[i], offsets[j]
        low = _LOWER[data[lo:hi]]
        edge = offsets[i:j + 1] - lo
        inside = np.empty(len(low) + 1, bool)
        inside[:-1] = word_bytes[low]
        inside[-1] = False
        before = np.empty(len(low) + 1, bool)
        before[0] = False
        before[1:] = inside[:-1]
        cut = edge[1:-1]
        first_here = inside & ~before
        last_here = before & ~inside
        first_here[cut] = inside[cut]           # a text's first byte starts a word, whatever stands before
        last_here[cut] = before[cut]
        start, end = np.flatnonzero(first_here), np.flatnonzero(last_here)
        total = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _power("up", _RADIX, len(low) + 1)[:-1], out=total[1:])
        h = mix((total[end] - total[start]) * _power("down", _INVERSE, len(low) + 1)[start])
        yield Words(i, np.searchsorted(start, edge), h, start, end, low)
        i = j


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive words (runs over text ends included)."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    total = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += h[k:len(h) - width + 1 + k]
    return mix(total)
