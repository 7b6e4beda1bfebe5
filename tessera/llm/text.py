"""Vectorised work on the UTF-8 bytes of a whole Arrow batch of texts; used inside tasks only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte, and the same with A-Z given the values of a-z.
BYTE_VALUE = _RNG.integers(1, 2**64 - 1, 256, dtype=np.uint64)
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes uint8, offsets int64 of length n + 1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pa.array(column).cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    n = len(column)
    if n == 0 or at is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.cumprod(out, out=out)
    return out


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes other than space and \\x09-\\x0D) and the text of each."""
    word = ~SPACE[data]
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[off] = True  # no word crosses a text's bounds
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], before[1:] = False, word[:-1]
        after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | first[:n]))
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, by differences of one prefix sum over all the bytes."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((BYTE_VALUE_LOWER if lower else BYTE_VALUE)[data] * powers(n, _BASE), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(n + 1, _BASE_INVERSE)[starts])


def per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of values (one for each byte) over each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    if not len(keys):
        return np.zeros(0, bool)
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys
