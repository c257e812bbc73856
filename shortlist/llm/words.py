"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A chunk of texts is one byte buffer with offsets. Words are maximal runs of the bytes that a table
admits, and never cross a text. Their hashes are 64-bit polynomials over prefix sums, finished by a
mixing step, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# bytes of UTF-8 that stand for white space in ASCII
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
# ASCII letters and digits, and every byte of a longer character
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 32

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: np.ndarray = np.ones(1, np.uint64)
_inverse: np.ndarray = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        for base, name in ((_BASE, "_powers"), (pow(_BASE, -1, 1 << 64), "_inverse")):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            globals()[name] = np.multiply.accumulate(table)
    return _powers[:n], _inverse[:n]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows with at most ``limit``
    bytes in all, or of one longer text. A null text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        own = offsets[first : last + 1] - offsets[first]
        yield first, last, raw[offsets[first] : offsets[last]], own
        first = last


def word_spans(raw: np.ndarray, offsets: np.ndarray, admitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each text's words begin (one entry more than texts)."""
    inside = admitted[raw]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = inside
    before[offsets] = False
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hash of each word, with the bytes replaced by ``fold`` first."""
    powers, inverse = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[fold][raw] * powers[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text, and where each text's runs begin. A text
    with fewer words, but not none, has its whole sequence as its only run."""
    n = len(words)
    counts = np.diff(bounds)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    runs = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    edges = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(bounds[:-1], runs) + np.arange(edges[-1]) - np.repeat(edges[:-1], runs)
    length = np.repeat(np.minimum(counts, size), runs)
    out = length.astype(np.uint64)
    for k in range(size):
        step = mix(out ^ words[np.minimum(at + k, n - 1)])
        out = step if counts.min() >= size else np.where(k < length, step, out)
    return out, edges


def range_hashes(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of words from ``first`` to before ``end``, whatever their numbers."""
    powers, inverse = _power_tables(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[:-1], out=sums[1:])
    return mix((sums[end] - sums[first]) * inverse[first] + (end - first).astype(np.uint64))
