"""Byte-level text arithmetic on numpy arrays: words, word hashes and character n-gram hashes.

The functions take the UTF-8 bytes of many texts at once (one array, with the offsets of the texts),
as an Arrow string column holds them; nothing here is done a character at a time in Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base modulo 2^64, and those of its inverse; kept for later calls."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)], dtype=np.uint64) for b in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def blocks(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The texts of a column in runs of about ``most`` bytes: first row, bytes, offsets (one more than texts). Bytes are views of the
    column's own. A text longer than that is a run of its own; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count or not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32 if pa.types.is_string(column.type) else np.int64)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def each(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of a column, empty ones too."""
    for _, raw, offsets in blocks(column):
        for k in range(len(offsets) - 1):
            yield raw[offsets[k] : offsets[k + 1]]


def words(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes (``is_word``: by byte), never across texts, and
    the number of the first word of each text (one more than texts)."""
    inside = is_word[raw]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial of its bytes' random values, scrambled."""
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each ``n`` consecutive values (n-1 fewer than given)."""
    many = max(0, len(hashes) - n + 1)
    out = np.full(many, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + many]
        out ^= out >> np.uint64(29)
    return mix(out)
