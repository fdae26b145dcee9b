"""Numbers packed into bytes, for shuffles that move few rows with many sorted numbers each."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising 64-bit numbers as their differences, a byte place at a time, so that the empty high places cost nothing."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = steps.view(np.uint8).reshape(-1, 8).T
    used = 8 - int(np.argmax(planes.any(axis=1)[::-1])) if planes.size and planes.any() else 0
    return bytes([used]) + planes[:used].tobytes()


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    planes[: data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def squeeze(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values).tobytes(), 1)


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype)


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows of equal keys in a partition sorted by them; a run may span batches. Only the rows of the run at hand
    become Python objects; the others stay where Arrow has them."""
    key, parts = None, []
    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        first = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[first]:
                if parts and names[first] != key:
                    yield key, [row for part in parts for row in part.to_pylist()]
                    parts = []
                key = names[first]
                parts.append(batch.slice(first, i - first))
                first = i
    if parts:
        yield key, [row for part in parts for row in part.to_pylist()]


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a partition's batches. At its end freed memory goes back to the system, as idle workers keep what they have."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return tidied
