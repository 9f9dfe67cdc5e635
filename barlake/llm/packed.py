"""Arrays of numbers as compressed bytes, to travel in binary columns."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(a: np.ndarray) -> bytes:
    """Compressed bytes of an array, byte planes apart."""
    raw = np.ascontiguousarray(a)
    planes = raw.view(np.uint8).reshape(len(raw), raw.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as packed differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def runs(keys: np.ndarray, bits: int):
    """(bucket, from, to) of sorted keys by their leading bits."""
    bucket = keys >> np.uint64(64 - bits) if bits else np.zeros(len(keys), dtype=np.uint64)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(keys) else np.zeros(1, dtype=int)
    return [(int(bucket[lo]), int(lo), int(hi)) for lo, hi in zip(cuts[:-1], cuts[1:])]
