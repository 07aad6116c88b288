"""Golomb-Rice coding of sorted 64-bit keys, vectorised with numpy.

The gaps of a sorted list are coded as a unary quotient and ``k`` low bits; the
two parts are kept in separate bit strings, so both directions are a handful of
array operations.
"""

from __future__ import annotations

import struct

import numpy as np


def encode(sorted_keys: np.ndarray) -> bytes:
    """Bytes for a sorted (ties allowed) uint64 array."""
    n = len(sorted_keys)
    if n == 0:
        return struct.pack("<IBQ", 0, 0, 0)
    keys = sorted_keys.astype(np.uint64)
    first = int(keys[0])
    gaps = np.diff(keys)
    if len(gaps) == 0:
        return struct.pack("<IBQ", n, 0, first)
    mean = float(np.mean(gaps.astype(np.float64)))
    k = int(max(0, min(62, np.floor(np.log2(max(mean, 1.0) * 0.69 + 1e-9)))))
    q = (gaps >> np.uint64(k)).astype(np.int64)
    while int(q.sum()) > 16 * n and k < 63:  # far outliers: widen the low part
        k += 1
        q = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(q + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    low = gaps & np.uint64((1 << k) - 1)
    low_bits = np.unpackbits(low.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - k :] if k else np.zeros((len(gaps), 0), np.uint8)
    u = np.packbits(unary).tobytes()
    return struct.pack("<IBQ", n, k, first) + struct.pack("<I", len(u)) + u + np.packbits(low_bits.ravel()).tobytes()


def decode(data: bytes) -> np.ndarray:
    """The uint64 array that :func:`encode` was given."""
    n, k, first = struct.unpack_from("<IBQ", data)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n == 1:
        return np.array([first], np.uint64)
    (size,) = struct.unpack_from("<I", data, 13)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, 17))
    ends = np.flatnonzero(unary)[: n - 1]
    q = np.diff(ends, prepend=-1) - 1
    low = np.zeros(n - 1, np.uint64)
    if k:
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=17 + size))[: (n - 1) * k].reshape(n - 1, k)
        wide = np.zeros((n - 1, 64), np.uint8)
        wide[:, 64 - k :] = bits
        low = np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
    gaps = (q.astype(np.uint64) << np.uint64(k)) | low
    return np.cumsum(np.concatenate([np.array([first], np.uint64), gaps]), dtype=np.uint64)
