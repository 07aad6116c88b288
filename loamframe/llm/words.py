"""Word and shingle hashes of whole Arrow batches, vectorised with numpy.

Words are runs of anything but space and the bytes 0x09-0x0D.  A word's hash adds
up its groups of eight bytes, each mixed with its place, so it is no polynomial:
words that agree in sums of powers stay apart.  Runs of words combine word hashes
and are mixed.  Hashes are 64 bits wide; another ``key`` gives another family, and
two families together make 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks that keep the first 0 to 8 bytes of a little-endian group.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes hashed at once; a longer text is one slice of its own.
SLICE = 1 << 21


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The splitmix64 finaliser; ``salt`` picks another permutation."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def text_slices(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about :data:`SLICE` bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + SLICE, "right")) - 1)
        yield i, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, key: int = 0) -> np.ndarray:
    """Hash of each word of ``data``."""
    own = np.zeros(len(data) + 8, np.uint8)
    own[: len(data)] = _LOWER[data] if lower else data
    eight = np.ndarray(len(data) + 1, "<u8", own, strides=(1,))  # the eight bytes from each byte on
    size = ends - starts
    salt = 16 * key
    with np.errstate(over="ignore"):
        h = mix(eight[starts] & _KEEP[np.minimum(size, 8)], salt)
        longer = np.flatnonzero(size > 8)
        if len(longer):
            more = (size[longer] - 1) // 8
            first = np.cumsum(more) - more
            word = np.repeat(longer, more)
            place = np.arange(len(word)) - np.repeat(first, more) + 1
            at = starts[word] + 8 * place
            rest = eight[at] & _KEEP[np.minimum(ends[word] - at, 8)]
            h[longer] += np.add.reduceat(mix(rest ^ mix(place.astype(np.uint64), salt + 1), salt + 2), first)
        return mix(h ^ mix(size.astype(np.uint64), salt + 3), salt + 4)


def words(data: np.ndarray, offs: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, hash of each word, first word of each row and the end)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offs] = True  # a word ends where its text ends
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, word_hashes(data, starts, ends, lower), np.searchsorted(starts, offs)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each word, as if rows had no borders."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for i in range(1, k):
            out ^= out >> np.uint64(29)
            out *= np.uint64(0xD6E8FEB86659FD93)
            out += h[i : n + i]
    return mix(out)
