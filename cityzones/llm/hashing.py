"""Vectorised hashing of words and shingles over batches of texts (runs inside tasks)."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)          # a random number per byte value
_BASE = _U(0x9E3779B97F4A7C15)                                  # odd, so it has an inverse modulo 2**64
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SLOT = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing steps of the splitmix generator)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _BASE), np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """s with s[i] the polynomial of the first i bytes: the hash of bytes i..j is (s[j] - s[i]) times inverse**i."""
    s = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * powers(len(buf))[0], out=s[1:])
    return s


class Words:
    """The words of a batch of texts: ``hashes`` of all words, ``first[d]:first[d + 1]`` are those of text d.

    Letters A-Z are lower-cased; words are runs of anything but ASCII white space."""

    def __init__(self, raws: list[bytes]):
        joined = b" ".join(raws).lower()
        buf = np.frombuffer(joined, np.uint8)
        ends = np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws)))
        inner = np.concatenate([[False], ~_SPACE[buf], [False]])
        edge = np.flatnonzero(inner[1:] != inner[:-1])
        start, stop = edge[::2], edge[1::2]
        s = prefix_sums(buf)
        inverse = powers(len(buf) + 1)[1]
        self.hashes = mix((s[stop] - s[start]) * inverse[start] + (stop - start).astype(np.uint64))
        self.first = np.concatenate([[0], np.searchsorted(start, ends)])


def shingles(raws: list[bytes], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the k-word shingles of each text, with repeats; ``first`` has len(raws) + 1 offsets.

    A text of fewer than k words has one shingle, its whole sequence; one without words has none."""
    w = Words(raws)
    n = np.diff(w.first)
    made = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(made)])
    if first[-1] == 0:
        return np.zeros(0, np.uint64), first
    at = np.arange(first[-1]) - np.repeat(first[:-1] - w.first[:-1], made)
    length = np.repeat(np.minimum(n, k), made)
    h = np.zeros(first[-1], np.uint64)
    padded = np.concatenate([w.hashes, np.zeros(k, np.uint64)])
    for j in range(k):
        h += np.where(j < length, padded[at + j], _U(j + 1)) * _SLOT[j]
    return mix(h), first


def distinct(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    out = []
    for a, b in zip(first[:-1], first[1:]):
        x = np.sort(hashes[a:b])
        out.append(x[np.concatenate([x[:1] == x[:1], x[1:] != x[:-1]])])
    return out


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it


def release() -> None:
    """Hand freed memory back to the system: a worker is used again, and keeps the peak of its last group otherwise."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)
