"""Hashed word shingles and MinHash signatures of batches of texts, as array operations over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
_RNG = np.random.default_rng(20240229)
#: A random number for each byte, the same for a-z and A-Z, and powers of an odd number: a word's hash is sum(T[byte] * R**i).
_BYTES = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_R = 0x9E3779B97F4A7C15
_INVERSE = pow(_R, -1, 1 << 64)
_SPAN = 1 << 20  # bytes worked on at once


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        out[done : 2 * done] = out[: min(done, n - done)] * _U(pow(base, done, 1 << 64))
        done *= 2
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Words:
    """Word hashes of texts. Keeps its tables between calls."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of each word of one text's bytes."""
        n = len(data)
        if n + 1 > len(self.up):
            size = max(_SPAN, 1 << int(n + 1).bit_length())
            self.up, self.down = _powers(_R, size), _powers(_INVERSE, size)
        word = np.zeros(n + 2, np.int8)
        word[1:-1] = ~_SPACE[data]
        edge = np.diff(word)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * self.up[:n], out=total[1:])
        return start, _mixed((total[end] - total[start]) * self.down[start] + (end - start).astype(np.uint64) * _U(0x632BE59BD9B4E019))


def sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text; of one with fewer words, its whole sequence as one; none without words or text."""
    tables = Words()
    column = column.cast(pa.large_binary())
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)

    def folded(at: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        m = len(h) - n + 1
        x = np.full(m, n, np.uint64)
        for i in range(n):
            x = _mixed(x * _U(_R) + h[i : i + m])
        return x

    i = 0
    while i < len(column):
        j = i + 1  # short texts go together; a long one alone
        while j < len(column) and starts[j + 1] - starts[i] <= _SPAN:
            j += 1
        # A space between texts, so that no word goes over.
        lengths = np.where(valid[i:j], starts[i + 1 : j + 1] - starts[i:j], 0)
        at = np.concatenate([[0], np.cumsum(lengths + 1)])
        joined = np.full(at[-1], 32, np.uint8)
        for q in range(j - i):
            joined[at[q] : at[q] + lengths[q]] = data[starts[i + q] : starts[i + q] + lengths[q]]
        start, h = tables.hashes(joined)
        first = np.searchsorted(start, at)
        x = folded(start, h, k) if len(h) >= k else np.zeros(0, np.uint64)
        for q in range(j - i):
            a, b = first[q], first[q + 1]
            if b - a >= k:
                yield np.unique(x[a : b - k + 1])
            elif b > a:
                yield folded(start, h[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)
        i = j


class MinHash:
    """n minimum hashes of a set, of 32 bits."""

    def __init__(self, n: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 2**32, n, dtype=np.uint32)

    def signature(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(self.a), 2**32 - 1, np.uint32)
        low, high = x.astype(np.uint32), (x >> _U(32)).astype(np.uint32)
        for i in range(0, len(x), 1024):
            # Two halves of the hash, so that no two functions order a set alike.
            np.minimum(out, ((low[i : i + 1024, None] ^ self.b) * self.a + high[i : i + 1024, None]).min(axis=0), out=out)
        return out


def digest(x: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(x.tobytes())
