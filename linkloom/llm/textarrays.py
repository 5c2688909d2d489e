"""Vectorised words and shingles of Arrow text columns (numpy, no loop over characters)."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))

#: Bytes A-Z become a-z, all others stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The bytes x20 and x09-x0D part words.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, after whose end a worker hands the memory that it no longer needs back to the system, as workers live on.

    What a task leaves in cycles (its function and the variables that came with it) goes too: few objects, but maybe large ones.
    """

    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return task


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if len(_powers[0]) < n:
        for i, b in enumerate((_BASE, _BACK)):
            x = np.full(max(n, 2 * len(_powers[0])), b, np.uint64)
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=np.uint64)
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """c with span(c, i, j) a 64-bit hash of data[i:j]."""
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[0][: len(data)], out=c[1:])
    return c


def span(c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return mix((c[j] - c[i]) * powers(len(c))[1][i])


def as_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All text as UTF-8 bytes, and the offset at which each row begins, and the end; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()) if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_large_binary(col.type) else "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and len(off) else np.zeros(0, np.uint8)
    return data, (off - off[0] if len(off) else np.zeros(1, np.int64))


def slices(col: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about that many bytes: the first row's number, bytes, offsets."""
    data, off = as_bytes(col)
    a = 0
    while a < len(off) - 1:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def word_hashes(data: np.ndarray, off: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-cased words, parted by the bytes of blank: hashes, byte starts and ends, and for each row where its words begin (and the end)."""
    low = LOWER[data]
    word = ~blank[low]
    first, last = word.copy(), word.copy()
    if len(low):
        cut = np.zeros(len(low) + 1, bool)
        cut[off] = True
        first[1:] &= ~word[:-1] | cut[1:-1]
        last[:-1] &= ~word[1:] | cut[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span(prefix_hash(low), start, end), start, end, np.searchsorted(start, off)


def shingle_rows(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row its set of k-word shingles as sorted 64-bit hashes; fewer words: the whole sequence as one."""
    words, _, _, at = word_hashes(data, off)
    place = _places(k)
    n = max(0, len(words) - k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j : j + n] * place[j]
    total = mix(total)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= k:
            s = np.sort(total[a : b - k + 1])
            yield s[np.append(True, s[1:] != s[:-1])]
        elif b > a:
            yield mix((words[a:b] * place[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _places(k: int) -> np.ndarray:
    return np.random.default_rng(k).integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
