"""Vectorised kernels over Arrow string buffers.

Words are maximal runs of bytes other than space and the five ASCII controls
\\t..\\r, the class ``[^\\x20\\x09-\\x0D]+``.  Everything here works on a whole
batch of texts at once: one byte buffer, one offset array, no Python object per
word.

A word's hash is a sum over its blocks of eight bytes, each mixed with a key
of its place that depends on a seed; a window's hash is mixed from those of
two windows that cover it.  Callers that remove or join text draw the seed
anew for every run, so equal hashes of unequal texts can't be prepared.
Polynomial prefix hashes serve only to number features.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd factors (any odd numbers would do).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
#: Bytes of text handled at once; a longer single text is handled alone.
SLICE_BYTES = 2 << 20


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalise 64-bit values so that every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        z = x + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, cached by power-of-two length."""
    return _powers(base, 1 << max(12, int(max(n, 1) - 1).bit_length()))[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base**i, with a leading 0."""
    out = np.zeros(len(values) + 1, dtype=U64)
    with np.errstate(over="ignore"):
        np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def span_hash(pre: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Position-independent hashes of the spans [starts, ends) of a prefix array."""
    with np.errstate(over="ignore"):
        return (pre[ends] - pre[starts]) * powers(inverse(base), len(pre))[starts]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and int64 offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=n + 1 + column.offset)[column.offset :] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and n else np.zeros(0, np.uint8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    return raw[lo:hi], offsets - lo


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Consecutive row ranges of at most ``limit`` bytes each (or of one row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte unchanged."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per text the index of its first word (n+1 values)."""
    n = len(data)
    solid = np.ones(n + 2, dtype=bool)
    solid[0] = solid[-1] = False
    body = solid[1:-1]
    body &= data != 32
    body &= (data < 9) | (data > 13)
    first = body & ~solid[:-2]
    last = body & ~solid[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = body[cuts]
    last[cuts - 1] = body[cuts - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def run_hashes(values: np.ndarray, first: np.ndarray, seed: int = 0) -> np.ndarray:
    """One hash per run of 64-bit values; ``first`` has the starts of the runs, none empty."""
    if not len(first):
        return np.zeros(0, dtype=U64)
    size = np.diff(first, append=len(values))
    place = np.arange(len(values)) - np.repeat(first, size)
    keys = mix64(np.arange(int(size.max()), dtype=U64), seed)
    with np.errstate(over="ignore"):
        return mix64(np.add.reduceat(mix64(values + keys[place]), first) + size.astype(U64), 5)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """One 64-bit hash per word."""
    size = ends - starts
    blocks = (size + 7) >> 3
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))  # the block from each byte on
    beyond = np.maximum(8 - (np.repeat(size, blocks) - 8 * place), 0).astype(U64)
    block = eight[np.repeat(starts, blocks) + 8 * place] & (U64(2**64 - 1) >> (beyond * U64(8)))
    return mix64(run_hashes(block, first, seed) ^ mix64(size.astype(U64), seed))


def wider(hashes: np.ndarray, length: int, longer: int) -> np.ndarray:
    """Hashes of all windows of ``longer`` words (at most twice ``length``) from those of ``length``."""
    n = len(hashes) + length - longer
    if n <= 0:
        return np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        return mix64(hashes[:n] * U64(WORD_BASE) + hashes[longer - length :], longer)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, over text ends too: the caller masks those."""
    if length == 1:
        return words
    half = (length + 1) // 2
    return wider(window_hashes(words, half), half, length)


def owners(first: np.ndarray) -> np.ndarray:
    """For each word the number of its text, given the n+1 first-word indexes."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (leftmost of equals) in each run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out, piece, low = np.empty(n, dtype=np.int64), 1 << 21, U64((1 << 22) - 1)
    for s in range(0, n, piece):
        part = values[s : min(s + piece, n) + width - 1]
        m, have = (part & ~low) | np.arange(len(part), dtype=U64), 1
        while have * 2 <= width:
            m, have = np.minimum(m[: len(m) - have], m[have:]), have * 2
        if have < width:
            step = width - have
            m = np.minimum(m[: len(m) - step], m[step:])
        out[s : s + len(m)] = (m & low).astype(np.int64) + s
    return out
