"""Tokenise each distinct piece of text once.

A text is cut where no token of the public pre-tokenizers can reach across:
before white space and between letters and other signs (see ``cuts``).  So a
text's ids are its pieces' ids one after another.  Pieces are
dictionary-encoded as Arrow binaries; only distinct ones reach Python, and a
bounded cache keeps their ids for later batches of the same worker.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from . import _kernels as K

#: Distinct pieces that a worker remembers; beyond, it starts anew.
CACHE_PIECES = 400_000


def _after_unicode_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position is white space outside ASCII."""
    a, b, c = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    two = (at >= 2) & (b == 0xC2) & ((a == 0x85) | (a == 0xA0))
    e280 = (c == 0xE2) & (b == 0x80) & ((a <= 0x8A) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF))
    rest = ((c == 0xE1) & (b == 0x9A) & (a == 0x80)) | ((c == 0xE2) & (b == 0x81) & (a == 0x9F)) | ((c == 0xE3) & (b == 0x80) & (a == 0x80))
    return two | ((at >= 3) & (e280 | rest))


def cuts(data: np.ndarray, offsets: np.ndarray, keep_spaces: bool = True) -> np.ndarray:
    """Starts of all pieces of non-empty texts, ascending, and the end of the buffer.

    Cuts stand before a run of ASCII white space and between a letter (ASCII,
    or of the Latin blocks up to U+027F) and another ASCII sign, but not behind
    an apostrophe, which may begin a contraction, nor beside U+0130, whose
    lower case ends with a mark that is no letter.  With ``keep_spaces`` a piece
    keeps the white space before it, so that a token may begin with a space;
    only a lone sign of white space that is no space is a piece itself.
    Without, runs of white space are pieces of their own.  In a buffer that may
    hold special tokens, words are not cut.
    """
    n = len(data)
    if not n:
        return np.zeros(1, dtype=np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    cut = np.zeros(n + 1, dtype=bool)
    before, here = space[:-1], space[1:]
    at = np.flatnonzero(here & ~before) + 1
    cut[at[~_after_unicode_space(data, at)]] = True
    if keep_spaces:
        solid = ~here[1:] & (data[2:] != 0xC2) & ((data[2:] < 0xE1) | (data[2:] > 0xE3))  # no white space outside ASCII either
        cut[2:n] |= solid & before[1:] & cut[1 : n - 1] & (data[1:-1] != 32)
    else:
        cut[1:n] |= before & ~here
    if not _may_hold_special(data):
        letter = (data | 32) - np.uint8(97) < 26
        lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))
        after = data[lead + 1]
        lead = lead[~((data[lead] == 0xC3) & ((after == 0x97) | (after == 0xB7))) & ~((data[lead] == 0xC4) & (after == 0xB0))]
        letter[lead] = letter[lead + 1] = True
        other = (data < 128) & ~letter & ~space
        cut[1:n] |= (letter[1:] & other[:-1] & (data[:-1] != 39)) | (other[1:] & letter[:-1])
    cut[offsets] = True
    return np.flatnonzero(cut)


def _may_hold_special(data: np.ndarray) -> bool:
    """Whether "<|" stands somewhere; special tokens of public vocabularies begin so."""
    at = np.flatnonzero(data[:-1] == 60)
    return bool((data[at + 1] == 124).any())


class PieceTable:
    """Ids of distinct pieces in one flat array."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], keep_spaces: bool = True, lower: bool = False):
        self.encode, self.keep_spaces, self.lower = encode, keep_spaces, lower
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.zeros(0, dtype=np.uint32)
        self.start = np.zeros(1, dtype=np.int64)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a slice of texts and the n+1 offsets of each text in them."""
        if self.lower and not _may_hold_special(data):
            # not before other than ASCII: composition comes first, and some letters compose in lower case only
            alone = np.append(data[1:] < 128, True)
            data = np.where(alone, K.lower_ascii(data), data)
        edge = cuts(data, offsets, self.keep_spaces)
        pieces = pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.index) + len(distinct) > CACHE_PIECES:
            self.clear()
        index = self.index
        new = [p for p in distinct if p not in index]
        if new:
            flat, sizes = self.encode(new)
            index.update(zip(new, range(len(self.start) - 1, len(self.start) - 1 + len(new)), strict=True))
            self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(sizes)))
            self.flat = np.concatenate((self.flat, flat))
        where = np.fromiter((index[p] for p in distinct), dtype=np.int64, count=len(distinct))
        code = where[coded.indices.to_numpy(zero_copy_only=False)] if len(distinct) else np.zeros(0, np.int64)
        begin, size = self.start[code], self.start[code + 1] - self.start[code]
        ends = np.concatenate(([0], np.cumsum(size)))
        out = self.flat[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        return out, ends[np.searchsorted(edge[:-1], offsets)]


class WholeTexts:
    """Ids of whole texts, for pre-tokenizers of which nothing is known."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As in ``PieceTable``."""
        raw = data.tobytes()
        flat, sizes = self.encode([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        return flat, np.concatenate(([0], np.cumsum(sizes)))


def packed(ids: np.ndarray, offsets: np.ndarray, width: int = 4) -> pa.Array:
    """One binary per text: its ids as little-endian unsigned integers."""
    raw = np.ascontiguousarray(ids.astype(f"<u{width}"))
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * width).astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())


def text_slices(column: pa.Array):
    """(first row, last row, bytes, offsets) of bounded slices of a string column."""
    data, offsets = K.buffers(column)
    for i, j in K.slices(offsets):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
