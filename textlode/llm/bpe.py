"""Byte-level BPE in batched numpy merge rounds.

The symbols of many words lie in one flat array.  A round looks up every
adjacent pair in the sorted pair keys by binary search, takes each word's
lowest rank, and merges its occurrences in all words at once.  Words without a
pair that can be merged leave the array.

Merging all occurrences of a word's lowest pair at once equals merging them
one by one from the left unless a pair with the new symbol ranks lower still;
for such merges a round takes the leftmost occurrence only.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._columns import packed_rows, with_results
from ..sources.staging import small_batches
from ._units import PieceTable, packed, text_slices

RESULTS = ("n_tokens", "ids", "decoded")
NONE = np.iinfo(np.int64).max
#: White space as Unicode has it; the shorthand of Python's engines also takes \x1c-\x1f.
SPACE = r"\t-\r \x85\xa0  -     　"
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabularies of byte-level BPE."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class ByteBPE:
    """Encoder and decoder of one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or (before.get("type"), before.get("add_prefix_space"), before.get("use_regex")) != ("ByteLevel", False, True):
            raise ValueError(f"{path} is no byte-level BPE file without normalizer and prefix space")
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        self.byte_id = np.array([vocab[x] for x in letters], dtype=np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        left, right = (np.array([vocab[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        key, rank = (left << 32) | right, np.arange(len(pairs), dtype=np.int64)
        _, kept = np.unique(key[::-1], return_index=True)  # of a pair listed twice, the later rank holds
        kept = len(key) - 1 - kept
        order = kept[np.argsort(key[kept])]
        self.keys, self.ranks = key[order], rank[order]
        lowest = np.full(max(vocab.values()) + 1, NONE, dtype=np.int64)
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.made, self.at_once = made, lowest[made] > rank
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("(" + "|".join(regex.escape(k.decode()) for k in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.words = regex.compile(PRETOKEN)
        back = {x: b for b, x in enumerate(letters)}
        size = max([*vocab.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for token, i in vocab.items():
            texts[i] = bytes(back[x] for x in token)
        for token, i in self.special.items():
            texts[i] = token
        self.token_end = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        self.token_bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.table = PieceTable(self.encode_pieces)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of many non-empty words and the number of ids of each."""
        lens = np.array([len(w) for w in words], dtype=np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        wid = np.repeat(np.arange(len(words)), lens)
        done_sym, done_wid = [], []
        while len(sym):
            first = np.flatnonzero(np.diff(wid, prepend=-1))
            key = (sym[:-1] << 32) | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (wid[:-1] == wid[1:]), self.ranks[at], NONE)
            rank = np.append(rank, NONE)
            low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            if (over := low == NONE).any():
                done_sym.append(sym[over])
                done_wid.append(wid[over])
                left = ~over
                sym, wid, rank, low = sym[left], wid[left], rank[left], low[left]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == low)
            new = ~((np.diff(hit, prepend=-2) == 1) & (wid[hit] == np.roll(wid[hit], 1)))
            begin = np.maximum.accumulate(np.where(new, hit, 0))
            hit = hit[(hit - begin) % 2 == 0]
            leftmost = np.diff(wid[hit], prepend=-1) != 0
            hit = hit[self.at_once[rank[hit]] | leftmost]
            sym[hit] = self.made[rank[hit]]
            stay = np.ones(len(sym), dtype=bool)
            stay[hit + 1] = False
            sym, wid = sym[stay], wid[stay]
        if not done_sym:
            return np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        sym, wid = np.concatenate(done_sym), np.concatenate(done_wid)
        return sym[np.argsort(wid, kind="stable")].astype(np.uint32), np.bincount(wid, minlength=len(words))

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of text pieces and the number of ids of each."""
        seen: dict[bytes, int] = {}
        flow, special, owner = [], [], []
        for p, piece in enumerate(pieces):
            text = piece.decode("utf-8")
            for part in self.split.split(text) if self.split and "<" in text else (text,):
                if not part:
                    continue
                raw = part.encode()
                if raw in self.special:
                    flow.append(-1)
                    special.append(self.special[raw])
                    owner.append(p)
                    continue
                for w in (part,) if part[part[0] == " " :].isalpha() else self.words.findall(part):
                    flow.append(seen.setdefault(w.encode(), len(seen)))
                    special.append(0)
                    owner.append(p)
        flat, sizes = self.merge(list(seen))
        n = len(seen)
        start = np.concatenate(([0], np.cumsum(sizes)))
        flow, special = np.array(flow, dtype=np.int64), np.array(special, dtype=np.uint32)
        odd = flow < 0
        size = np.where(odd, 1, sizes[np.maximum(flow, 0)] if n else 1)
        ends = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
        pool = np.concatenate((flat, special[odd]))
        begin = np.where(odd, len(flat) + np.cumsum(odd) - 1, start[np.maximum(flow, 0)])
        out = pool[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        return out, np.bincount(np.array(owner, dtype=np.int64), weights=size, minlength=len(pieces)).astype(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.table.ids(data, offsets)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of a flat id array; bytes that are no UTF-8 become replacement characters."""
        size = self.token_end[ids + 1] - self.token_end[ids]
        ends = np.concatenate(([0], np.cumsum(size)))
        raw = self.token_bytes[np.repeat(self.token_end[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        edge = ends[offsets]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(edge[:-1], edge[1:], strict=True)]


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    """The codec of a file, once per Python worker."""
    return ByteBPE(path)


def _round_trip(path: str):
    def run(batches):
        codec = load(path)
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column(0)):
                ids, at = codec.encode(data, offsets)
                rows = [batch.column(c).slice(i, j - i) for c in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [*rows, pa.array(np.diff(at)), packed(ids, at), pa.array(codec.decode(ids.astype(np.int64), at), pa.string())],
                    [*batch.schema.names[1:], "n_tokens", "ids", "decoded"],
                )

    return run


def bpe_round_trip(docs: DataFrame, path: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns the columns ``carry`` (all of ``docs`` if None) and n_tokens
    (long), ids (binary, little-endian unsigned 32-bit) and decoded (string).
    ``path`` is a byte-level BPE file in the JSON form of the tokenizers
    library.  Null or empty texts have no ids and decode to "".  Repeated rows
    give repeated rows, an empty table an empty one.  Input columns named like
    the three results, in any case, are replaced by them.
    """
    small_batches(docs.sparkSession)
    rows = packed_rows(docs, text_col, RESULTS, carry)
    out = rows.mapInArrow(_round_trip(path), with_results(rows, n_tokens="long", ids="binary", decoded="string"))
    return out.select("_row.*", *RESULTS)
