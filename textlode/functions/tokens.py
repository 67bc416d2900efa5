"""Token counters and text encoders: pluggable, loaded once per Python worker."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PASSAGE, QUERY = "passage: ", "query: "
#: An encoder's input limit, its special tokens, and what is left for text.
ENCODER_LIMIT, SPECIAL_TOKENS = 512, 2
CAPACITY = ENCODER_LIMIT - SPECIAL_TOKENS

def encoder_capacity(limit: int, special: int = SPECIAL_TOKENS, *declared: int | None) -> int:
    """Tokens that a text may have; what tokenizer and model declare (None: nothing) may not be less than the limit."""
    if limit <= special or any(d is not None and d < limit for d in declared):
        raise ValueError(f"the encoder limit {limit} exceeds what tokenizer or model declare: {declared}")
    return limit - special


Encoder = Callable[[list[str]], np.ndarray]


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


class FileCounter:
    """Counts and offsets of a tokenizers file; ``prefix`` is counted with every document."""

    def __init__(self, path: str, prefix: str = PASSAGE):
        self.path, self.prefix = path, prefix

    def _encode(self, texts: list[str]):
        return _tokenizer(self.path).encode_batch(texts, add_special_tokens=False)

    def count(self, text: str) -> int:
        return len(self._encode([self.prefix + text])[0].ids)

    def bare(self, text: str) -> int:
        return len(self._encode([text])[0].ids)

    def count_many(self, texts: list[str], batch: int = 256) -> list[int]:
        """Counts in batches; equal texts are counted once."""
        distinct = list(dict.fromkeys(texts))
        known: dict[str, int] = {}
        for s in range(0, len(distinct), batch):
            part = distinct[s : s + batch]
            known |= dict(zip(part, (len(e.ids) for e in self._encode([self.prefix + t for t in part])), strict=True))
        return [known[t] for t in texts]

    def offsets(self, text: str) -> list[tuple[int, int]]:
        return list(self._encode([text])[0].offsets)


def token_count(text: Column, path: str, prefix: str = PASSAGE) -> Column:
    """Tokens of each text with the prefix, by a tokenizers file; null gives null."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = FileCounter(path, prefix)
        for t in batches:
            found = iter(counter.count_many([x for x in t if x is not None]))
            yield pd.Series([None if x is None else next(found) for x in t], dtype="Int32")

    return count(text)


class HashEncoder:
    """A deterministic stand-in for a model: signed hashed words, unit length."""

    def __init__(self, dim: int = 384):
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for row, text in zip(out, texts, strict=True):
            for w in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                row[h % self.dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        out[norm[:, 0] == 0, 0] = 1
        return out / np.where(norm > 0, norm, 1)


def checked(vectors: np.ndarray, rows: int, dim: int) -> np.ndarray:
    """Vectors of an encoder, if they are float, finite, of the right shape and not zero; scaled to unit length."""
    v = np.asarray(vectors, dtype=np.float32)
    if v.shape != (rows, dim):
        raise ValueError(f"expected {(rows, dim)} vectors, got {v.shape}")
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    if not np.isfinite(v).all() or (norm == 0).any():
        raise ValueError("vectors must be finite and not zero")
    return v / norm


def encode(text: Column, encoder: Encoder, dim: int, prefix: str = PASSAGE, batch: int = 64) -> Column:
    """array<float> of unit length for each text, encoded in batches of near lengths."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in batches:
            out: list = [None] * len(t)
            order = sorted((i for i, x in enumerate(t) if x is not None), key=lambda i: (len(t.iloc[i]), i))
            for s in range(0, len(order), batch):
                at = order[s : s + batch]
                for i, v in zip(at, checked(encoder([prefix + t.iloc[i] for i in at]), len(at), dim), strict=True):
                    out[i] = v
            yield pd.Series(out)

    return run(text)
