"""Normalisations that need the Unicode database: Arrow-batched, one pass per column."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_marks(text: str) -> str:
    """Decomposed text without non-spacing marks."""
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")


def strict(text: str) -> str:
    """Compatibility-composed, case-folded, single-spaced."""
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split())


def loose(text: str) -> str:
    """Also without marks and punctuation."""
    plain = unicodedata.normalize("NFKD", text).casefold()
    kept = (c if c.isalnum() else " " for c in plain if unicodedata.category(c) != "Mn")
    return " ".join("".join(kept).split())


def normal_for_match(text: str) -> str:
    """Lower case without marks, single-spaced."""
    return re.sub(r"\s+", " ", strip_marks(text.lower())).strip()


def compatibility_bytes(text: str) -> int:
    """UTF-8 length in compatibility form: an upper bound of most tokenizers' counts."""
    return len(unicodedata.normalize("NFKC", text).encode())


def column(function: Callable[[str], object], kind: str = "string") -> Callable[[Column], Column]:
    """A function of one string as Column -> Column; null stays null."""

    @F.pandas_udf(kind)
    def run(text: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else function(t) for t in text], dtype=object if kind == "string" else "Int64")

    return run
