"""Rows that travel whole beside the column an operator works on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kept_names(docs: DataFrame, results: tuple[str, ...], carry: list[str] | None = None) -> list[str]:
    """Columns of ``docs`` (or ``carry``) that no result replaces; case counts only where the session says so."""
    exact = docs.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    fold = (lambda c: c) if exact else str.casefold
    taken = {fold(r) for r in results}
    return [c for c in (docs.columns if carry is None else carry) if fold(c) not in taken]


def packed_rows(docs: DataFrame, text_col: str, results: tuple[str, ...], carry: list[str] | None = None) -> DataFrame:
    """(_text, _row): the text to work on and the columns to return with it."""
    names = kept_names(docs, results, carry)
    return docs.select(F.col(f"`{text_col}`").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))


def with_results(rows: DataFrame, **results: str) -> StructType:
    """Schema of ``_row`` followed by results of the named types."""
    out = StructType([rows.schema["_row"]])
    for name, kind in results.items():
        out = out.add(name, kind)
    return out
