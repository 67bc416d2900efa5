"""Paged files behind a plug-in that knows their format.

The plug-in gives the text of every page; pages without any go to a second one
that recognises text in their picture, if there is one.  What is read keeps the
number of its page as a mark in front.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .corpus import page_class
from .readers import Reader

#: Native text of every page of a file.
Pages = Callable[[bytes], list[str]]
#: Text recognised on one page, by its number from 1 on.
Recognise = Callable[[bytes, int], str]
# The mark of a page, and what is said of files that give no text.
MARK = "[Pagina {}]"
NO_PAGES, NO_TEXT = "El PDF no contiene paginas", "PDF escaneado sin texto recuperable por OCR"
ALL_BLANK, SOME_BLANK = "PDF sin texto extraible; OCR desactivado", "PDF con paginas sin texto extraible; OCR desactivado"


@dataclass
class Diagnosis:
    """Pages in all, by native text, by recognised text and without any."""

    pages: int = 0
    native: int = 0
    recognised: int = 0
    blank: int = 0


def read_paged(raw: bytes, pages: Pages, recognise: Recognise | None = None, seen: Diagnosis | None = None) -> str:
    """Marked pages with text, a blank line between them; a file that stays incomplete is an error."""
    seen = seen if seen is not None else Diagnosis()
    native = [p.strip() for p in pages(raw)]
    seen.pages, seen.native = len(native), sum(map(bool, native))
    if not native:
        raise ValueError(NO_PAGES)
    if recognise is None:
        seen.blank = seen.pages - seen.native
        if seen.blank:
            raise ValueError(SOME_BLANK if seen.native else ALL_BLANK)
    found = [p or recognise(raw, i).strip() for i, p in enumerate(native, 1)]
    seen.recognised = sum(map(bool, found)) - seen.native
    seen.blank = seen.pages - seen.native - seen.recognised
    if not any(found):
        raise ValueError(NO_TEXT)
    return "\n\n".join(f"{MARK.format(i)}\n{p}" for i, p in enumerate(found, 1) if p)


def paged_reader(pages: Pages, recognise: Recognise | None = None) -> Reader:
    """A reader for ``plugins`` of the ingestion."""
    return lambda raw: read_paged(raw, pages, recognise)


def diagnose(files: DataFrame, pages: Pages, recognise: Recognise | None = None, path: str = "path", content: str = "content") -> DataFrame:
    """Per file: pages, native, recognised, blank, error and class (native, mixed, ocr, unreadable)."""

    def one(raw: bytes | None) -> tuple:
        seen = Diagnosis()
        try:
            read_paged(raw or b"", pages, recognise, seen)
        except Exception as e:  # whatever a plug-in meets in a broken file is its diagnosis
            return seen.pages, seen.native, seen.recognised, seen.blank, str(e) or type(e).__name__
        return seen.pages, seen.native, seen.recognised, seen.blank, None

    @F.pandas_udf("struct<pages:int,native:int,recognised:int,blank:int,error:string>")
    def look(raw: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(r) for r in raw], columns=["pages", "native", "recognised", "blank", "error"])

    got = files.select(F.col(path).alias("path"), look(F.col(content)).alias("d")).select("path", "d.*")
    kind: Column = F.when(F.col("error").isNotNull() & (F.col("native") + F.col("recognised") == 0), "unreadable").otherwise(page_class(F.col("native"), F.col("recognised"), F.col("pages")))
    return got.withColumn("class", kind)
