"""Readers of file contents: bytes to text, one function per format.

They run inside Arrow batches over a binary column, so any source of bytes
(files, table columns) can feed them.  Formats that need software outside this
engine (PDF, images) are plug-ins; without one, their files become incidents.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import URL
from .mvt import tile_text

Reader = Callable[[bytes], str]


def read_plain(raw: bytes) -> str:
    return raw.decode("utf-8").replace("\r\n", "\n").replace("\r", "\n")


def _leaves(value: object, path: str) -> Iterator[tuple[str, str]]:
    """(path, text) of every scalar worth keeping: no nulls, no blank strings, no bare URLs."""
    stack = [(path, value)]
    while stack:
        at, node = stack.pop()
        if isinstance(node, dict):
            stack += [(f"{at}.{k}" if at else str(k), v) for k, v in reversed(node.items())]
        elif isinstance(node, list):
            stack += [(f"{at}[{i}]", v) for i, v in reversed([*enumerate(node)])]
        elif isinstance(node, str):
            text = node.strip()
            links = [u.rstrip(".,;)") for u in re.findall(URL, text)]
            if text and links != [text]:
                yield at, text
        elif node is not None:
            yield at, str(node)


def read_json(raw: bytes) -> str:
    """``path: value`` lines in document order; numbers and booleans as Python writes them."""
    return "\n".join(f"{path}: {text}" if path else text for path, text in _leaves(json.loads(raw.decode("utf-8-sig")), ""))


def _line(pairs: Iterator[tuple[str, str]]) -> str:
    return " | ".join(f"{k.strip()}: {v.strip()}" for k, v in pairs if k.strip() and v.strip())


def read_csv(raw: bytes) -> str:
    """``column: value | ...`` per row; rows without values are left out."""
    rows = csv.reader(io.StringIO(raw.decode("utf-8-sig"), newline=""))
    header = next((r for r in rows if r), None)
    if not header:
        raise ValueError("El archivo CSV no tiene encabezados válidos")
    lines = (_line((k, v) for k, v in dict(zip(header, row, strict=False)).items()) for row in rows)
    return "\n".join(x for x in lines if x)


SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _cell(cell: ElementTree.Element, shared: list[str]) -> str:
    kind, value = cell.get("t"), cell.find(f"{SHEET}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{SHEET}t"))
    text = value.text or "" if value is not None else ""
    if kind == "s":
        return shared[int(text)] if text else ""
    if kind == "b":
        return {"1": "True", "0": "False"}.get(text, text)
    if kind in (None, "n") and text and ("." in text or "e" in text.lower()):
        number = float(text)
        return str(int(number)) if number.is_integer() and "." not in text else str(number)
    return text


def _column(reference: str) -> int:
    number = 0
    for c in re.match("[A-Z]*", reference)[0]:
        number = number * 26 + ord(c) - 64
    return number


def read_xlsx(raw: bytes) -> str:
    """``[Hoja: sheet] header: value | ...`` per row of every sheet; the first row with values is the header."""
    lines = []
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{SHEET}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{SHEET}t")))
        links = {r.get("Id"): r.get("Target", "").lstrip("/") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{SHEET}sheet"):
            target = links[sheet.get(LINK)]
            header: dict[int, str] | None = None
            for row in ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{SHEET}row"):
                cells = {_column(c.get("r") or "") or i: _cell(c, shared).strip() for i, c in enumerate(row.iter(f"{SHEET}c"), 1)}
                if not any(cells.values()):
                    continue
                if header is None:
                    header = {i: cells.get(i) or f"columna_{i}" for i in range(1, max(cells) + 1)}
                    continue
                if text := _line((header[i], v) for i, v in sorted(cells.items()) if i in header):
                    lines.append(f"[Hoja: {sheet.get('name')}] {text}")
    return "\n".join(lines)


class _Page(HTMLParser):
    """Text runs of a page with the chain of elements that hold them."""

    HIDDEN = frozenset({"script", "style", "nav", "noscript", "template", "svg", "canvas"})
    VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.seen: dict[str, int] = {}
        self.runs: list[tuple[str, dict[str, int]]] = []
        self.within: list[dict[str, int]] = [{}]

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        inside = dict(self.within[-1])
        if tag in ("main", "article", "body") and not self.hidden:
            self.seen[tag] = self.seen.get(tag, 0) + 1
            inside.setdefault(tag, self.seen[tag])
        self.open.append(tag)
        self.within.append(inside)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                self.within.pop()
            self.within.pop()

    @property
    def hidden(self) -> bool:
        return not self.HIDDEN.isdisjoint(self.open)

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.runs.append((data.strip(), self.within[-1]))


def read_html(raw: bytes) -> str:
    """Text runs of the first main, else article, else body, else of all, one per line."""
    page = _Page()
    page.feed(raw.decode("utf-8"))
    page.close()
    for tag in ("main", "article", "body"):
        if tag in page.seen:
            return "\n".join(text for text, inside in page.runs if inside.get(tag) == 1)
    return "\n".join(text for text, _ in page.runs)


def _needs_plugin(message: str) -> Reader:
    def fail(raw: bytes) -> str:
        raise ValueError(message)

    return fail


#: Readers by suffix; ``plugins`` of the functions below override or add to them.
READERS: dict[str, Reader] = {
    ".txt": read_plain, ".md": read_plain, ".json": read_json, ".csv": read_csv, ".xlsx": read_xlsx, ".html": read_html, ".htm": read_html, ".pbf": tile_text,
    ".pdf": _needs_plugin("PDF sin texto extraible: OCR desactivado"),
    **{f".{s}": _needs_plugin("OCR desactivado") for s in ("avif", "jpeg", "jpg", "png", "tif", "tiff", "webp")},
}


def read_one(raw: bytes | None, suffix: str, readers: dict[str, Reader]) -> tuple[str | None, str | None]:
    """(text, error) of one file."""
    reader = readers.get(suffix)
    if reader is None:
        return None, "Formato no soportado"
    try:
        return reader(raw or b""), None
    except Exception as e:  # any reader may meet any broken file: it becomes an incident
        return None, str(e) or type(e).__name__


def read_column(content: Column, suffix: Column, plugins: dict[str, Reader] | None = None) -> Column:
    """struct(text, error) of a binary column, Arrow-batched."""
    readers = READERS | (plugins or {})

    @F.pandas_udf("struct<text:string,error:string>")
    def read(raw: pd.Series, kind: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_one(r, k, readers) for r, k in zip(raw, kind, strict=True)], columns=["text", "error"])

    return read(content, suffix)
