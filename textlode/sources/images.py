"""Width, height and colour mode of pictures, from their headers alone."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Size = tuple[int, int, str]
# Fixed values of the formats: colour types of PNG, colour channels of JPEG.
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}
#: JPEG segments that state the size: start of frame, but for tables and arithmetic conditioning.
FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def _png(raw: bytes) -> Size:
    width, height, depth, colour = struct.unpack(">IIBB", raw[16:26])
    return width, height, "1" if depth == 1 and colour == 0 else PNG_MODES[colour]


def _jpeg(raw: bytes) -> Size:
    at = 2
    while at + 9 < len(raw):
        if raw[at] != 0xFF:
            raise ValueError("no segment where one should be")
        kind = raw[at + 1]
        if kind in FRAMES:
            height, width, channels = struct.unpack(">HHB", raw[at + 5 : at + 10])
            return width, height, JPEG_MODES[channels]
        at += 1 if kind == 0xFF else 2 if 0xD0 <= kind <= 0xD9 or kind == 1 else 2 + int.from_bytes(raw[at + 2 : at + 4])
    raise ValueError("no frame")


def _webp(raw: bytes) -> Size:
    kind = raw[12:16]
    if kind == b"VP8X":
        return int.from_bytes(raw[24:27], "little") + 1, int.from_bytes(raw[27:30], "little") + 1, "RGBA" if raw[20] & 0x10 else "RGB"
    if kind == b"VP8L":
        bits = int.from_bytes(raw[21:25], "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1, "RGBA" if bits >> 28 & 1 else "RGB"
    width, height = struct.unpack("<HH", raw[26:30])
    return width & 0x3FFF, height & 0x3FFF, "RGB"


def _tiff(raw: bytes) -> Size:
    order = "<" if raw[:2] == b"II" else ">"
    (at,) = struct.unpack(f"{order}I", raw[4:8])
    (n,) = struct.unpack(f"{order}H", raw[at : at + 2])
    tags = {}
    for e in range(n):
        tag, kind, _ = struct.unpack(f"{order}HHI", raw[at + 2 + 12 * e : at + 10 + 12 * e])
        value = raw[at + 10 + 12 * e : at + 14 + 12 * e]
        tags[tag] = struct.unpack(f"{order}H", value[:2])[0] if kind == 3 else struct.unpack(f"{order}I", value)[0]
    return tags[256], tags[257], {1: "L", 3: "RGB", 4: "RGBA"}[tags.get(277, 1)]


def image_size(raw: bytes | None) -> Size | None:
    """(width, height, mode) of a PNG, JPEG, WebP or TIFF picture; None for anything else or a broken header."""
    raw = raw or b""
    try:
        if raw[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(raw)
        if raw[:2] == b"\xff\xd8":
            return _jpeg(raw)
        if raw[:4] == b"RIFF" and raw[8:12] == b"WEBP":
            return _webp(raw)
        if raw[:4] in (b"II*\0", b"MM\0*"):
            return _tiff(raw)
    except (struct.error, KeyError, ValueError, IndexError):
        pass
    return None


def size_column(content: Column) -> Column:
    """struct(ancho, alto, modo) of a binary column; null fields where there is no picture."""

    @F.pandas_udf("struct<ancho:int,alto:int,modo:string>")
    def read(raw: pd.Series) -> pd.DataFrame:
        found = [image_size(r) or (None, None, None) for r in raw]
        return pd.DataFrame({"ancho": pd.array([f[0] for f in found], "Int32"), "alto": pd.array([f[1] for f in found], "Int32"), "modo": [f[2] for f in found]})

    return read(content)
