"""Vector tiles: protobuf wire format to features and their text."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Layer:
    name: str = ""
    keys: list[str] = field(default_factory=list)
    values: list[object] = field(default_factory=list)
    features: list[tuple[int | None, list[int]]] = field(default_factory=list)


def _varints(raw: bytes, at: int = 0) -> Iterator[tuple[int, int]]:
    """(value, next position) of consecutive varints."""
    while at < len(raw):
        size = next((n for n in range(1, 11) if at + n <= len(raw) and raw[at + n - 1] < 0x80), None)
        if size is None:
            raise ValueError("PBF invalido: varint " + ("demasiado largo" if len(raw) - at >= 10 else "incompleto"))
        value = sum((b & 0x7F) << (7 * i) for i, b in enumerate(raw[at : at + size]))
        at += size
        yield value, at


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    for found in _varints(raw, at):
        return found
    raise ValueError("PBF invalido: varint incompleto")


def fields(raw: bytes) -> Iterator[tuple[int, int, int | bytes]]:
    """(field number, wire type, value) of one message."""
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(raw, at)
        elif wire in (1, 2, 5):
            size = {1: 8, 5: 4}.get(wire, 0)
            if wire == 2:
                size, at = _varint(raw, at)
            value, at = raw[at : at + size], at + size
            if at > len(raw):
                raise ValueError("PBF invalido: campo incompleto")
        else:
            raise ValueError(f"PBF invalido: wire type no soportado {wire}")
        yield key >> 3, wire, value


def _value(raw: bytes) -> object:
    out: object = None
    for number, wire, v in fields(raw):
        match number, wire:
            case 1, 2:
                out = v.decode("utf-8", "replace")
            case (4 | 5), 0:
                out = v
            case 6, 0:
                out = v // 2 if v % 2 == 0 else -(v + 1) // 2
            case 7, 0:
                out = bool(v)
    return out


def layers(raw: bytes) -> list[Layer]:
    """Layers of a tile."""
    found = []
    for number, wire, body in fields(raw):
        if (number, wire) != (3, 2):
            continue
        layer = Layer()
        for n, w, v in fields(body):
            match n, w:
                case 1, 2:
                    layer.name = v.decode("utf-8", "replace")
                case 2, 2:
                    ident, tags = None, []
                    for m, x, y in fields(v):
                        if (m, x) == (1, 0):
                            ident = y
                        elif (m, x) == (2, 2):
                            tags = [t for t, _ in _varints(y)]
                    layer.features.append((ident, tags))
                case 3, 2:
                    layer.keys.append(v.decode("utf-8", "replace"))
                case 4, 2:
                    layer.values.append(_value(v))
        if not layer.name:
            raise ValueError("PBF no reconocido: capa sin nombre")
        found.append(layer)
    if not found:
        raise ValueError("PBF no reconocido: no contiene capas MVT")
    return found


def properties(layer: Layer, tags: list[int]) -> dict[str, object]:
    """Tag pairs as a map; pairs out of range or without a value are skipped, later keys win."""
    pairs = zip(tags[::2], tags[1::2], strict=False)
    return {layer.keys[k]: layer.values[v] for k, v in pairs if k < len(layer.keys) and v < len(layer.values) and layer.values[v] is not None}


def features(raw: bytes) -> Iterator[tuple[str, str, str]]:
    """(layer, fingerprint, line) of every feature with properties, layers by name."""
    if not raw:
        return
    for layer in sorted(layers(raw), key=lambda x: x.name):
        for ident, tags in layer.features:
            props = properties(layer, tags)
            if not props:
                continue
            identity = {"capa": layer.name} | ({"id": ident} if ident is not None else {"propiedades": props})
            digest = hashlib.sha256(json.dumps(identity, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
            yield layer.name, digest, " | ".join([f"capa: {layer.name}", *(f"{k}: {props[k]}" for k in sorted(props))])


def tile_text(raw: bytes) -> str:
    """Lines of a tile's distinct features, in order."""
    lines: dict[str, str] = {}
    for _, digest, line in features(raw):
        lines.setdefault(digest, line)
    return "\n".join(lines.values())


FEATURE = "array<struct<layer:string,fingerprint:string,line:string>>"


def feature_column(content: Column) -> Column:
    """struct(features, error) of a binary column."""

    def one(raw: bytes) -> tuple:
        try:
            return [*features(raw)], None
        except (ValueError, IndexError) as e:
            return [], str(e)

    @F.pandas_udf(f"struct<features:{FEATURE},error:string>")
    def read(raw: pd.Series) -> pd.DataFrame:
        got = [one(r or b"") for r in raw]
        return pd.DataFrame({"features": [[{"layer": a, "fingerprint": b, "line": c} for a, b, c in g[0]] for g in got], "error": [g[1] for g in got]})

    return read(content)


def feature_rows(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """One row per feature: path, idx, layer, fingerprint, line."""
    return files.select(path, F.posexplode(feature_column(F.col(content))["features"]).alias("idx", "f")).select(path, "idx", "f.*")


def first_features(rows: DataFrame, order: str = "path") -> DataFrame:
    """Features that no earlier file, or earlier place of the same file, had."""
    first = F.row_number().over(Window.partitionBy("fingerprint").orderBy(order, "idx"))
    return rows.withColumn("_r", first).where("_r = 1").drop("_r")


def deduped_texts(rows: DataFrame, order: str = "path") -> DataFrame:
    """Text of each file from its new features only; a file without any has no row."""
    lines = F.array_sort(F.collect_list(F.struct("idx", "line")))
    return first_features(rows, order).groupBy(order).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("text"))


def diagnose(files: DataFrame, path: str = "path", content: str = "content", samples: int = 3) -> DataFrame:
    """Per file: size, state (EMPTY, PARSE_ERROR, VALID), layers, features, distinct features and samples."""
    got = files.select(path, F.length(content).alias("bytes"), feature_column(F.col(content)).alias("r"))
    state = F.when(F.col("bytes") == 0, "EMPTY").when(F.col("r.error").isNotNull(), "PARSE_ERROR").otherwise("VALID")
    names = F.array_distinct(F.transform("r.features", lambda f: f["layer"]))
    prints = F.array_distinct(F.transform("r.features", lambda f: f["fingerprint"]))
    return got.select(path, "bytes", state.alias("state"), F.size(names).alias("layers"), F.size("r.features").alias("features"), F.size(prints).alias("distinct_features"), F.slice(F.transform("r.features", lambda f: f["line"]), 1, samples).alias("samples"), "r.error")
