"""Ingestion: a folder of mixed files to documents and incidents."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.relations import ranked
from .images import size_column
from .mvt import deduped_texts, feature_rows
from .readers import READERS, Reader, read_column

# What a walk never takes.
IGNORED_FOLDERS = ("__pycache__", ".pytest_cache", ".venv", "venv", ".git")
IGNORED_FILES = (".DS_Store", "Thumbs.db")
SUPPORTED = tuple(sorted(READERS))


def walk(spark: SparkSession, folder: str, allowed: list[str] | None = None) -> DataFrame:
    """Files below a folder: path (relative), suffix, size, mtime, content, ordinal.

    Ignored folders, junk and temporary files are left out; with ``allowed``,
    only these relative paths stay.  The ordinal is that of a walk sorted by
    path parts.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = F.lit(folder.removeprefix("file:").rstrip("/").lstrip("/") + "/")
    whole = F.regexp_replace("path", "^[a-z0-9+.-]+:/*", "")
    rel = F.expr("substring(_w, instr(_w, _r) + length(_r))")
    rows = files.withColumn("_w", whole).withColumn("_r", root)
    rows = rows.select(rel.alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), "content")
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    junk = F.arrays_overlap(parts, F.array(*map(F.lit, IGNORED_FOLDERS))) | name.isin(*IGNORED_FILES) | name.startswith(".~") | F.lower(name).endswith(".tmp")
    rows = rows.where(~junk).withColumn("suffix", T.suffix(F.col("path")))
    if allowed is not None:
        rows = rows.join(spark.createDataFrame([(p,) for p in allowed], "path string"), "path", "left_semi")
    order = ranked(rows.select("path", F.split("path", "/").alias("_parts")), ["_parts"])
    return rows.join(order.select("path", F.col("_i").alias("ordinal")), "path")


def inspect(files: DataFrame) -> DataFrame:
    """discovered and supported files, before any is read."""
    return files.agg(F.count(F.lit(1)).alias("discovered"), F.count_if(F.col("suffix").isin(*SUPPORTED)).alias("supported"))


def fold_path(path: Column) -> Column:
    """Path in composed, caseless form, for the list of auxiliary files."""

    @F.pandas_udf("string")
    def fold(p: pd.Series) -> pd.Series:
        return p.map(lambda x: unicodedata.normalize("NFC", x).casefold() if x is not None else None)

    return fold(path)


def read_files(files: DataFrame, plugins: dict[str, Reader] | None = None) -> DataFrame:
    """Files with cleaned text, error, metadata and the columns of documents."""
    got = files.withColumn("_r", read_column(F.col("content"), F.col("suffix"), plugins)).withColumn("_i", size_column(F.when(T.format_name(F.col("suffix")) == "imagen", F.col("content"))))
    links = T.urls(F.make_valid_utf8(F.col("content").cast("string")))
    source = F.when((F.col("suffix") == ".json") & (F.size(links) > 0), F.struct(links.alias("urls")))
    return got.select(
        "ordinal", "path", "suffix", "size", "mtime",
        T.document_id(F.col("path"), F.col("content")).alias("doc_id"),
        T.clean_text(F.col("_r.text")).alias("text"), F.col("_r.error").alias("error"),
        T.phenomenon(F.col("path")).alias("fenomeno"), F.struct(source.alias("procedencia"), F.when(F.col("_i.ancho").isNotNull(), F.col("_i")).alias("imagen")).alias("metadata"),
    )


def route(rows: DataFrame) -> DataFrame:
    """``rows`` with status: procesado, omitido, pendiente_ocr, fallido, vacío or sin_texto_util.

    Of several readable rows of one doc_id the first by ordinal is processed,
    the others failed.
    """
    error, text = F.col("error"), F.coalesce(F.col("text"), F.lit(""))
    image = T.format_name(F.col("suffix")) == "imagen"
    plain = (
        F.when(error == "Formato no soportado", "omitido")
        .when(error.contains("OCR desactivado") | error.contains("PDF sin texto extraible"), "pendiente_ocr")
        .when(error.isNotNull(), "fallido")
        .when(F.trim(text) == "", F.when(image, "sin_texto_util").otherwise("vacío"))
        .otherwise("procesado")
    )
    staged = rows.withColumn("status", plain)
    again = (F.col("status") == "procesado") & (F.row_number().over(Window.partitionBy("doc_id", "status").orderBy("ordinal")) > 1)
    return staged.withColumn("_again", again).withColumn("error", F.when(F.col("_again"), F.concat(F.lit("doc_id duplicado: "), F.col("doc_id").cast("string"))).otherwise(error)).withColumn("status", F.when(F.col("_again"), "fallido").otherwise(F.col("status"))).drop("_again")


def documents(routed: DataFrame) -> DataFrame:
    return routed.where("status = 'procesado'").select("doc_id", F.col("path").alias("fuente"), T.format_name(F.col("suffix")).alias("formato"), "fenomeno", T.language_vote(F.col("text")).alias("idioma"), F.col("text").alias("texto"), "metadata")


def incidents(routed: DataFrame) -> DataFrame:
    reason = F.coalesce("error", F.when(F.col("status") == "vacío", "No se extrajo contenido textual").when(F.col("status") == "sin_texto_util", "Imagen valida sin texto recuperable por OCR"))
    return routed.where("status <> 'procesado'").select(F.col("path").alias("archivo"), F.col("status").alias("estado"), reason.alias("error"))


def counters(routed: DataFrame) -> DataFrame:
    """Files by state; garbled writings of an accented state count as that state."""
    state = F.when(F.col("status").isin("vacío", "vacio", "vacÃ­o"), "vacío").otherwise(F.col("status"))
    return routed.groupBy(state.alias("estado")).agg(F.count(F.lit(1)).alias("n"))


def without_repeated_features(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Texts of vector tiles without features that an earlier tile of the walk had; other rows as they are.

    A tile that only repeats others keeps an empty text, and is routed so.
    """
    tiles = files.where("suffix = '.pbf'").select("ordinal", "content")
    fresh = deduped_texts(feature_rows(tiles, "ordinal"), "ordinal").select("ordinal", T.clean_text(F.col("text")).alias("_new"))
    tile = (F.col("suffix") == ".pbf") & F.col("error").isNull()
    return rows.join(fresh, "ordinal", "left").withColumn("text", F.when(tile, F.coalesce("_new", F.lit(""))).otherwise(F.col("text"))).drop("_new")


def ingest(spark: SparkSession, folder: str, auxiliary: dict[str, str] | None = None, plugins: dict[str, Reader] | None = None, allowed: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, incidents) of a folder; ``auxiliary`` maps paths that are not corpus to the reason."""
    files = walk(spark, folder, allowed)
    extra = None
    if auxiliary:
        known = spark.createDataFrame([*auxiliary.items()], "folded string, reason string")
        tagged = files.withColumn("folded", fold_path(F.col("path")))
        extra = tagged.join(known, "folded").select(F.col("path").alias("archivo"), F.lit("omitido").alias("estado"), F.col("reason").alias("error"))
        files = tagged.join(known, "folded", "left_anti").drop("folded")
    routed = route(without_repeated_features(read_files(files, plugins), files))
    lost = incidents(routed)
    return documents(routed), lost.unionByName(extra) if extra is not None else lost


def with_cache(files: DataFrame, cache: DataFrame, plugins: dict[str, Reader] | None = None) -> DataFrame:
    """Texts of files from a cache of (path, size, mtime, text), the rest read anew; ``cached`` says which."""
    key = ["path", "size", "mtime"]
    known = files.join(cache.select(*key, "text").dropDuplicates(key), key).select(*key, "ordinal", "text", F.lit(None).cast("string").alias("error"), F.lit(True).alias("cached"))
    fresh = read_files(files.join(cache.select(*key).distinct(), key, "left_anti"), plugins)
    return known.unionByName(fresh.select(*key, "ordinal", "text", "error", F.lit(False).alias("cached")))


def merged_in_order(*parts: DataFrame) -> DataFrame:
    """Documents of several passes over a corpus, in order of their source."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.orderBy("fuente")


def file_identity(files: DataFrame) -> DataFrame:
    """path, size and upper-case SHA-256 of the content."""
    return files.select("path", "size", F.upper(F.sha2("content", 256)).alias("sha256"))


def ocr_candidates(lost: DataFrame) -> DataFrame:
    """Paths to read again once a plug-in is there."""
    return lost.where("estado = 'pendiente_ocr'").select(F.col("archivo").alias("path"))


def page_class(native: Column, ocr: Column, total: Column) -> Column:
    """Class of a paged file by its pages with native and recognised text."""
    return F.when(native == total, "native").when((native > 0) & (ocr > 0), "mixed").when(ocr > 0, "ocr").otherwise("unreadable")
