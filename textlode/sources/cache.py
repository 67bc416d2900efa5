"""Texts already read, kept by the signature of their file.

A cache is a folder of JSON lines (key, doc_id, text).  Its key names the
file's path, size, time and the reader's version, and whether pages without
text were recognised.  Lines that are no entries are skipped; of entries with
one key the last written counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relations import upsert
from .corpus import read_files
from .readers import Reader

#: Goes up when readers change what they return.
VERSION = 1
ENTRY = "key string, doc_id string, text string"


def signature(recognised: bool = False, version: int = VERSION) -> Column:
    """Key of a file (path, size, mtime): JSON with sorted names."""
    fields = [F.unix_micros("mtime").alias("mtime"), F.lit(recognised).alias("ocr"), F.col("path").alias("path"), F.col("size").cast("bigint").alias("size"), F.lit(version).alias("version")]
    return F.to_json(F.struct(*fields))


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of a cache, one per key; a folder that is not there is an empty cache."""
    try:
        lines = spark.read.text(folder)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], ENTRY)
    rows = lines.select(F.from_json("value", ENTRY).alias("e"), F.col("_metadata.file_modification_time").alias("t"), F.monotonically_increasing_id().alias("i"))
    rows = rows.where("e.key is not null and e.text is not null")
    return rows.groupBy(F.col("e.key").alias("key")).agg(F.max_by("e", F.struct("t", "i")).alias("e")).select("e.*")


def lookup(files: DataFrame, cache: DataFrame) -> DataFrame:
    """``files`` with text and doc_id from the cache: the plain entry, else that with recognised pages; null without either."""
    plain = cache.select(F.col("key").alias("_k1"), F.col("text").alias("_t1"), F.col("doc_id").alias("_d1"))
    second = cache.select(F.col("key").alias("_k2"), F.col("text").alias("_t2"), F.col("doc_id").alias("_d2"))
    found = files.withColumn("_p", signature()).withColumn("_o", signature(True)).join(plain, F.col("_p") == F.col("_k1"), "left").join(second, F.col("_o") == F.col("_k2"), "left")
    return found.withColumn("text", F.coalesce("_t1", "_t2")).withColumn("doc_id", F.coalesce("_d1", "_d2")).withColumn("cached", F.col("_k1").isNotNull() | F.col("_k2").isNotNull()).drop("_p", "_o", "_k1", "_k2", "_t1", "_t2", "_d1", "_d2")


def read_through(files: DataFrame, cache: DataFrame, plugins: dict[str, Reader] | None = None, recognised: bool = False) -> tuple[DataFrame, DataFrame]:
    """(files read, new entries): what the cache has is not read again, what failed gets no entry."""
    known = lookup(files, cache)
    hits = known.where("cached").select("ordinal", "path", "suffix", "size", "mtime", "doc_id", "text", F.lit(None).cast("string").alias("error"), F.lit(True).alias("cached"))
    fresh = read_files(known.where("not cached").select(*files.columns), plugins)
    entries = fresh.where("error is null").select(signature(recognised).alias("key"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    return hits.unionByName(fresh.select("ordinal", "path", "suffix", "size", "mtime", "doc_id", "text", "error", F.lit(False).alias("cached"))), entries


def write(cache: DataFrame, entries: DataFrame, folder: str) -> None:
    """Entries of both, those of ``entries`` first, as JSON lines in order of key; ``folder`` must be new."""
    whole = upsert(cache.select("key", "doc_id", "text"), entries.select("key", "doc_id", "text"), "key")
    whole.repartitionByRange("key").sortWithinPartitions("key").write.mode("errorifexists").json(folder)
