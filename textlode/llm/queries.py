"""The thin queries over the operators of this subpackage: one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that stay of every document once repeated 35-word windows are gone."""
    from .substring_dedup import substring_dedup

    out = substring_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), window=35, carry=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op2_token_frames(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Where each document's ids lie in the token files, read back from them, and their checksum."""
    from . import token_frames as T

    folder = T.token_folder(spark)
    T.write_token_frames(_table(spark, sf_dir, "documents"), folder, vocabulary or _vocabulary("word_bpe_49k.json"), end_id=1)
    return T.read_token_frames(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document at similarity 0.85."""
    from .minhash_dedup import minhash_components

    return minhash_components(_table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from three quarters of them."""
    from . import language_id as L

    docs = _table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(L.id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)))
    model = L.fit(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return L.identify(docs, model, carry=["doc_id", "held_out"])


def op5_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every fiftieth vector, exactly."""
    from .kd_search import kd_top_k

    return kd_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op6_onebit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors found for every twentieth vector."""
    from .onebit_search import onebit_top_k

    return onebit_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from four fifths of the labels."""
    from . import toxicity as X
    from .language_id import id_remainder

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(id_remainder(F.col("doc_id"), 5) != 0)
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return X.score_toxicity(docs.withColumn("held_out", held_out), X.fit(docs, labels), carry=["doc_id", "held_out"])


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Digests of the byte-level BPE ids of every document and of the text they decode to."""
    from .bpe import bpe_round_trip

    out = bpe_round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary or _vocabulary("byte_bpe_50k.json"), carry=["doc_id"])
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of weights 5, 2, 1 takes of every document."""
    from .mixing import mix_sources

    out = mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), carry=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which capture each not-modified answer of the crawl log stands for, and its merged headers."""
    from .warc import recrawl, resolve_revisits

    out = resolve_revisits(recrawl(_table(spark, sf_dir, "pages")))
    page = F.substring("record_id", 2, 20).cast("bigint")
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["k"], F.lit("="), h["v"])), "|")
    return out.select(page.alias("page_id"), "url", "refers_to", "outcome", lines.alias("headers"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    from . import mixing, oracles, warc

    return {"op1_substring_dedup": oracles.SUBSTRING, "op3_minhash_near_dedup": oracles.NEAR, "op5_kd_top_k": oracles.TOP_K, "op9_mixing": mixing.ORACLE, "op10_warc_revisits": warc.ORACLE}
