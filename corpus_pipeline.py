"""A corpus pipeline of five stages over ``documents``.

Each stage takes the rows that the stage before kept and returns the columns of
``documents``; only the last returns token digests.  Stages are written as
Parquet in the folder that the cluster shares and read again.  All stages take
empty tables, null or repeated ids, null and very long texts, repeated rows and
further columns, which they leave out; what each does with them it says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlode.llm import language_id
from textlode.sources.staging import Scratch
from textlode.llm.bpe import bpe_round_trip
from textlode.llm.minhash_dedup import drop_near_duplicates
from textlode.llm.mixing import mix_sources
from textlode.llm.substring_dedup import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language scored lower than this is rejected; with four labels, chance is 0.25.
MIN_LANGUAGE_SCORE = 0.35
#: Per cent of shared five-word shingles from which two documents are near-duplicates.
NEAR_PERCENT = 80
#: SQL has no language model, MinHash or BPE; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is undetermined or scored below the minimum; ``lang`` stays as it is.

    Null and empty texts have no letters and go.  Repeated rows stay or go
    together; rows of null id are judged but not learned from.  Ties of scores
    go to the label that sorts first.  Without any label all texts go.
    """
    model = language_id.fit(docs.where("doc_id is not null").where(language_id.id_remainder(F.col("doc_id"), 4) != 2))
    kept = language_id.identify(docs, model, carry=COLUMNS)
    return kept.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of similarity 0.80 and more: that of the smallest id, null last.

    Of rows with that id one stays.  Documents without words, null texts among
    them, are no duplicates: all stay.
    """
    return drop_near_duplicates(docs.select(COLUMNS), percent=NEAR_PERCENT)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 35 words and more that repeat; other texts stay as they were, byte for byte.

    Repeated rows repeat all their windows and lose them.  Null texts stay null;
    a text that loses all words is empty, and its row stays.
    """
    cut = substring_dedup(docs.select(COLUMNS), window=35)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", "n_chars").withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents as the mix of weights 5, 2, 1 takes them.

    A null source is one of its own, last in order.  Documents without words
    take none and may go or stay; equal rows are interchangeable.
    """
    mixed = mix_sources(docs.select(COLUMNS))
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, one row per copy; null texts have no ids and decode to ""."""
    import public_tokenizers

    out = bpe_round_trip(docs.select("doc_id", "text", "source"), public_tokenizers.path("byte_bpe_50k.json"), carry=["doc_id", "source"])
    return out.select("doc_id", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("substrings", substrings), ("mixture", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; each result but the last is written and read again."""
    work = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
