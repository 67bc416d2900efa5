"""Incremental ingestion: new files of a folder go through the same transforms, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators import packing as P


def document_stream(spark: SparkSession, folder: str, schema: str = "doc_id bigint, text string, source string") -> DataFrame:
    """JSON documents as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).json(folder)


def clean_stream(docs: DataFrame) -> DataFrame:
    """Cleaned documents with their language vote; rows without text are left out."""
    return docs.withColumn("text", T.clean_text(F.col("text"))).where("text <> ''").withColumn("idioma", T.language_vote(F.col("text")))


def chunk_stream(docs: DataFrame, most: int = 256, overlap: int = 32) -> DataFrame:
    """Chunks of a stream of documents, without state: a document is whole in one row."""
    units = docs.withColumn("units", P.counted_units(T.sentence_units(F.col("text"))))
    return P.chunk_rows(units, P.pack_additive(F.col("units"), most, overlap), keep=("source",))


def upsert_to(docs: DataFrame, target: str, checkpoint: str, transform=clean_stream) -> StreamingQuery:
    """Write each batch once: a batch that is run again replaces its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def source_counts(docs: DataFrame, time_col: str, width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Documents per source and time window; rows later than the watermark are left out."""
    return docs.withWatermark(time_col, late).groupBy(F.window(time_col, width), "source").agg(F.count(F.lit(1)).alias("n"))
