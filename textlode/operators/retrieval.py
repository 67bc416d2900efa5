"""Exact vector retrieval, ranking, pooling and result formatting.

Up to FEW_QUERIES queries of at most FEW_BYTES go to every task, which passes
over its vectors once and returns the best of each query: vectors are not
moved.  More queries are packed into blocks and vectors into shards; one block
meets one shard per row with a matrix product.  No row per pair is ever made.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

SHARD_ROWS, BLOCK_ROWS = 16_384, 1_024
#: A query set that may go to every task.
FEW_QUERIES, FEW_BYTES = 2_048, 16 << 20
CANDIDATES, FRAGMENTS, DOCUMENTS, MOST_WORDS = 50, 10, 3, 250


def _packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    n = max(1, math.ceil(rows.count() / size))
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    grouped = dealt.groupBy(name).agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    return grouped.select(name, F.col("rows.id").alias(f"{name}_ids"), F.flatten(F.col("rows.v")).alias(f"{name}_v")), n


FOUND = "query_id bigint, row_pos bigint, score double"


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest finite scores, ties to the smaller id."""
    m = min(k, len(scores))
    floor = np.partition(scores, len(scores) - m)[len(scores) - m] if m else 0.0
    some = np.flatnonzero((scores >= floor) & (scores > -np.inf))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _products(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rounded inner products, a query's own row left out."""
    scores = np.round(queries @ rows.T, 6)
    scores[q_ids[:, None] == ids[None, :]] = -np.inf
    return scores


def _rows(q_ids: np.ndarray, best: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    parts = (np.repeat(q_ids, [len(i) for i, _ in best]), np.concatenate([i for i, _ in best]).astype(np.int64), np.concatenate([s for _, s in best]))
    return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["query_id", "row_pos", "score"])


def _score(k: int):
    def run(batches):
        for batch in batches:
            lists = {c: batch.column(c) for c in ("block_ids", "block_v", "shard_ids", "shard_v")}
            for r in range(batch.num_rows):
                q_ids, q, ids, v = (np.asarray(lists[c][r].values) for c in lists)
                if not len(q_ids) or not len(ids):
                    continue
                queries, rows = q.reshape(len(q_ids), -1), v.reshape(len(ids), -1)
                for s in range(0, len(q_ids), 128):
                    scores = _products(q_ids[s : s + 128], queries[s : s + 128], ids, rows)
                    chosen = [_best(row, ids, k) for row in scores]
                    yield _rows(q_ids[s : s + 128], [(ids[c], row[c]) for c, row in zip(chosen, scores, strict=True)])

    return run


def _pass(q_ids: np.ndarray, queries: np.ndarray, k: int):
    """One pass over all vectors of a task, with the best of each query so far."""

    def run(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q_ids]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            for s in range(0, len(q_ids), 128):
                for i, row in enumerate(_products(q_ids[s : s + 128], queries[s : s + 128], ids, rows), s):
                    had_ids, had = best[i]
                    if len(had) == k and row.max() < had[-1]:
                        continue
                    all_ids, scores = np.concatenate((had_ids, ids)), np.concatenate((had, row))
                    top = _best(scores, all_ids, k)
                    best[i] = all_ids[top], scores[top]
        if len(q_ids):
            yield _rows(q_ids, best)

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = CANDIDATES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, position (from 1), row_pos, score: each query's k highest inner products, itself left out.

    Scores are rounded to six places, ties go to the smaller position.  Rows
    without a vector, or with components that are null or not finite, take no
    part.  All vectors have one dimension.
    """
    v = F.col(vector_col).cast("array<double>")
    plain = lambda df: df.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)))
    few = plain(queries).limit(FEW_QUERIES + 1).toArrow()
    if few.num_rows <= FEW_QUERIES and few.nbytes <= FEW_BYTES:
        q_ids = few.column("id").to_numpy()
        asked = few.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(q_ids), -1) if len(q_ids) else np.zeros((0, 0))
        return rank(plain(vectors).mapInArrow(_pass(q_ids, asked, k), FOUND), k, ["query_id"], "row_pos", "position")
    shards, n_shards = _packed(plain(vectors), SHARD_ROWS, "shard")
    blocks, n_blocks = _packed(plain(queries), BLOCK_ROWS, "block")
    left = blocks.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    right = shards.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    pairs = left.join(right, (F.col("s") == F.col("shard")) & (F.col("b") == F.col("block"))).select("block_ids", "block_v", "shard_ids", "shard_v")
    return rank(pairs.mapInArrow(_score(k), FOUND), k, ["query_id"], "row_pos", "position")


def rank(rows: DataFrame, k: int, by: list[str], tie: str, name: str = "rank", score: str = "score") -> DataFrame:
    """The k best of each group in order, numbered from 1."""
    if k <= 0:
        raise ValueError("k must be positive")
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def dedupe_chunks(hits: DataFrame) -> DataFrame:
    """One row per query and chunk: its best score, first position among equals; ``first_pos`` keeps the order of appearance."""
    best = F.max(F.struct(F.col("score"), (-F.col("position")).alias("p"), "doc_id")).alias("b")
    out = hits.groupBy("query_id", "chunk_id").agg(best, F.min("position").alias("first_pos"))
    return out.select("query_id", "chunk_id", F.col("b.doc_id").alias("doc_id"), F.col("b.score").alias("score"), "first_pos")


def pool_documents(hits: DataFrame, how: str = "max") -> DataFrame:
    """Scores of documents over candidate chunks: the best one ('max') or their sum ('sum')."""
    score = {"max": F.max("score"), "sum": F.round(F.sum(F.col("score").cast("decimal(20,6)")), 6).cast("double")}[how]
    return hits.groupBy("query_id", "doc_id").agg(score.alias("score"), F.min("first_pos").alias("first_pos"))


def with_chunks(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Positional join: hit.row_pos to the chunk row of that position."""
    return hits.join(chunks, "row_pos")


def results(hits: DataFrame, fragments: int = FRAGMENTS, documents: int = DOCUMENTS, text: Column | None = None) -> DataFrame:
    """query_id, documents array<struct(rank, doc_id)>, fragments array<struct(rank, chunk_id, doc_id, text)>.

    ``hits`` has query_id, position, row_pos, score, chunk_id, doc_id, texto.
    """
    unique = dedupe_chunks(hits)
    best = rank(unique, fragments, ["query_id"], "first_pos")
    texts = hits.select("chunk_id", (text if text is not None else T.truncate_at_sentence(F.col("texto"), MOST_WORDS)).alias("text")).dropDuplicates(["chunk_id"])
    frag = best.join(texts, "chunk_id").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "doc_id", "text"))).alias("fragments"))
    docs = rank(pool_documents(unique), documents, ["query_id"], "first_pos").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("documents"))
    return docs.join(frag, "query_id").select("query_id", "documents", "fragments")
