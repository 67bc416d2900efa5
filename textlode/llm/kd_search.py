"""Exact top-k by inner product of quantised vectors, over one KD-tree per shard.

Shards are regions of space: the leaves of median splits learned from a
bounded sample, each divided further if it holds more than a shard may.  In a
shard a tree splits at the median of its widest dimension until a leaf holds at most
LEAF vectors; every node keeps the tight bounding box of its vectors.  The
greatest inner product that a box allows is the sum over dimensions of
max(q * low, q * high).  All trees of a task share one queue, ordered by that
bound: the node with the best bound is opened first, a leaf's vectors are
scored, and the search ends when no bound reaches the kth score found so far,
which is carried from leaf to leaf and from shard to shard.  Only boxes and ids
travel to a task; a shard's vectors are read once a leaf of it is opened.

How much boxes rule out depends on the vectors: clusters that lie apart are
never opened, while vectors spread evenly over a sphere of many dimensions
leave every box in reach (``opened_share`` measures it).

Components become floor(scale * x).  Sums are exact: in doubles while they stay
below 2**53, else in 64-bit integers.
"""

from __future__ import annotations

import heapq
import io
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _blocks as B
from ..sources.staging import Scratch

LEAF = 256
SCALE = 256


def build_tree(rows: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Order of rows by leaf, and nodes: start, stop, left child (-1: leaf; the right one follows), low, high."""
    order = np.arange(len(rows))
    start, stop, left, low, high = [0], [len(rows)], [], [], []
    node = 0
    while node < len(start):
        a, b = start[node], stop[node]
        part = rows[order[a:b]]
        lo, hi = part.min(axis=0), part.max(axis=0)
        low.append(lo)
        high.append(hi)
        if b - a <= leaf or not (hi > lo).any():
            left.append(-1)
        else:
            axis, middle = int((hi - lo).argmax()), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], middle)]
            left.append(len(start))
            start += [a, a + middle]
            stop += [a + middle, b]
        node += 1
    return order, {"start": np.array(start), "stop": np.array(stop), "left": np.array(left), "low": np.array(low), "high": np.array(high)}


def quantise(rows: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(rows * scale)


def _shard(scale: int):
    def build(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
        q = quantise(rows, scale)
        order, tree = build_tree(q)
        out = io.BytesIO()
        np.savez(out, **tree)
        return ids[order], q[order], out.getvalue()

    return build


class Shard:
    """Ids and boxes of a shard; its vectors are read when a leaf is opened."""

    def __init__(self, row: dict, dim: int, folder: str):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.read = lambda: B.read_vectors(folder, row["file"], dim)
        with np.load(io.BytesIO(row["extra"])) as f:
            self.start, self.stop, self.left, self.low, self.high = (f[k] for k in ("start", "stop", "left", "low", "high"))
        self.kind = np.float64

    @cached_property
    def rows(self) -> np.ndarray:
        return self.read().astype(self.kind, copy=False)

    def most(self) -> float:
        return max(float(np.abs(self.low).max(initial=0)), float(np.abs(self.high).max(initial=0)))

    def to_integers(self) -> None:
        self.kind, self.low, self.high = np.int64, self.low.astype(np.int64), self.high.astype(np.int64)


def search_trees(shards: list[Shard], query: np.ndarray, own: int, k: int, bounds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best k (ids, scores) of one query; ``bounds`` has the bound of every node of every shard."""
    queue = [(-b[0], s, 0) for s, b in enumerate(bounds)]
    heapq.heapify(queue)
    ids, scores, kth = np.zeros(0, np.int64), np.zeros(0, query.dtype), -np.inf
    while queue:
        bound, s, node = heapq.heappop(queue)
        if -bound < kth:
            break
        shard = shards[s]
        child = shard.left[node]
        if child >= 0:
            for c in (child, child + 1):
                if (b := bounds[s][c]) >= kth:
                    heapq.heappush(queue, (-b, s, c))
            continue
        a, b = shard.start[node], shard.stop[node]
        got = shard.rows[a:b] @ query
        near = np.flatnonzero((got >= kth) & (shard.ids[a:b] != own))
        if not len(near):
            continue
        ids, scores = np.concatenate((ids, shard.ids[a:b][near])), np.concatenate((scores, got[near]))
        best = B.best_rows(scores, ids, k)
        ids, scores = ids[best], scores[best]
        if len(ids) == k:
            kth = scores[-1]
    return ids, scores


def block_bounds(shards: list[Shard], queries: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Queries in a kind of number in which all sums are exact, and the bound of every node for each."""
    dim = queries.shape[1]
    if dim * max(s.most() for s in shards) * float(np.abs(queries).max(initial=0)) >= 2**53:
        queries = queries.astype(np.int64)
        for s in shards:
            s.to_integers()
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return queries, [up @ s.high.T + down @ s.low.T for s in shards]


def _search(k: int, scale: int, folder: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        for dim, own, vectors, rows in B.parts(left, right):
            shards = [Shard(r, dim, folder) for r in rows]
            queries, bounds = block_bounds(shards, quantise(vectors, scale))
            for i, q in enumerate(queries):
                ids, scores = search_trees(shards, q, own[i], k, [b[i] for b in bounds])
                out_q.append(np.full(len(ids), own[i]))
                out_v.append(ids)
                out_s.append(scores.astype(np.int64))
        return B.found(out_q, out_v, out_s, pa.int64())

    return run


def opened_share(rows: np.ndarray, queries: np.ndarray, k: int, leaf: int = LEAF) -> float:
    """Share of the leaves of one tree that hold a bound above the kth score of each query, on average."""
    _, tree = build_tree(rows, leaf)
    leaves = np.flatnonzero(tree["left"] < 0)
    bound = np.maximum(queries, 0) @ tree["high"][leaves].T + np.minimum(queries, 0) @ tree["low"][leaves].T
    kth = -np.partition(-(queries @ rows.T), k, axis=1)[:, k]  # the query itself is one of the rows
    return float((bound >= kth[:, None]).mean())


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query over all runs, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def kd_top_k(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Each query's k highest integer inner products: query_id, rank, vec_id, score.

    Queries are the rows where ``is_query``; candidates are all rows of another
    id and of the same dimension.  Ties go to the smaller id.  A query with
    fewer candidates gets all, with none no rows.  Rows with a null id, or a
    vector that is null, empty or holds a null or non-finite component, take no
    part.  Repeated rows are repeated candidates; rows of one id are one
    another's own, and the one whose vector comes first, component by component,
    asks.  Scores must fit 64 bits.  Other columns are ignored.
    """
    work = Scratch(table.sparkSession, "kd")
    rows = B.usable(table, id_col, vector_col)
    asked = B.one_per_id(B.usable(table.where(is_query), id_col, vector_col))
    shards, n_shards = B.make_shards(rows, _shard(scale), work, spatial=True)
    blocks, n_blocks = B.make_blocks(asked, n_shards, work)
    return ranked(B.search(blocks, n_blocks, shards, n_shards, _search(k, scale, work.path("vectors")), "bigint"), k)
