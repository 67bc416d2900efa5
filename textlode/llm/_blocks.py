"""A stated query set against all rows, in blocks.

Vectors are packed into shards of bounded size.  A shard's vectors lie in a
file of the shared folder; what travels is a row of its index (ids, codes or
boxes) and the file's name.  Queries are packed into blocks; each task holds
one block of queries and a run of shard indexes, opens the files of those
shards that its queries can't rule out, and returns the best ``k`` of each
query.  No join makes a row per pair, and no vector is copied per block.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Scratch

#: Most vectors of a shard, most queries of a block, shards that one task goes through.
SHARD_ROWS, BLOCK_ROWS, RUN_SHARDS = 8192, 1024, 8
#: Bytes that a shard's vectors may take; long vectors make smaller shards.
SHARD_BYTES = 32 << 20
#: Most regions that vectors of one dimension are dealt to, and bytes of their sample.
REGIONS, SAMPLE_BYTES = 256, 8 << 20
SHARDS = "dim int, shard int, file string, ids binary, extra binary"
BLOCKS = "dim int, block int, ids binary, vectors binary"
FOUND = "query_id bigint, vec_id bigint, score {}"


def finite(vector: Column) -> Column:
    """Not null or empty, and no component null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec array<double>, dim): rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    return table.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("vec")).where(F.col("id").isNotNull() & finite(F.col("vec"))).withColumn("dim", F.size("vec"))


def one_per_id(rows: DataFrame) -> DataFrame:
    """Of the rows of one id the one whose vector comes first, compared component by component."""
    return rows.groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))


def matrix(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending, and the rows of one group of equal dimension."""
    if isinstance(table, pa.Table):
        table = table.combine_chunks()
    dim = table.column("dim")[0].as_py()
    vec = table.column("vec")
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    ids = table.column("id").to_numpy()
    rows = vec.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
    order = np.lexsort((*rows.T[:1], ids))
    return ids[order], rows[order]


def shard_rows(dim: int) -> int:
    return max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * dim)))


def _lookup(values: dict, key: Column) -> Column:
    """The value of a key among literals; 1 for others."""
    if not values:
        return F.lit(1)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key), F.lit(1))


def _split(rows: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Axis and border of the nodes of a tree of median splits, level by level; rows not above the border go left."""
    parts, nodes = [rows], []
    for _ in range(depth):
        halves = []
        for part in parts:
            axis = int((part.max(axis=0) - part.min(axis=0)).argmax()) if len(part) else 0
            border = float(np.median(part[:, axis])) if len(part) else 0.0
            nodes.append((axis, border))
            left = part[:, axis] <= border
            halves += [part[left], part[~left]]
        parts = halves
    return nodes


def place(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``rows`` with ``region``: a leaf of median splits, learned from a sample of at most SAMPLE_BYTES per dimension.

    Every row is placed; the sample, rows of smallest hash, only sets borders.
    """
    trees = {}
    for dim, n in counts.items():
        depth = min(REGIONS, math.ceil(n / shard_rows(dim))).bit_length() - 1
        if depth <= 0:
            continue
        most = max(1, SAMPLE_BYTES // (8 * dim))
        few = rows.where((F.col("dim") == dim) & (F.xxhash64("id", "vec").cast("double") / 2.0**64 + 0.5 < most / n))
        got = few.select("vec").limit(2 * most).toArrow().column(0).combine_chunks()
        trees[dim] = _split(got.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), depth)
    if not trees:
        return rows.withColumn("region", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            region = np.zeros(len(dims), dtype=np.int32)
            for dim in np.unique(dims):
                if nodes := trees.get(int(dim)):
                    at = np.flatnonzero(dims == dim)
                    x = batch.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                    axis, border = (np.array(v) for v in zip(*nodes, strict=True))
                    node = np.zeros(len(at), dtype=np.int64)
                    for _ in range((len(nodes) + 1).bit_length() - 1):
                        node = 2 * node + 1 + (x[np.arange(len(at)), axis[node]] > border[node])
                    region[at] = node - len(nodes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region)], ["id", "vec", "dim", "region"])

    return rows.mapInArrow(run, "id bigint, vec array<double>, dim int, region int")


def make_shards(rows: DataFrame, build: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, bytes]], work: Scratch, spatial: bool) -> tuple[DataFrame, dict[int, int]]:
    """Index rows (see SHARDS) of all shards and the number of shards of each dimension.

    ``build`` takes ids and vectors and gives ids, vectors as they are to lie in
    the file, and the index.  Rows of a region are dealt evenly by a random
    number, so a vector that many rows share does not fill one shard.
    """
    counts = {r.dim: r["count"] for r in rows.groupBy("dim").count().collect()}  # one row per dimension
    placed = work.keep((place(rows, counts) if spatial else rows.withColumn("region", F.lit(0))).withColumn("r", F.rand(11)), "placed")
    sizes = {(r.dim, r.region): r["count"] for r in placed.groupBy("dim", "region").count().collect()}  # at most REGIONS per dimension
    first, number = {}, {}
    for (dim, region), n in sorted(sizes.items()):
        first[f"{dim} {region}"] = number.get(dim, 0)
        number[dim] = number.get(dim, 0) + math.ceil(n / shard_rows(dim))
    many = {f"{dim} {region}": math.ceil(n / shard_rows(dim)) for (dim, region), n in sizes.items()}
    name = F.concat_ws(" ", "dim", "region")
    dealt = placed.withColumn("shard", (_lookup(first, name) + F.floor(F.col("r") * _lookup(many, name))).cast("int")).select("dim", "shard", "id", "vec")
    folder = work.path("vectors")

    def one(table: pa.Table) -> pa.Table:
        dim, shard = (table.column(c)[0].as_py() for c in ("dim", "shard"))
        ids, vectors, extra = build(*matrix(table))
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        file = f"{dim}-{shard}-{uuid.uuid4().hex}"  # every attempt its own: a repeated task leaves an unused file behind
        with store.open_output_stream(f"{root}/{file}", compression=None) as out:
            out.write(np.ascontiguousarray(vectors, dtype="<f8").tobytes())
        cells = [pa.array([v], t) for v, t in ((dim, pa.int32()), (shard, pa.int32()), (file, pa.string()), (ids.astype("<i8").tobytes(), pa.binary()), (extra, pa.binary()))]
        return pa.table(cells, names=["dim", "shard", "file", "ids", "extra"])

    return work.keep(dealt.groupBy("dim", "shard").applyInArrow(one, SHARDS), "shards"), number


def read_vectors(folder: str, file: str, dim: int) -> np.ndarray:
    """All vectors of a shard."""
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{file}") as f:
        return np.frombuffer(f.read(), dtype="<f8").reshape(-1, dim)


def make_blocks(asked: DataFrame, number: dict[int, int], work: Scratch) -> tuple[DataFrame, dict[int, int]]:
    """Queries in blocks (see BLOCKS), small enough that all cores have some, and the number of blocks of each dimension."""
    asked = work.keep(asked, "asked")
    counts = {r.dim: r["count"] for r in asked.groupBy("dim").count().collect()}
    cores = asked.sparkSession.sparkContext.defaultParallelism
    many = {}
    for dim, n in counts.items():
        runs = max(1, math.ceil(number.get(dim, 0) / RUN_SHARDS))
        many[dim] = max(math.ceil(n / BLOCK_ROWS), min(math.ceil(2 * cores / runs), math.ceil(n / 64)))
    block = F.pmod(F.xxhash64("id"), _lookup(many, F.col("dim"))).cast("int")

    def one(table: pa.Table) -> pa.Table:
        ids, rows = matrix(table)
        cells = [table.column("dim")[:1].cast(pa.int32()), table.column("block")[:1].cast(pa.int32()), pa.array([ids.tobytes()], pa.binary()), pa.array([np.ascontiguousarray(rows).tobytes()], pa.binary())]
        return pa.table(cells, names=["dim", "block", "ids", "vectors"])

    return work.keep(asked.withColumn("block", block).groupBy("dim", "block").applyInArrow(one, BLOCKS), "blocks"), many


def search(blocks: DataFrame, n_blocks: dict[int, int], shards: DataFrame, n_shards: dict[int, int], run: Callable[[pa.Table, pa.Table], pa.Table], kind: str) -> DataFrame:
    """Apply ``run`` to each block with each run of shards of its dimension."""
    n_runs = {dim: math.ceil(n / RUN_SHARDS) for dim, n in n_shards.items()}
    runs, of = _lookup(n_runs, F.col("dim")), _lookup(n_blocks, F.col("dim"))
    left = blocks.withColumn("run", F.explode(F.sequence(F.lit(0), runs - 1)))
    right = shards.where(F.col("dim").isin(*n_blocks) if n_blocks else F.lit(False)).withColumn("block", F.explode(F.sequence(F.lit(0), of - 1))).withColumn("run", F.pmod("shard", runs))
    key = ["dim", "block", "run"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, FOUND.format(kind))


def parts(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[dict]]]:
    """Dimension, ids and vectors of each block of a task, and its shards in order; none if one side is empty."""
    if not left.num_rows or not right.num_rows:
        return
    dim = left.column("dim")[0].as_py()
    shards = sorted(right.select(["shard", "file", "ids", "extra"]).to_pylist(), key=lambda r: r["shard"])
    for row in left.select(["ids", "vectors"]).to_pylist():
        own = np.frombuffer(row["ids"], dtype=np.int64)
        yield dim, own, np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(own), dim), shards


def found(queries: list[np.ndarray], vectors: list[np.ndarray], scores: list[np.ndarray], kind: pa.DataType) -> pa.Table:
    cat = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0), t)
    return pa.table({"query_id": cat(queries, pa.int64()), "vec_id": cat(vectors, pa.int64()), "score": cat(scores, kind)})


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= floor)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]
