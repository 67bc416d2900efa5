"""Near-duplicate classes by MinHash banding and odd sketches.

A document's set holds the 64-bit hashes of its distinct five-word shingles;
their seed is drawn for each run, so no text can be written to share the hash
of another.
Documents with equal sets form one class at once; only one member of a class
goes on, so thousands of copies cost one row.

1. *Bands.*  120 MinHash values in the longest bands in which a pair at the
   threshold shares none with probability 1e-6 at most: at 0.85 24 bands of 5
   (8e-7), at 0.80 30 bands of 4 (1.4e-7).
2. *Odd sketch.*  Sample i of value v flips bit hash(i, v) of a 512-bit map.
   The number of bits in the XOR of two maps estimates how many samples
   differ: E = 256 * (1 - exp(-m / 256)) for m differing entries, two per
   differing sample.  A pair goes on only if the estimate is not more than
   seven standard deviations from the threshold; so the sketch drops pairs
   cheaply and loses no link.
3. *Exact check.*  What is left is confirmed on the full sets.

Large buckets are not compared all against all.  First each class is compared
with one leader, the one of nearest sketch among those of its buckets, where a
bucket's leader is its class that shares buckets with the most others;
confirmed links are contracted to components.  A bucket in which all members
now share a component is settled.  In the others, classes of different
components are compared, first by sketch, then on full sets, inside tasks of
two blocks of bounded size.  A task joins components as it goes and returns
only the links that joined some, so what it returns grows with its members,
not with their pairs, and no link between components is lost.  The sets of a
block reach each task that compares it, so an open bucket of W shingles moves
W**2 / BLOCK_ITEMS of them.
"""

from __future__ import annotations

import math
import secrets
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _kernels as K
from ._graph import components, roots
from ..sources.staging import Scratch
from .substring_dedup import keyed

SHINGLE = 5
SAMPLES = 120
BITS = 512
#: Greatest probability that a pair at the threshold shares no band.
MOST_LOST = 1e-6
#: Shingles of a bucket's members that one side of a block task holds.
BLOCK_ITEMS = 1 << 20


def band_rows(threshold: float) -> int:
    """Most samples a band may hold so that a pair at ``threshold`` is lost with probability MOST_LOST at most."""
    return max(r for r in range(1, SAMPLES + 1) if SAMPLES % r == 0 and (r == 1 or (1 - threshold**r) ** (SAMPLES // r) <= MOST_LOST))


def sketch_limit(threshold: float, sigmas: float = 7.0) -> int:
    """Most differing sketch bits of a pair that may still reach ``threshold``."""
    spread = math.sqrt(SAMPLES * threshold * (1 - threshold))
    differing = 2 * min(SAMPLES, SAMPLES * (1 - threshold) + sigmas * spread)
    mean = BITS / 2 * (1 - math.exp(-2 * differing / BITS))
    return math.ceil(mean)


@lru_cache(maxsize=1)
def _families() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 2**32, (SAMPLES, 1), dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    b = rng.integers(0, 2**32, (SAMPLES, 1), dtype=np.uint64).astype(np.uint32)
    return a, b


def minhash(hashes: np.ndarray) -> np.ndarray:
    """120 minima of 32-bit multiply-add hashes over one non-empty set."""
    a, b = _families()
    x = (hashes >> K.U64(32)).astype(np.uint32)
    x ^= (hashes & K.U64(0xFFFFFFFF)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for s in range(0, len(x), 1024):
            np.minimum(out, (x[s : s + 1024] * a + b).min(axis=1), out=out)
    return out


def bands_and_sketches(mins: np.ndarray, rows: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (n, 120 / rows) and odd sketches (n, 8 words) of n rows of minima."""
    wide = mins.astype(K.U64)
    tagged = K.mix64(wide | (np.arange(SAMPLES, dtype=K.U64) << K.U64(32)), 11)
    band = np.zeros((len(mins), SAMPLES // rows), dtype=K.U64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            band = K.mix64(band * K.U64(K.WORD_BASE) + tagged[:, r::rows])
    where = (tagged >> K.U64(20)) & K.U64(BITS - 1)
    bit = K.U64(1) << (where & K.U64(63))
    words = [np.bitwise_xor.reduce(np.where(where >> K.U64(6) == K.U64(w), bit, K.U64(0)), axis=1) for w in range(BITS // 64)]
    return band, np.stack(words, axis=1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    low = K.lower_ascii(data)
    starts, ends, first = K.word_spans(low, offsets)
    words = K.word_hashes(low, starts, ends, seed)
    full = K.window_hashes(words, SHINGLE)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(full[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(K.window_hashes(words[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, dtype=K.U64))
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows).reshape(-1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, rows.shape[1], dtype=np.int32)), pa.array(flat))


SIGNED = "doc_id bigint, k1 bigint, k2 bigint, n int, d1 bigint, d2 bigint, bands array<bigint>, sketch array<bigint>"


def sign(rows: int, seed: int):
    """Set size, set digest, band hashes (bands of ``rows`` samples) and odd sketch of every text."""

    def run(batches):
        for batch in batches:
            data, offsets = K.buffers(batch.column(3))
            for i, j in K.slices(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], seed)
                mins = np.zeros((j - i, SAMPLES), dtype=np.uint32)
                digest = np.zeros((j - i, 2), dtype=np.int64)
                for r, s in enumerate(sets):
                    if len(s):
                        mins[r] = minhash(s)
                        for c in range(2):
                            digest[r, c] = np.add.reduce(K.mix64(s, 7 + c)).view(np.int64)
                band, sketch = bands_and_sketches(mins, rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in range(3)]
                    + [pa.array(np.array([len(s) for s in sets], dtype=np.int32)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), _lists(band), _lists(sketch)],
                    ["doc_id", "k1", "k2", "n", "d1", "d2", "bands", "sketch"],
                )

    return run


def full_sets(seed: int):
    """(cid, items): the sorted shingle hashes of every text."""

    def run(batches):
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            for i, j in K.slices(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], seed)
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["cid", "items"])

    return run


def confirm(percent: int):
    """Pairs whose full sets satisfy 100 * |A and B| >= percent * |A or B|."""

    def run(batches):
        for batch in batches:
            parts = []
            for c in (2, 3):
                col = batch.column(c)
                parts.append((col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False)))
            (ao, av), (bo, bv) = parts
            keep = []
            for r in range(batch.num_rows):
                x, y = av[ao[r] : ao[r + 1]], bv[bo[r] : bo[r + 1]]
                both = np.concatenate((x, y))
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


class Forest:
    """Union-find over component numbers."""

    def __init__(self, names: np.ndarray):
        self.up = {int(c): int(c) for c in names}

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def shared_with(items: np.ndarray, values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Size of the intersection of a sorted set with each of the sets ``rows``."""
    size = offsets[rows + 1] - offsets[rows]
    ends = np.concatenate(([0], np.cumsum(size)))
    flat = values[np.repeat(offsets[rows] - ends[:-1], size) + np.arange(ends[-1])]
    at = np.minimum(np.searchsorted(items, flat), len(items) - 1)
    return np.diff(np.concatenate(([0], np.cumsum(items[at] == flat)))[ends])


def block_links(limit: int, percent: int):
    """Confirmed links that join different components, of one block task.

    Pairs go from near to far by sketch; a pair whose components this task has
    joined already needs no check.  A pair that shares an earlier band is left
    to that band's task, so it is checked once in all.
    """

    def run(table: pa.Table) -> pa.Table:
        cid, comp, blk, n = (table.column(c).to_numpy() for c in ("cid", "comp", "blk", "n"))
        wide = {}
        for c in ("sketch", "bands", "items"):
            lists = table.column(c).combine_chunks()
            wide[c] = lists.flatten().to_numpy(zero_copy_only=False).view(K.U64)
        sk, bands = wide["sketch"].reshape(len(cid), -1), wide["bands"].reshape(len(cid), -1)
        values, offsets = wide["items"], np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        earlier = bands[:, : int(np.flatnonzero(bands[0] == K.U64(table.column("band")[0].as_py() % 2**64))[0])]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        forest, a_out, b_out = Forest(np.unique(comp)), [], []
        for x in left:
            rows = right[right > x] if i == j else right
            rows = rows[comp[rows] != comp[x]]
            rows = rows[(100 * np.minimum(n[rows], n[x]).astype(np.int64)) >= percent * np.maximum(n[rows], n[x])]
            far = np.bitwise_count(sk[rows] ^ sk[x]).sum(axis=1, dtype=np.int64)
            rows = rows[np.argsort(far, kind="stable")][: int((far <= limit).sum())]
            rows = rows[~(earlier[rows] == earlier[x]).any(axis=1)]
            items = values[offsets[x] : offsets[x + 1]]
            for part in (rows[:4], rows[4:]):
                roots = {int(c): forest.find(int(c)) for c in np.unique(comp[part])}
                own = forest.find(int(comp[x]))
                part = part[np.array([roots[int(c)] != own for c in comp[part]], dtype=bool)]
                if not len(part):
                    continue
                both = shared_with(items, values, offsets, part)
                for y in part[100 * both >= percent * (n[x] + n[part] - both)]:
                    if forest.find(int(comp[x])) != forest.find(int(comp[y])):
                        forest.join(int(comp[x]), int(comp[y]))
                        a_out.append(cid[x])
                        b_out.append(cid[y])
        return pa.table({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    return run


def near_duplicate_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, seed: int | None = None) -> DataFrame:
    """(doc_id, k1, k2, n, root, component_id) of every row.

    k1, k2 are the row's key (see ``keyed``), n its number of shingles, root a
    number of its component (null without shingles), component_id the smallest
    doc_id in it.  ``seed`` of the hashes is random if None.
    """
    spark = docs.sparkSession
    seed = secrets.randbits(63) if seed is None else seed
    work = Scratch(spark, "minhash")
    key = keyed(docs, id_col, text_col)
    named = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("k1"), F.xxhash64(F.col(f"`{text_col}`"), F.col(f"`{id_col}`"), F.lit(1)).alias("k2"))
    signed = work.keep(named.select("doc_id", "k1", "k2", "text").mapInArrow(sign(band_rows(percent / 100), seed), SIGNED), "signed")

    classes = signed.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("least_id"), F.min(F.struct("k1", "k2")).alias("key"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = work.keep(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    # the leader of a bucket is its class with the most company over all its buckets: of a text and its variants that is the text
    rows = classes.select("cid", F.explode("bands").alias("band"))
    sizes = work.keep(rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")  # a table, so that Spark may split a hot band of the join
    members = rows.join(sizes, "band").withColumn("pull", F.sum("size").over(Window.partitionBy("cid")))
    members = work.keep(members.select("band", "cid", "pull"), "members")
    leaders = work.keep(members.groupBy("band").agg(F.max(F.struct("pull", "cid")).alias("l")).select("band", F.col("l.cid").alias("leader")), "leaders")
    facts = classes.select("cid", "n", "sketch")

    limit = sketch_limit(percent / 100)
    star = members.join(leaders, "band").where("cid <> leader").select("cid", "leader").distinct()
    star = star.join(facts, "cid").join(facts.select(F.col("cid").alias("leader"), F.col("n").alias("m"), F.col("sketch").alias("other")), "leader")
    far = sum((F.bit_count(F.col("sketch")[w].bitwiseXOR(F.col("other")[w])) for w in range(BITS // 64)), F.lit(0))
    star = star.where(100 * F.least("n", "m").cast("bigint") >= percent * F.greatest("n", "m").cast("bigint")).withColumn("far", far).where(F.col("far") <= limit)
    nearest = work.keep(star.groupBy(F.col("cid").alias("b")).agg(F.min(F.struct("far", "leader")).alias("m")).select(F.col("m.leader").alias("a"), "b"), "nearest")

    wanted = classes.join(members.select("cid").distinct(), "cid", "left_semi").select("key.k1", "key.k2", "cid")
    sets = work.keep(key.join(wanted, ["k1", "k2"]).select("cid", "text").mapInArrow(full_sets(seed), "cid bigint, items array<bigint>").groupBy("cid").agg(F.first("items").alias("items")), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(sets.select(F.col("cid").alias("b"), F.col("items").alias("y")), "b")
        with_b = with_a.join(sets.select(F.col("cid").alias("a"), F.col("items").alias("x")), "a")
        return with_b.select("a", "b", "x", "y").mapInArrow(confirm(percent), "a bigint, b bigint")

    # each class has at most one nearest leader, and that has more company (or a greater cid at as much): a forest
    forest = confirmed(nearest).select(F.col("b").alias("node"), F.col("a").alias("parent")).distinct()
    comp = work.keep(roots(forest, work, "tree"), "comp")

    # buckets that still hold several components
    placed = members.select("band", "cid").join(comp.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("root", "cid")).drop("root")
    placed = placed.join(classes.select("cid", "n"), "cid")
    still_open = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum("n").alias("weight")).where("lo <> hi")
    still_open = work.keep(still_open.select("band", F.ceil(F.col("weight") / BLOCK_ITEMS).cast("int").alias("blocks")), "open")
    spread = (
        placed.join(still_open, "band")
        .withColumn("blk", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(classes.select("cid", "sketch", "bands"), "cid")
        .join(sets, "cid")
        .select("band", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "cid", "comp", "n", "sketch", "bands", "items")
    )
    more = spread.groupBy("band", "i", "j").applyInArrow(block_links(limit, percent), "a bigint, b bigint")
    more, seen = work.keep_observed(more, "more", n=F.count(F.lit(1)))
    if seen["n"]:  # join components: only their roots make up this graph
        rooted = lambda side: comp.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
        ends = more.join(rooted("a"), "a", "left").join(rooted("b"), "b", "left")
        merged = components(ends.select(F.coalesce("ra", "a").alias("u"), F.coalesce("rb", "b").alias("v")), work, "merge")
        merged = merged.select(F.col("node").alias("root"), F.col("root").alias("top"))
        moved = comp.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        alone = merged.join(comp.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
        comp = moved.union(alone)
    work.drop("sizes", "leaders", "open", "members", "sets", "nearest")

    grouped = classes.select("d1", "d2", "cid", "least_id").join(comp.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    final = work.keep(grouped.join(least, "root").select("d1", "d2", "root", "component_id"), "final")
    return signed.select("doc_id", "k1", "k2", "n", "d1", "d2").join(final, ["d1", "d2"], "left").drop("d1", "d2")


def minhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """Near-duplicate component of every document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * intersection >= percent * union of their
    sets of five-word shingles (ASCII letters lower-cased; a text of fewer words
    is one shingle).  component_id is the smallest doc_id reachable, kept says
    that the row is the one with that id.  One row per input row; repeated rows
    are linked like copies.  A null or empty text has no shingles and is linked
    with nothing: it is its own component.  A null id is never smallest; where
    all ids of a component are null, so is component_id, and these rows are
    kept.  Columns other than the two named are ignored.
    """
    out = near_duplicate_rows(docs, id_col, text_col, percent)
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """Keep one row of each component, with all its columns.

    That is the row of the smallest id (null last); of several rows with it the
    one of the smallest key, and of rows equal in id and text the first by
    its other columns as JSON, which may be of any type.  Rows without shingles
    are no duplicates: all stay, as often as they occur.  An empty table gives
    an empty table.
    """
    rows = near_duplicate_rows(docs, id_col, text_col, percent)
    first = rows.where("n > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "k1", "k2")).alias("r")).select("r.k1", "r.k2", F.lit(True).alias("_once"))
    keys = first.union(rows.where("n = 0").select("k1", "k2", F.lit(False)).distinct())
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    packed = docs.select(F.xxhash64(i, t).alias("k1"), F.xxhash64(t, i, F.lit(1)).alias("k2"), F.to_json(F.struct("*")).alias("_h"), F.struct("*").alias("_row"))
    one = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("_h"))
    return packed.join(keys, ["k1", "k2"]).withColumn("_n", one).where("not _once or _n = 1").select("_row.*")
