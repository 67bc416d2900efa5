import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlode.llm import _blocks as B
from textlode.llm import kd_search as KD
from textlode.llm import onebit_search as OB

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def usable(v, zero_ok):
    return v and all(x is not None and math.isfinite(x) for x in v) and (zero_ok or any(v))


def brute(rows, is_query, k, score, zero_ok=True):
    rows = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v, *_ in rows if i is not None and usable(v, zero_ok)]
    out = []
    for q in sorted({i for i, _ in rows if is_query(i)}):
        own = next(v for i, v in rows if i == q)
        got = sorted(((-score(own, v), i) for i, v in rows if i != q and len(v) == len(own)))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(got)]
    return out


def integer(a, b):
    return int(np.floor(a * 256).astype(np.int64) @ np.floor(b * 256).astype(np.int64))


def sample(n=700, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    v = centre[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.5
    return [(int(i), [float(x) for x in r], 1, "s") for i, r in enumerate((v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32))]


ODD = [
    (1000, None, 1, "a"), (1050, [], 1, "a"), (1100, [1.0, None, 2.0], 1, "a"), (1150, [float("nan")] * 24, 1, "a"), (1200, [float("inf")] + [0.0] * 23, 1, "a"),
    (None, [0.1] * 24, 1, "a"), (1250, [0.0] * 24, 1, "a"), (1300, [0.5, -0.5], 1, "a"), (1301, [0.5, 0.25], 1, "a"), (1350, [1.0], 1, "a"), (1400, [-3.5] * 24, 1, "a"),
]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(B, "SHARD_ROWS", 90)
    monkeypatch.setattr(B, "BLOCK_ROWS", 7)
    monkeypatch.setattr(KD, "LEAF", 8)


def test_kd_trees_are_exact(spark, small_blocks):
    rows = sample() + ODD + [(2000 + i, [0.125] * 24, 1, "same") for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in KD.kd_top_k(df, F.col("vec_id") % 50 == 0, k=5).collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 5, integer)


def test_kd_large_components_stay_exact(spark):
    rows = [(i, [float(10**6 * (i + 1)), float(-(10**6)) * i + 0.5], 1, "x") for i in range(9)]
    got = sorted(tuple(r) for r in KD.kd_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 2 == 0, k=3).collect())
    assert got == brute(rows, lambda i: i % 2 == 0, 3, integer)


def test_tree_boxes_are_tight_and_bounds_hold():
    rows = np.floor(np.random.default_rng(1).normal(size=(500, 8)) * 256)
    order, t = KD.build_tree(rows, 16)
    assert sorted(order) == list(range(500))
    q = np.arange(8.0) - 4
    for n in range(len(t["start"])):
        part = rows[order[t["start"][n] : t["stop"][n]]]
        assert (part.min(0) == t["low"][n]).all() and (part.max(0) == t["high"][n]).all()
        assert (part @ q).max() <= (np.maximum(q, 0) @ t["high"][n] + np.minimum(q, 0) @ t["low"][n])


def recall(got, want):
    pairs = {(q, v) for q, _, v, _ in got}
    return np.mean([(q, v) in pairs for q, _, v, _ in want])


def test_onebit_recall_and_exact_scores(spark, small_blocks):
    rows = sample(900, 32, 3) + [(i, v and v + [0.0] * (32 - len(v)) if v and len(v) == 24 else v, a, b) for i, v, a, b in ODD]
    df = spark.createDataFrame(rows, SCHEMA)
    dot = lambda a, b: float(a @ b)
    got = [tuple(r) for r in OB.onebit_top_k(df, F.col("vec_id") % 20 == 0, k=10).collect()]
    want = brute(rows, lambda i: i % 20 == 0, 10, dot, zero_ok=False)
    assert recall(got, want) >= 0.95
    vectors = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v, *_ in rows if v and None not in v}
    for q, _, v, s in got:
        assert abs(s - vectors[q] @ vectors[v]) < 1e-12
    assert {q for q, *_ in got} == {q for q, *_ in want} and len(got) == len(want)


def test_onebit_estimates_lie_within_their_bounds():
    rng = np.random.default_rng(5)
    rows, queries = rng.normal(size=(2000, 64)), rng.normal(size=(50, 64))
    about, error = OB.estimate(OB.encode(rows), queries)
    off = np.abs(about - queries @ rows.T) / (error[None, :] * np.linalg.norm(queries, axis=1)[:, None])
    assert (off <= OB.EPSILON).mean() > 0.99
    assert abs((about - queries @ rows.T).mean()) < 0.1


@pytest.mark.parametrize("search", [KD.kd_top_k, OB.onebit_top_k])
def test_empty_and_single(spark, search):
    assert search(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    assert search(spark.createDataFrame([(0, [1.0], 1, "x")], SCHEMA), F.lit(True)).count() == 0


def test_queries_on_whole_table(spark):
    from textlode.llm.queries import op5_kd_top_k, op6_onebit_search

    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in op5_kd_top_k(spark, d).collect()) == brute(rows, lambda i: i % 50 == 0, 5, integer)
    got = [tuple(r) for r in op6_onebit_search(spark, d).collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20, lambda a, b: float(a @ b), zero_ok=False)
    assert len(got) == len(want) and recall(got, want) >= 0.95


def test_the_query_of_a_repeated_id_is_the_least_vector_in_any_order(spark):
    rows = sample(60, 8, 2)
    rows += [(0, [2.0] * 8, 9, "z"), (0, [-2.0] + [1.0] * 7, 9, "z"), (7, [3.0] * 8, 9, "z"), (7, [3.0] * 8, 9, "z")]
    for search in (KD.kd_top_k, OB.onebit_top_k):
        a, b = (sorted(tuple(r) for r in search(spark.createDataFrame(x, SCHEMA), F.col("vec_id") == 0, k=3).collect()) for x in (rows, rows[::-1]))
        assert a == b and len(a) == 3
    least = np.array([-2.0] + [1.0] * 7)
    assert [r.vec_id for r in KD.kd_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, k=2).orderBy("rank").collect()] == [7, 7]
    want = max((float(np.array(v) @ least), -i) for i, v, *_ in rows if i != 0)[0]
    assert abs(OB.onebit_top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, k=1).first().score - want) < 1e-6


def test_vectors_that_many_rows_share_fill_several_shards(spark, small_blocks):
    rows = [(i, [1.0, 2.0, 3.0], 1, "same") for i in range(400)] + [(400 + i, [float(i % 7), 1.0, 0.0], 1, "x") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in KD.kd_top_k(df, F.col("vec_id") % 50 == 0, k=5).collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 5, integer)


def test_splits_place_every_row_and_clusters_are_not_opened():
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(16, 12)) * 4
    rows = np.floor((centre[np.arange(4096) % 16] + rng.normal(size=(4096, 12)) * 0.1) * 256)
    nodes = B._split(rows, 4)
    assert len(nodes) == 15
    assert KD.opened_share(rows, rows[::64], 5, leaf=64) < 0.2
    even = rng.normal(size=(2000, 64))
    assert KD.opened_share(np.floor(even * 256), np.floor(even[:20] * 256), 5, leaf=64) > 0.9


def test_population_counts_equal_the_products_of_signs():
    rng = np.random.default_rng(9)
    for dim in (1, 8, 64, 65, 200):
        rows, queries = rng.normal(size=(50, dim)), rng.normal(size=(6, dim))
        index, asked = OB.encode(rows), OB.Asked(queries)
        signs = np.where((rows - index["mean"]) @ OB.rotation(dim).T > 0, 1.0, -1.0)
        number = sum(np.unpackbits(p.view(np.uint8), axis=1)[:, :dim].astype(float) * 2**b for b, p in enumerate(asked.planes))
        rounded = asked.low[:, None] + asked.step[:, None] * number
        want = (queries @ index["mean"])[:, None] + rounded @ signs.T / np.sqrt(dim) * index["factor"]
        assert np.allclose(OB.estimate(index, queries)[0], want, atol=1e-3)
        assert np.abs(rounded - queries @ OB.rotation(dim).T).max() <= asked.step.max() / 2 + 1e-9


def test_at_most_35_percent_are_scored_exactly():
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    x, ids = np.array(t.column("embedding").to_pylist(), dtype=np.float64), t.column("vec_id").to_numpy()
    q = ids % 20 == 0
    results, scored = OB.search_codes([(ids, OB.encode(x))], lambda n: x, ids[q], x[q], 20, OB.REACH)
    score = x[q] @ x.T
    score[ids[q][:, None] == ids[None, :]] = -np.inf
    hits = [len(set(r[0]) & set(ids[np.argsort(-s)[:20]])) for r, s in zip(results, score, strict=True)]
    assert np.mean(hits) / 20 >= 0.95 and scored <= 0.35 * q.sum() * len(ids)


def test_long_vectors_make_small_shards(spark, monkeypatch):
    assert [B.shard_rows(d) for d in (1, 64, 1024, 10**9)] == [8192, 8192, 4096, 1]
    monkeypatch.setattr(B, "SHARD_BYTES", 8 * 24 * 50)
    rows = sample(300)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in KD.kd_top_k(df, F.col("vec_id") % 50 == 0, k=5).collect()) == brute(rows, lambda i: i % 50 == 0, 5, integer)
