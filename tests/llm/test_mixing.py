import re
from collections import defaultdict

import duckdb
import pytest

from textlode.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share, cut what is above the cap, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        got = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if got[s] > cap * sizes[s]]
        if not above:
            return fixed | got
        fixed |= {s: cap * sizes[s] for s in above}


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return mixing.mix_sources(df, **kw).collect()


def test_targets_and_taken_words(spark):
    rows = []
    for k in range(600):
        source = [None, "a", "b", "é", "z", "", "𝒳"][k % 7] if k % 3 else "hot"
        rows.append((k, "w " * (k * 7919 % 211), source))
    rows += [(1, "w w", "hot"), (None, None, None), (None, None, "only-null"), (700, "", "a"), (701, "x\x0by\x1fz  q", "tiny")]
    got = run(spark, rows)
    assert sorted(((r.doc_id, r.size, r.source) for r in got), key=str) == sorted(((k, len(WORD.findall(t or "")), s) for k, t, s in rows), key=str)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6
    for s, n in taken.items():
        assert abs(n - want[s]) <= 2 * largest[s]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(run(spark, rows), key=key)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (1, "", "a")], [(1, "a b", "s")]])
def test_small_tables(spark, rows):
    got = run(spark, rows)
    assert len(got) == len(rows)
    assert sum(r.taken for r in got) == sum(r.size for r in got)


def test_copies_follow_the_rate_in_any_partitioning(spark):
    df = spark.createDataFrame([(k, "w " * (k % 50), "ab"[k % 2]) for k in range(500)], "doc_id long, text string, source string")
    a, b = (sorted(tuple(r) for r in mixing.mix_sources(df.repartition(n)).select("doc_id", "copies").collect()) for n in (1, 7))
    assert a == b


def test_query_matches_its_sql(spark):
    from textlode.llm.queries import op9_mixing

    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    assert sorted(tuple(r) for r in op9_mixing(spark, d).collect()) == sorted(con.sql(mixing.ORACLE).fetchall())


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "s", "x", 9, 7)], "doc_id long, text string, source string, size string, rank int, copies int")
    out = mixing.mix_sources(df)
    assert out.columns == ["doc_id", "text", "source", "rank", "size", "source_size", "target", "copies", "taken"]
    assert tuple(out.select("rank", "size", "copies").first()) == (9, 2, 1)
