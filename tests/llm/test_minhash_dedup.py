import random
import re
from itertools import combinations

import numpy as np

from textlode.llm import minhash_dedup as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    """Components over all pairs, found through shared shingles."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for a, b in {p for h in holders.values() for p in combinations(h, 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    out = []
    for i, (k, _) in enumerate(rows):
        c = least.get(root(i)) if sets[i] else k
        out.append((k, len(sets[i]), c, k == c))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in M.minhash_components(df).collect()), key=str)


def test_edge_cases_against_brute_force(spark):
    base = [f"v{i}" for i in range(200)]
    rows = [(1, None), (2, ""), (3, "  "), (4, "one two"), (5, "ONE two"), (6, "one two three four five"), (None, "one two"), (7, "é É x")]
    rng = random.Random(5)
    for k in range(60):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            w[rng.randrange(200)] = f"n{rng.random()}"
        rows.append((100 + k, " ".join(w)))
    rows += [(100, rows[8][1]), (900, "b " * 40), (901, "B\tb " * 40), (None, None), (902, " ".join(f"k{i % 7000}" for i in range(30000)))]
    assert run(spark, rows) == brute(rows)


def test_chains_link_through_documents_that_are_not_leaders(spark):
    words = [f"c{i}" for i in range(400)]
    rows = [(500 - k, " ".join(words[3 * k : 3 * k + 100])) for k in range(90)]
    assert run(spark, rows) == brute(rows)


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    words = [f"c{i}" for i in range(400)]
    rows = [(500 - k, " ".join(words[3 * k : 3 * k + 100])) for k in range(60)]
    monkeypatch.setattr(M, "BLOCK_ITEMS", 300)
    assert run(spark, rows) == brute(rows)


def test_bands_lose_one_pair_in_a_million_at_most():
    assert [M.band_rows(t) for t in (0.85, 0.8)] == [5, 4]
    for percent in range(40, 101):
        r = M.band_rows(percent / 100)
        assert M.SAMPLES % r == 0 and (1 - (percent / 100) ** r) ** (M.SAMPLES // r) <= 1e-6


def test_empty_table(spark):
    assert run(spark, []) == []


def test_odd_sketch_estimates_differences():
    rng = np.random.default_rng(1)
    far = {}
    for j in (0.95, 0.85, 0.3):
        got = []
        for _ in range(40):
            n = 400
            shared = round(2 * n * j / (1 + j))
            common = rng.integers(0, 2**63, shared).astype(np.uint64)
            a, b = (np.concatenate((common, rng.integers(0, 2**63, n - shared).astype(np.uint64))) for _ in "ab")
            _, s = M.bands_and_sketches(np.stack([M.minhash(a), M.minhash(b)]))
            got.append(int(np.bitwise_count(s[0] ^ s[1]).sum()))
        far[j] = got
    assert np.mean(far[0.95]) < np.mean(far[0.85]) < np.mean(far[0.3])
    assert max(far[0.85]) <= M.sketch_limit(0.85) < np.mean(far[0.3])


def test_query_against_brute_force_on_whole_table(spark):
    from textlode.llm.queries import op3_minhash_near_dedup

    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op3_minhash_near_dedup(spark, d).collect()), key=str) == brute(rows)


def test_rows_are_kept_whole_with_any_columns(spark):
    df = spark.createDataFrame([(2, "a b c d e f", "x", 1), (1, "A b c d e f", "y", 2), (3, None, "z", 3), (1, "A b c d e f", "y", 2)], "doc_id long, text string, n string, root int")
    assert sorted(tuple(r) for r in M.drop_near_duplicates(df).collect()) == [(1, "A b c d e f", "y", 2), (3, None, "z", 3)]


def thue_morse(n, a, b):
    """A word over two letters and, with them swapped, its complement: equal under polynomial hashes modulo 2**64."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join(b if x else a for x in bits)


def test_words_that_polynomial_hashes_confuse_are_kept_apart(spark):
    one, two = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    rest = " ".join(f"w{i}" for i in range(30))
    rows = [(1, one), (2, two), (3, f"{one} {rest}"), (4, f"{two} {rest}"), (5, " ".join([one, two] * 3)), (6, " ".join([two, one] * 3))]
    assert run(spark, rows) == brute(rows)


def test_any_seed_gives_the_same_components(spark):
    rng = random.Random(3)
    base = [f"v{i}" for i in range(80)]
    rows = [(k, " ".join(w if rng.random() > 0.01 else f"n{k}" for w in base)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted((r.doc_id, r.component_id) for r in M.near_duplicate_rows(df, seed=s).select("doc_id", "component_id").collect()) for s in (0, 1, 12345)]
    assert got[0] == got[1] == got[2] == sorted((k, c) for k, _, c, _ in brute(rows))
