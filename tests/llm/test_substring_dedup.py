import hashlib
import random
import re
from collections import Counter

import pytest

from textlode.llm import substring_dedup as S
from textlode.llm.substring_dedup import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (k, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), kept))
    return sorted(out, key=str)


def run(spark, rows, window):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup(df, window=window).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    return sorted([tuple(r) for r in got], key=str)


def test_edge_cases_against_brute_force(spark):
    a = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, a), (5, "x y " + a[: len(a) // 2] + " tail word é"), (None, a), (4, a), (None, None),
        (6, "z " * 90), (7, "q\x0bw\x0ce\rr " * 20), (8, " ".join(f"u{i}" for i in range(5000))), (9, "w3 w4 w5"), (10, "\x00 \x1f b"),
    ]
    for window in (1, 2, 7, 35):
        assert run(spark, rows, window) == brute(rows, window)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, n_words string, hits int")
    out = substring_dedup(df)
    assert out.columns == ["doc_id", "text", "hits", "n_words", "n_removed", "kept_text"] and out.count() == 0
    df = spark.createDataFrame([(1, "a b", "x", 3)], "doc_id long, text string, n_words string, hits int")
    assert substring_dedup(df).first().n_words == 2


def test_query_against_brute_force_on_whole_table(spark):
    from textlode.llm.queries import op1_substring_dedup

    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in brute(rows, 35))
    assert sorted(tuple(r) for r in op1_substring_dedup(spark, d).collect()) == want


def test_words_that_polynomial_hashes_confuse_are_kept(spark):
    from .test_minhash_dedup import thue_morse

    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(k, f"{thue_morse(1024, *ab)} {rest}") for k, ab in enumerate(("ab", "ba", "cd"))]
    assert run(spark, rows, 35) == brute(rows, 35) and all(r[2] == 0 for r in run(spark, rows, 35))


@pytest.mark.parametrize("window", [1, 2, 3, 7, 16, 64, 101])
def test_levels_of_any_window(spark, window):
    lengths = S.levels(window)
    assert lengths[-1] == window and all(b <= 2 * a or b == window for a, b in zip(lengths, lengths[1:], strict=False))
    rng = random.Random(window)
    passage = [f"p{i}" for i in range(window + 9)]
    rows = []
    for k in range(40):
        words = [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(0, 3 * window + 20))]
        if k % 3 == 0:
            at, n = rng.randrange(len(words) + 1), rng.randrange(max(1, window - 1), window + 9)
            words[at:at] = passage[:n]
        rows.append((k, " ".join(words)))
    assert run(spark, rows, window) == brute(rows, window)
