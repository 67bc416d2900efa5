import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P

from . import test_minhash_dedup, test_substring_dedup
from .test_mixing import WORD, brute_targets

D = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return sorted((tuple(r) for r in df.select(P.COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage but the last returns, from the whole table on."""
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), []
    out.append(rows(docs))
    for _, stage in P.STAGES[:-1]:
        out.append(rows(stage(spark, spark.createDataFrame(out[-1], SCHEMA), D)))
    return out


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages[0], stages[1]
    assert not Counter(after) - Counter(before)
    lost = Counter(before) - Counter(after)
    assert len(list(lost.elements())) <= 0.01 * len(before)
    assert all(any(c.isalpha() for c in r[1]) for r in after)


def test_near_duplicate_stage_keeps_one_of_each_component(stages):
    want = {k for k, *_, kept in test_minhash_dedup.brute([r[:2] for r in stages[1]]) if kept}
    assert sorted(stages[2]) == sorted(r for r in stages[1] if r[0] in want)


def test_near_duplicate_stage_links_from_080_on(spark):
    rng = np.random.default_rng(7)
    data = []
    for k in range(150):
        words = [f"w{k}x{i}" for i in range(104)]  # 100 shingles
        data.append((10 * k, " ".join(words), "en", "s", 1))
        for c, m in enumerate(([20, 60], [20, 22, 60], [20, 24, 60], [int(rng.integers(10, 90))])):
            other = list(words)
            for i in m:
                other[i] = f"n{k}x{c}x{i}"
            data.append((10 * k + 1 + c, " ".join(other), "en", "s", 1))
    a, b = (test_minhash_dedup.shingles(data[i][1]) for i in (0, 1))
    assert (len(a & b), len(a | b)) == (90, 110)
    rows_in = [r[:2] for r in data]
    want, narrow = ({k for k, *_, kept in test_minhash_dedup.brute(rows_in, p) if kept} for p in (80, 85))
    got = {r[0] for r in rows(P.near_duplicates(spark, spark.createDataFrame(data, SCHEMA), D))}
    assert got == want and len(want) < len(narrow)


def test_near_duplicate_stage_on_the_table(spark, stages):
    want = {k for k, *_, kept in test_minhash_dedup.brute([r[:2] for r in stages[1]], 80) if kept}
    assert sorted(stages[2]) == sorted(r for r in stages[1] if r[0] in want)


def test_substring_stage(stages):
    cut = {k: (n, kept) for k, _, n, kept in test_substring_dedup.brute([r[:2] for r in stages[2]], 35)}
    want = []
    for k, t, lang, source, n in stages[2]:
        text = cut[k][1] if cut[k][0] else t
        want.append((k, text, lang, source, len(text)))
    assert stages[3] == sorted(want, key=str)


def test_mixing_stage_reaches_the_targets(stages):
    sizes = {}
    for r in stages[3]:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1]))
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    for r in stages[4]:
        taken[r[3]] += len(WORD.findall(r[1]))
    most = max(len(WORD.findall(r[1])) for r in stages[3])
    assert all(abs(taken[s] - want[s]) <= 2 * most for s in want)
    assert max(Counter(r[0] for r in stages[4]).values()) <= 3 and set(stages[4]) <= set(stages[3])


def test_run_gives_the_tokens_of_the_last_stage(spark, stages):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for k, t, _, source, _ in stages[4]:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((k, source, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in P.run(spark, D).collect()), key=str) == sorted(want, key=str)


def test_stages_take_nulls_repeats_and_empty_tables(spark):
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "the and of it", "en", "s", 3), (2, "", "en", None, 0), (3, "a b c d e f", "en", "s", 1), (3, "a b c d e f", "en", "s", 1), (3, "another text here", None, "s", 1), (4, "A b c d e f", "en", "t", 1)]
    for data in ([], odd):
        docs = spark.createDataFrame(data, SCHEMA)
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs.withColumn("extra", F.lit(1)), D)
            assert out.columns[:5] == P.COLUMNS, name
            out.collect()
        assert P.STAGES[-1][1](spark, docs, D).count() == len(data)
    kept = rows(P.near_duplicates(spark, spark.createDataFrame(odd, SCHEMA), D))
    assert Counter(r[0] for r in kept) == Counter({1: 2, 2: 1, 3: 2, None: 1})
