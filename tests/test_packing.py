import random

import pytest
from pyspark.sql import functions as F

from textlode.functions import text as T
from textlode.operators import packing as P


def counted(spark, units):
    df = spark.createDataFrame([(u,) for u in units], "u array<string>")
    return df.select(P.counted_units(F.col("u")).alias("units"))


def additive(units, most, overlap, prefix):
    """Groups first, then as much of the end of the group before as fits."""
    n = lambda us: prefix + sum(len(u.split()) for u in us)
    groups, run = [], []
    for u in units:
        if n([u]) > most:
            groups += [run] * bool(run) + [[u]]
            run = []
        elif run and n([*run, u]) > most:
            groups.append(run)
            run = [u]
        else:
            run.append(u)
    groups += [run] * bool(run)
    out = []
    for i, g in enumerate(groups):
        lead = []
        for u in reversed(groups[i - 1]) if i and overlap else ():
            if n([u, *lead]) > overlap:
                break
            lead = [u, *lead]
        while lead and n([*lead, *g]) > most:
            lead = lead[1:]
        out.append((" ".join([*lead, *g]), n([*lead, *g])))
    return out


def got(df, column):
    return [[(c.text, c.num_tokens) for c in r.c] for r in df.select(column.alias("c")).collect()]


def test_the_two_packers_differ_as_they_must(spark):
    units = [["a a a", "b b", "c c", "d d"]]
    df = counted(spark, units)
    assert [len(c) for c in got(df, P.pack_scalar(F.col("units"), 5, 3))] == [3]
    assert got(df, P.pack_additive(F.col("units"), 5, 3)) == [[("a a a b b", 5), ("c c d d", 4)]]
    assert P.pack_with_counter(units[0], lambda t: len(t.split()), 5, 3) == ["a a a b b", "b b c c", "c c d d"]


@pytest.mark.parametrize("most,overlap,prefix", [(8, 3, 0), (8, 0, 0), (12, 6, 2), (5, 4, 1)])
def test_random_units_against_brute_force(spark, most, overlap, prefix):
    rng = random.Random(most)
    docs = [[" ".join(rng.choice("xyz") for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(0, 25))] for _ in range(60)]
    df = counted(spark, docs)
    count = lambda t: prefix + len(t.split())
    assert got(df, P.pack_additive(F.col("units"), most, overlap, prefix)) == [additive(d, most, overlap, prefix) for d in docs]
    scalar = got(df, P.pack_scalar(F.col("units"), most, overlap, prefix))
    assert scalar == [[(t, count(t)) for t in P.pack_with_counter(d, count, most, overlap)] for d in docs]


def test_counter_packer_and_additivity(spark):
    df = spark.createDataFrame([(["ab", "cd", "ef"],), (None,)], "u array<string>")
    assert [r.c for r in df.select(P.counter_packer(len, 5, 2)("u").alias("c")).collect()] == [["ab cd", "cd ef"], None]
    assert P.is_additive(["a b", "c"], lambda t: len(t.split())) and not P.is_additive(["ab", "c"], len)
    with pytest.raises(ValueError):
        P.pack_with_counter([], len, 5, 5)


def test_chunks_are_the_same_in_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", P.counted_units(T.sentence_units(F.col("text"))).alias("units"))
    runs = [sorted(map(tuple, P.chunk_rows(docs.repartition(n), P.pack_additive(F.col("units"))).collect())) for n in (1, 4, 8)]
    assert runs[0] == runs[1] == runs[2] and runs[0][0][1].endswith("-chunk-0000")


class Letters:
    """One token per sign that is no space, and ``prefix`` for every text: adds up."""

    def __init__(self, prefix=2):
        self.prefix = prefix

    def count(self, text):
        return self.prefix + sum(not c.isspace() for c in text)

    def count_many(self, texts):
        return [self.count(t) for t in texts]


class Runs(Letters):
    """Equal neighbours across a join are one token less: does not add up."""

    def count(self, text):
        return super().count(text) - sum(a == b for a, b in zip(text.split(), text.split()[1:], strict=False))


@pytest.mark.parametrize("most,overlap", [(9, 4), (14, 7), (9, 0)])
def test_exact_packing_against_plain_versions(most, overlap):
    rng = random.Random(most + overlap)
    for _ in range(300):
        units = ["".join(rng.choice("xy") for _ in range(rng.randrange(1, 14))) for _ in range(rng.randrange(0, 25))]
        chunks, counts, held = P.pack_exact(units, Letters(), most, overlap)
        words = [" ".join(u) for u in units]  # a letter as a word: the plain version counts words
        assert held and [(c.replace(" ", ""), n) for c, n in zip(chunks, counts, strict=True)] == [(t.replace(" ", ""), n) for t, n in additive(words, most, overlap, 2)]
        repeats = [rng.choice("ab") for _ in range(30)]
        chunks, counts, held = P.pack_exact(repeats, Runs(), most, overlap)
        assert counts == Runs().count_many(chunks) and (held or chunks == P.pack_with_counter(repeats, Runs().count, most, overlap))


def test_exact_packing_as_a_column(spark):
    import public_tokenizers

    from textlode.functions.tokens import FileCounter

    counter = FileCounter(public_tokenizers.path("word_bpe_49k.json"))
    docs = [["Uno dos tres.", "Cuatro cinco seis siete.", "Ocho."], [], None]
    got = [r.e for r in spark.createDataFrame([(d,) for d in docs], "u array<string>").select(P.exact_chunks(F.col("u"), counter, 16, 8).alias("e")).collect()]
    assert got[2] is None and got[1].chunks == [] and got[0].units == counter.count_many(docs[0])
    assert [(c.text, c.num_tokens) for c in got[0].chunks] == [*zip(*P.pack_exact(docs[0], counter, 16, 8)[:2], strict=True)]
    assert all(c.num_tokens == counter.count(c.text) for c in got[0].chunks)
