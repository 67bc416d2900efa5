"""What audits of chunks cost: each text is cut, packed and scored once, however long it is."""

import random
import re
import time

from pyspark.sql import functions as F

from textlode.functions import text as T
from textlode.operators import audit as D
from textlode.operators import packing as P
from textlode.operators import quality as Q
from textlode.plans import catalog

D1 = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_corpus_quality_makes_chunks_twice_and_joins_no_sentences(spark):
    made = plan(catalog.queries()["corpus_quality"](spark, D1))
    assert made.count("posexplode(") == 2 and made.count("Join ") == 2  # chunks of neighbours and of kept sentences; documents with both


def test_overlap_report_makes_chunks_once(spark):
    made = plan(catalog.queries()["overlap_report"](spark, D1))
    assert made.count("posexplode(") == 1 and "Join " not in made


def test_adjacent_audit_compares_few_runs(spark):
    made = plan(catalog.queries()["adjacent_audit"](spark, D1))
    assert made.count(r"[^\s\x1c-\x1f]+, 0)") == 3  # words of a chunk, of the one before, and the count of a unit
    rng, rows = random.Random(3), []
    for _ in range(200):
        a, b = ([rng.choice("xy") for _ in range(rng.randrange(0, 12))] for _ in range(2))
        rows.append((" ".join(a), " ".join(b), next((n for n in range(min(len(a), len(b), 5), 0, -1) if a[-n:] == b[:n]), 0)))
    rows += [("x " * 300, "x " * 300, 5), (None, "x", 0), ("x", None, 0)]
    df = spark.createDataFrame(rows, "l string, r string, n int")
    assert [r for r in df.select("n", T.word_overlap(F.col("l"), F.col("r"), 5).alias("o")).collect() if r.n != r.o] == []


def test_sentence_loss_joins_nothing_and_counts_rows_of_null_id(spark):
    units = spark.createDataFrame([("d", "Uno."), ("d", "Uno."), ("d", "Dos."), (None, "Tres."), (None, "Ya.")], "doc_id string, unit string")
    chunks = spark.createDataFrame([("d", "Uno. Dos."), ("d", "Dos. Nunca."), (None, "Tres.")], "doc_id string, texto string")
    lost = D.sentence_loss(units, chunks)
    assert sorted(map(tuple, lost.collect()), key=str) == [("d", "Uno.", 2, 1), (None, "Ya.", 1, 1)]
    assert "Join " not in plan(lost)


def test_language_score_cuts_a_text_once(spark):
    made = plan(catalog.queries()["language_score"](spark, D1))
    assert made.count("regexp_extract_all(") == 1 and made.count("lower(") == 1


def test_language_score_reads_a_text_up_to_the_third_pattern(spark):
    made = plan(catalog.queries()["language_score"](spark, D1))
    assert "regexp_replace(" not in made and made.count("filter(regexp_extract_all(") == 1  # no spaces made single; marker words are picked out once
    parts, rng = ("th", "dad", "aa", "ñ", "ción", "'s"), random.Random(4)
    texts = ["".join(rng.choice(["th", "da", "d", "a", "ñ", "ci", "ó", "ón", "'", "s", " ", "\n"]) for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    got = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", *[T.few_occurrences(F.col("t"), p, 3).alias(f"p{i}") for i, p in enumerate(parts)]).collect()
    assert [tuple(r) for r in got] == [(t, *(float(min((t or "").count(p), 3)) for p in parts)) for t in [*texts, None]]


def test_language_scores_find_patterns_with_spaces(spark):
    markers = {"es": {"common_words": ["uno"], "distinctive_words": ["dos"], "patterns": ["o d", "ñ", "é "]}}
    texts = ["UNO\n\tdos", "uno  dos  uno dos", " Ñandú é  x é\u00a0y", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.language_scores(F.col("t"), markers).es.alias("s")).collect()
    assert [r.s for r in got] == [0.5 + 2 + 1.5, 1 + 4 + 3, 1.5 + 3, 0.0]


def test_language_report_cuts_a_text_once(spark):
    made = plan(catalog.queries()["language_report"](spark, D1))
    assert made.count("regexp_extract_all(") == 1 and made.count("lower(") == 1


def test_chunk_violations_makes_chunks_once(spark):
    made = plan(catalog.queries()["chunk_violations"](spark, D1))
    assert made.count("posexplode(") == 1 and "Union" not in made
    rows = [("a", 0, "a-chunk-0000", 3, "x y z"), ("a", 2, "a-chunk-0002", 0, " "), ("b", 0, "z", 600, "x"), ("b", 1, "b-chunk-0001", None, None)]
    chunks = spark.createDataFrame(rows, "doc_id string, posicion int, chunk_id string, num_tokens int, texto string")
    gaps = Q.position_gaps(chunks).select("chunk_id", F.lit("position").alias("category"))
    want = Q.failures(chunks, ["chunk_id"], Q.chunk_checks()).union(gaps)
    assert sorted(map(tuple, Q.chunk_failures(chunks).collect())) == sorted(map(tuple, want.collect())) and want.count() == 6


def test_chunk_violations_counts_no_words_of_chunks_and_strips_ends_only(spark):
    made = plan(catalog.queries()["chunk_violations"](spark, D1))
    assert made.count("regexp_extract_all(") == 1 and "substring(" not in made  # the count of a unit; no look at the ends of a text
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab.!…é!\u00a0 \n\t\x1c\x85\u2003\u200b\U0001f600") for _ in range(rng.randrange(0, 30))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in [*texts, "", " ", ". ", " .\n"]], "t string")
    for r in df.select("t", T.word_count(F.col("t")).alias("n"), T.words(F.col("t")).alias("w"), T.is_blank(F.col("t")).alias("b"), T.sentence_units(F.col("t")).alias("u")).collect():
        assert (r.n, r.w, r.b) == (len(r.t.split()), r.t.split(), not r.t.split())
        assert r.u == [u for u in re.split(r"(?<=[.!?…])\s+", r.t.strip()) if u]
    assert spark.range(1).select(T.is_blank(F.lit(None).cast("string")).alias("b")).first().b


def test_a_long_document_is_packed_in_seconds(spark):
    unit = lambda i: F.struct(F.concat(F.lit("w"), i.cast("string")).alias("t"), (i % 19 + 1).cast("int").alias("n"))
    long = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(4000)), unit).alias("units"))
    start = time.monotonic()
    got = [long.select(F.size(f(F.col("units"))).alias("n")).first().n for f in (P.pack_additive, P.pack_scalar)]
    assert got == [158, 176] and time.monotonic() - start < 30
