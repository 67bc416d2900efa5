import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textlode.functions import unicode as U
from textlode.operators import contamination as C
from textlode.operators import quality as Q
from textlode.operators import relations as R
from textlode.operators import retrieval as S


def test_contamination_both_ways(spark):
    rng = random.Random(3)
    words = [f"pal{i}" for i in range(50)]
    bank = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(2, 9)))) for i in range(40)] + [(90, "demasiado corto"), (91, "dospalabraslargas ydiferentes"), (92, None)]
    texts = [(k, " ".join(rng.choice(words) for _ in range(60)) + (f" XX{bank[k % 40][1].upper()}\n" if k % 3 == 0 else "") + (" unadospalabraslargas  ydiferentesx" if k % 7 == 0 else "")) for k in range(60)]
    t, b = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(bank, "item_id long, q string")
    norm = lambda s: " ".join(s.lower().split())
    want = sorted((k, i) for k, x in texts for i, q in bank if q and len(norm(q)) > 20 and norm(q) in norm(x))
    for small in (1000, 3):
        assert sorted(tuple(r) for r in C.contained(t, b, "doc_id", "text", "item_id", "q", small).collect()) == want
    rows = [("c1", "s", "PREGUNTA: x FRAGMENTO: y"), ("c2", "bad", "z"), ("c3", "s", "PREGUNTA: x"), ("c4", "s", "una DOSpalabraslargas ydiferentes")]
    chunks = spark.createDataFrame(rows, "chunk_id string, fuente string, texto string")
    queries = spark.createDataFrame([("q001", "dospalabraslargas ydiferentes")], "query_id string, text string")
    found = C.report(chunks, queries, ("bad",))
    assert {r.chunk_id: r.razones for r in found.collect()} == {"c1": ["marcadores_sospechosos(2)"], "c2": ["fuente_conocida_excluida"], "c4": ["contiene_texto_de_q001"]}
    assert [r.chunk_id for r in C.clean(chunks, found).collect()] == ["c3"]
    long = "x" * 30 + " y " + "z" * 60
    kinds = C.matches(spark.createDataFrame([(1, f"a, {long}!"), (2, long[:85] + " otra cosa"), (3, "nada")], "id long, t string"), spark.createDataFrame([("q", long)], "qid string, q string"), "id", "t", "qid", "q")
    assert sorted(tuple(r) for r in kinds.collect()) == [(1, "q", "exact"), (2, "q", "prefix")]


def brute_matches(texts, bank):
    out = []
    for k, x in texts:
        for i, q in bank:
            if x is None or q is None:
                continue
            begin = U.loose(q)[:80]
            if U.strict(q) in U.strict(x) or U.loose(q) in U.loose(x):
                out.append((k, i, "exact"))
            elif len(begin) >= 60 and begin in U.loose(x):
                out.append((k, i, "prefix"))
    return sorted(out, key=str)


def test_bank_matches_of_a_large_bank(spark):
    long = "Uno dos, trés cuatro—cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis"
    bank = [("a", long), ("b", "alfa beta gamma"), ("b", "alfa beta gamma"), ("c", "dos"), ("d", "fa be"), (None, "beta gamma delta"), ("e", None), ("f", " "), ("g", "x" * 30 + " y " + "z" * 60), ("h", "q" * 90), ("i", "a-b c"), ("j", "a b-c")]
    texts = [(1, f"... {long.upper()} ..."), (1, f"... {long.upper()} ..."), (2, long[:88] + "zz otra"), (3, "ALFA  beta\ngammas"), (None, "alfa beta gamma delta"), (4, None), (5, ""), (6, "x" * 30 + " y " + "z" * 55), (7, "q" * 95), (8, "xa b c"), (9, "a, b, c!"), (10, "a-b cd a b-cd")]
    t, b = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(bank, "item_id string, q string")
    want = brute_matches(texts, bank)
    assert {k for *_, k in want} == {"exact", "prefix"}
    for small in (1000, 3):
        assert sorted((tuple(r) for r in C.matches(t, b, "doc_id", "text", "item_id", "q", small).collect()), key=str) == want


def test_bank_matches_beyond_the_fixed_bound(spark):
    bank = [(i, f"pregunta numero n{i} del banco de evaluacion") for i in range(C.SMALL_BANK + 500)]
    texts = [(k, f"texto con {bank[k * 7][1]} dentro") for k in range(300)]
    found = C.matches(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(bank, "item_id long, q string"), "doc_id", "text", "item_id", "q")
    assert sorted(tuple(r) for r in found.collect()) == [(k, k * 7, "exact") for k in range(300)]


def test_ranking_ties_and_pools(spark):
    hits = spark.createDataFrame([("q", 1, "a", "d1", 0.5), ("q", 2, "b", "d2", 0.5), ("q", 3, "a", "d1", 0.7), ("q", 4, "c", "d2", 0.1)], "query_id string, position int, chunk_id string, doc_id string, score double")
    unique = S.dedupe_chunks(hits)
    assert sorted((r.chunk_id, r.score, r.first_pos) for r in unique.collect()) == [("a", 0.7, 1), ("b", 0.5, 2), ("c", 0.1, 4)]
    assert [(r.doc_id, r.score) for r in S.rank(S.pool_documents(unique), 2, ["query_id"], "first_pos").orderBy("rank").collect()] == [("d1", 0.7), ("d2", 0.5)]
    assert [(r.doc_id, r.score) for r in S.pool_documents(unique, "sum").orderBy("doc_id").collect()] == [("d1", 0.7), ("d2", 0.6)]
    with pytest.raises(ValueError):
        S.rank(unique, 0, ["query_id"], "first_pos")


def test_search_in_small_shards(spark, monkeypatch):
    rows = [(i, [float(i % 7), float(i % 3), 1.0]) for i in range(40)] + [(99, None), (98, [float("nan"), 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = sorted(map(tuple, S.search(df, df.where("vec_id % 10 = 0"), 5).collect()))
    monkeypatch.setattr(S, "SHARD_ROWS", 7)
    monkeypatch.setattr(S, "BLOCK_ROWS", 2)
    assert sorted(map(tuple, S.search(df, df.where("vec_id % 10 = 0"), 5).collect())) == one and len(one) == 20


def test_result_contract(spark):
    good = (["q001"], [(1, "a"), (2, "b"), (3, "c")], [(i, f"c{i}", "d", "t") for i in range(1, 11)])
    schema = "query_id string, documents array<struct<rank:int,doc_id:string>>, fragments array<struct<rank:int,chunk_id:string,doc_id:string,text:string>>"
    rows = [("q001", *good[1:]), ("x", *good[1:]), ("q002", good[1][:2], good[2]), ("q003", good[1], [(2, *f[1:]) for f in good[2]]), ("q004", good[1], [(*f[:3], "w " * 251) for f in good[2]]), ("q005", good[1], [(f[0], None, "d", "") for f in good[2]])]
    got = Q.failures(spark.createDataFrame(rows, schema), ["query_id"], Q.result_checks())
    assert sorted(tuple(r) for r in got.collect()) == [("q002", "documents"), ("q003", "fragments"), ("q004", "too_long"), ("q005", "fields"), ("x", "bad_query_id")]
    summary = {r.category: (r.n, len(r.examples)) for r in Q.counted_failures(got.union(got), ["query_id"], 1).collect()}
    assert summary["too_long"] == (2, 1)


def test_document_and_order_checks(spark):
    docs = spark.createDataFrame([("DOC-1", "x", "es"), ("2", " ", "zz"), (None, None, None)], "doc_id string, text string, lang string")
    got = Q.failures(docs, ["doc_id"], Q.document_checks("doc_id", "text", "lang", ("es",), "DOC-"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("2", "bad_prefix"), ("2", "empty_text"), ("2", "bad_language"), (None, "missing_id"), (None, "missing_text")], key=str)
    chunks = spark.createDataFrame([("d", 0), ("d", 2), ("e", 0)], "doc_id string, posicion int")
    assert [(r.doc_id, r.posicion, r.expected) for r in Q.position_gaps(chunks).collect()] == [("d", 2, 1)]


def test_judgments(spark):
    rows = [("a", r, g) for r, g in enumerate([3, 0, 0, 0, 0], 1)] + [("b", r, g) for r, g in enumerate([0, 0, 0, 3, 2], 1)] + [("c", r, 1) for r in range(1, 6)]
    per = Q.judged(spark.createDataFrame(rows, "query_id string, rank int, grade int"))
    assert {r.query_id: (r["class"], r.hit_1, r.hit_3, r.hit_5, r.reciprocal_rank) for r in per.collect()} == {"a": ("GOOD", 1, 1, 1, 1.0), "b": ("ACCEPTABLE", 0, 0, 1, 0.25), "c": ("BAD", 0, 0, 0, 0.0)}
    s = Q.judged_summary(per).first()
    assert (s.n_queries, s.hit_at_5, s.mrr, s.precision_at_5) == (3, 0.666667, 0.416667, 0.2)


def test_percentiles(spark):
    df = spark.range(1, 51).select(F.col("id").cast("double").alias("v"))
    assert Q.nearest_rank(df, "v").first().p95 == 48.0 and Q.distribution(df, "v").first().p95 == 47.55


def test_samples_batches_sets(spark):
    df = spark.range(10).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("n"))
    assert sorted(r.k for r in R.evenly_spaced(df, 4, ["k"]).collect()) == [0, 3, 6, 9] and R.evenly_spaced(df, 1, ["k"]).count() == 1 and R.evenly_spaced(df, 99, ["k"]).count() == 10
    batches = R.length_batches(df, 4, "n", "k")
    assert [r.k for r in batches.orderBy("position").collect()] == [0, 3, 6, 9, 1, 4, 7, 2, 5, 8]
    assert [(r.batch, r.rows, r.longest, r.padding) for r in R.padding(batches, "n").orderBy("batch").collect()] == [(0, 4, 2, 0), (1, 4, 4, 3), (2, 2, 4, 0)]
    old, new = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert sorted(map(tuple, R.upsert(old, new, "k").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    assert sorted(map(tuple, R.merge_incidents(old, new, F.col("k") == "a").collect())) == [("b", 1), ("b", 2), ("c", 2)]
    best = R.representatives(spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("y", 3, 1)], "g string, id int, m int"), ["g"], "m", "id", "id")
    assert sorted(map(tuple, best.collect())) == [("x", 1, 5), ("y", 3, 1)]


def test_identity(spark):
    df = spark.createDataFrame([(i, f"c{i}") for i in range(12)], "o int, v string").repartition(4)
    whole = hashlib.sha256("".join(f"c{i}\n" for i in range(12)).encode()).hexdigest().upper()
    assert R.identity_hash(df, "o", "v").first().sha256 == whole
    assert R.identity_hash(df, "o", "v", chunk=5).count() == 1
    a, b = (R.semantic_hash(x, ["v"], "o").first().sha256 for x in (df, df.withColumn("id", F.lit(1))))
    assert a == b


def test_identity_is_one_digest_at_every_size(spark, monkeypatch):
    df = spark.range(100_500).select((F.col("id") * 7919 % 100_500).alias("k"))
    want = hashlib.sha256("".join(f"{i}\n" for i in range(100_500)).encode()).hexdigest().upper()
    assert tuple(R.identity_hash(df.repartition(5), "k", "k").first()) == (100_500, 0, want)
    rows = [(2, "b"), (1, "z"), (1, "é"), (None, "n"), (3, None), (2, "b"), (4, "")]
    want = hashlib.sha256("n\nz\né\nb\nb\n\n".encode()).hexdigest().upper()
    odd = spark.createDataFrame(rows, "o int, v string")
    for chunk, size in ((100, 1 << 24), (2, 1 << 24), (100, 3)):
        monkeypatch.setattr(R, "SLICE_BYTES", size)
        assert tuple(R.identity_hash(odd.repartition(3), "o", "v", chunk).first()) == (7, 2, want)
    assert tuple(R.identity_hash(odd.where("false"), "o", "v").first()) == (0, 0, hashlib.sha256(b"\n").hexdigest().upper())


def test_few_queries_pass_over_the_vectors_and_many_meet_them_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, [float(rng.randrange(-3, 4)) for _ in range(5)]) for i in range(300)] + [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    asked = df.where("vec_id % 9 = 0")
    one = sorted(map(tuple, S.search(df, asked, 6).collect()))
    good = [(i, v) for i, v in rows if v and None not in v]
    want = []
    for q, a in good:
        if q % 9 == 0:
            got = sorted((-round(sum(x * y for x, y in zip(a, b, strict=True)), 6), i) for i, b in good if i != q)[:6]
            want += [(q, p, i, -s) for p, (s, i) in enumerate(got, 1)]
    assert sorted((r[0], r[3], r[1], r[2]) for r in one) == sorted(want)
    for name, value in (("FEW_QUERIES", 3), ("FEW_BYTES", 10)):
        with monkeypatch.context() as m:
            m.setattr(S, name, value)
            assert sorted(map(tuple, S.search(df, asked, 6).collect())) == one
    assert S.search(df, asked.where("false"), 6).count() == 0 and S.search(df.where("false"), asked, 6).count() == 0
