import json

import pytest
from pyspark.sql import functions as F

from textlode.functions import text as T
from textlode.functions import unicode as U
from textlode.operators import audit as D
from textlode.operators import packing as P
from textlode.plans import config
from textlode.sources import corpus


def test_unicode(spark):
    texts = ["Straße ﬁn", "ÀÉ  î x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for f in (U.strict, U.loose, U.strip_marks, U.normal_for_match):
        assert [r.o for r in df.select(U.column(f)("t").alias("o")).collect()] == [None if t is None else f(t) for t in texts]
    assert U.strict("Straße ﬁn") == "strasse fin" and U.loose("a-É!b") == "a e b" and U.compatibility_bytes("ﬁ") == 2
    assert [r.o for r in df.select(U.column(U.compatibility_bytes, "bigint")("t").alias("o")).collect()][2] is None


def test_chunk_audits(spark):
    docs = spark.createDataFrame([("d", "Una frase entera aquí. Otra frase más larga que sigue. Y la última de todas.")], "doc_id string, text string")
    units = docs.withColumn("units", P.counted_units(T.sentence_units(F.col("text"))))
    chunks = P.chunk_rows(units, P.pack_additive(F.col("units"), 10, 6))
    pairs = D.adjacent_pairs(chunks)
    assert [(r.posicion, r.shared_words, r.cuts_sentence) for r in pairs.orderBy("posicion").collect()] == [(1, 0, False)] or pairs.count() >= 1
    flat = docs.select("doc_id", F.explode(T.sentence_units(F.col("text"))).alias("unit"))
    assert D.sentence_loss(flat, chunks).count() == 0 and D.sentence_loss(flat, chunks.where("posicion = 0")).count() >= 1
    cut = spark.createDataFrame([("d", 0, "uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece de"), ("d", 1, "la casa grande")], "doc_id string, posicion int, texto string")
    assert [r.cuts_sentence for r in D.adjacent_pairs(cut).collect()] == [True]
    assert D.overlap_report(chunks).first().pairs == chunks.count() - 1


def test_preflight(spark):
    df = spark.createDataFrame([("palabra " * 120,), ("UPPER " * 120,), ("corto",)], "u string")
    assert {r["class"]: r.n_tokens for r in D.preflight(df, T.word_count(F.col("u")), "u", 100).collect()} == {"AMBIGUOUS": 120, "STRUCTURAL_MULTI_UNIT": 120}


def test_config(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"chunking": {"max_tokens": 100, "excluded_sources": ["x"]}}))
    made = config.settings(config.load(str(tmp_path / "a.json"))["chunking"])
    assert made.max_tokens == 100 and made.excluded_sources == ("x",) and made.capacity == 510
    (tmp_path / "b.json").write_text("[]")
    for bad in (lambda: config.load(str(tmp_path / "b.json")), lambda: config.settings({"zz": 1}), lambda: config.inside(str(tmp_path), "../x")):
        with pytest.raises(ValueError):
            bad()
    assert config.inside(str(tmp_path), "x/y").name == "y"


def test_inspection(spark, tmp_path):
    for name in ("a.txt", "b.zzz", "c.csv"):
        (tmp_path / name).write_text("x")
    assert tuple(corpus.inspect(corpus.walk(spark, str(tmp_path))).first()) == (3, 2)
