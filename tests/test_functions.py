import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textlode.functions import text as T
from textlode.functions import vectors as V


def column(spark, values, f, kind="string"):
    return [r.o for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v")).alias("o")).collect()]


def clean(t):
    t = t.replace("\r\n", "\n").replace("\r", "\n").replace("\t", " ")
    t = "".join(c for c in t if c == "\n" or c.isprintable())
    t = re.sub(r"\n{3,}", "\n\n", re.sub(" *\n *", "\n", re.sub(r"[^\S\n]+", " ", t)))
    return t.strip()


def test_clean_text(spark):
    rng = random.Random(1)
    texts = [" Uno\t dos \r\n\r\n\r\n tres\x00 ", "", "a b​c d", *("".join(rng.choice("ab \n\r\t\x07 é　.") for _ in range(60)) for _ in range(80))]
    assert column(spark, texts, T.clean_text) == [clean(t) for t in texts]
    assert column(spark, texts[:1], T.clean_text) == ["Uno dos\n\ntres"]


def test_words_and_counts(spark):
    texts = ["a b c\x1cd", "", "  x  ", "\n", "uno,dos"]
    assert column(spark, texts, T.word_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, lambda c: T.word_count(F.nullif(c, c))) == [0] * 5


def test_paths(spark):
    paths = ["F1_a/x.PDF", "b/f3_z/y.jpeg", "c/noF2_/z", "a/F2_/k.htm"]
    assert column(spark, paths, T.phenomenon) == [1, 3, None, 2]
    assert column(spark, paths, lambda c: T.format_name(T.suffix(c))) == ["pdf", "imagen", "", "html"]


def test_urls(spark):
    texts = ["https://a.b/c.", "see https://a.b/c, and http://z (http://z);", "https://a.b/c d", ""]
    assert column(spark, texts, T.urls) == [["https://a.b/c"], ["http://z", "https://a.b/c"], ["https://a.b/c"], []]
    assert column(spark, ["https://a.b", " https://a.b ", "https://a.b.", "x https://a.b", ""], T.is_pure_url) == [True, True, False, False, False]


@pytest.mark.parametrize("text,vote", [("el la de los que en", "es"), ("the of and to", "en"), ("uma com dos do em", "pt"), ("the of", "desconocido"), ("", "desconocido"), ("el the la of los and", "desconocido")])
def test_language_vote(spark, text, vote):
    assert column(spark, [text], T.language_vote) == [vote]


def test_weighted_language(spark):
    texts = ["La situación también requiere atención porque cada año hay más.", "However, the situation requires attention within every region.", "A situação também não é simples; então há muito mais.", "zzz", ""]
    got = column(spark, texts, lambda c: T.decide_language(T.language_scores(c)))
    assert [g.language for g in got] == ["es", "en", "pt", "es", "es"]
    assert [g.is_ambiguous for g in got][3:] == [True, True]
    long = "x" * 3000 + "y" * 3001
    assert column(spark, [long], lambda c: F.length(T.sample(c, 2000))) == [6000]


def test_truncation_rules(spark):
    text = "One two. Three four five six"
    assert column(spark, [text, "a b c d e f"], lambda c: T.truncate_at_sentence(c, 5)) == ["One two.", "a b c d e"]
    assert column(spark, ["a b c d e f"], lambda c: T.truncate_at_sentence(c, 5, "whole")) == ["a b c d e f"]
    with pytest.raises(Exception):
        column(spark, ["a b c d e f"], lambda c: T.truncate_at_sentence(c, 5, "raise"))
    assert column(spark, [text, "a b c d e f", "a b. c d e f", "a b c d e. f"], lambda c: T.bounded_fragment(F.lit("txt"), c, 5)) == ["One two.", None, "a b.", "a b c d e."]
    assert column(spark, ["keywords[0]: b c d e f g"], lambda c: T.bounded_fragment(F.lit("json"), c, 5)) == ["keywords[0]: b c d e"]
    assert column(spark, ["Tabla 3 x y z 10 20 30"], lambda c: T.bounded_fragment(F.lit("pdf"), c, 5)) == ["Tabla 3 x y z"]


def test_structural_oversize(spark):
    cases = {
        "SELECT a FROM b JOIN c ON d WHERE e": True, "prose only here": False, "• a • b • c • d": True, "(a) x (b) y (c) z (i) k (v) l (x) m (1) n (2) o": True,
        "www.a www.b www.c http://d": True, "A" * 300 + "1" * 100 + "=": True, "A" * 401: False, ("w, " * 20) + "w " * 90: True, "UPPER " * 40: True, "lower " * 40: False, "[Pagina 3] • " + "w " * 120: True, "a AND b " * 12: True,
    }
    assert column(spark, list(cases), T.is_structural_oversize) == list(cases.values())


def test_overlap_and_boundaries(spark):
    df = spark.createDataFrame([("a b c", "b c d"), ("a", "b"), ("", "x"), ("x y", "x y")], "l string, r string")
    assert [r.o for r in df.select(T.word_overlap(F.col("l"), F.col("r")).alias("o")).collect()] == [2, 0, 0, 2]
    assert column(spark, [["ab", "c", "de"], ["x"], []], T.boundary_offsets, "array<string>") == [[2, 4], [], []]


def test_normalisation(spark):
    texts = ["  ÁRBOL\tÑandú é  x", "Ünï"]
    plain = lambda t: re.sub(r"\s+", " ", "".join(c for c in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(c) != "Mn")).strip()
    assert column(spark, texts, T.normalise_for_match) == [plain(t) for t in texts]
    assert column(spark, ["a\nb\x07c"], T.safe_log) == ["a b c"]


def test_row_and_sentence_units(spark):
    assert column(spark, ["a\r\n\n b \x0bc d"], T.row_units) == [["a", "b", "c", "d"]]
    assert column(spark, ["Uno. Dos! Tres"], T.sentence_units) == [["Uno.", "Dos!", "Tres"]]


def test_vectors(spark):
    rows = [([3.0, 4.0],), ([float("nan"), 1.0],), ([1.0],), (None,), ([0.6, 0.8],)]
    df = spark.createDataFrame(rows, "v array<double>")
    assert [r.p for r in df.select(V.problems(F.col("v"), 2).alias("p")).collect()] == [["norm"], ["not_finite"], ["dimension"], ["missing"], []]
    assert df.select(V.normalise(F.col("v")).alias("n")).first().n == [0.6, 0.8]
    assert df.limit(1).select(V.inner_product(F.col("v"), F.col("v")).alias("x")).first().x == 25.0
