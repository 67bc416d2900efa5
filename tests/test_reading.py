import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from textlode.functions import text as T
from textlode.functions import tokens as K
from textlode.operators import quality as Q
from textlode.operators import relations as R
from textlode.plans import agents as G
from textlode.sources import artifacts as A
from textlode.sources import cache, corpus, images
from textlode.sources import pages as P
from textlode.streaming import incremental as I


def split_pages(raw):
    return raw.decode().split("\f")


def test_paged_files(spark):
    read = lambda raw, see=None: P.read_paged(raw, split_pages, see)
    assert read(b"uno\f dos ") == "[Pagina 1]\nuno\n\n[Pagina 2]\ndos"
    assert read(b"uno\f \ftres", lambda raw, i: f"leida {i}") == "[Pagina 1]\nuno\n\n[Pagina 2]\nleida 2\n\n[Pagina 3]\ntres"
    for raw, see, message in ((b"uno\f ", None, P.SOME_BLANK), (b" \f ", None, P.ALL_BLANK), (b" ", lambda *_: "", P.NO_TEXT)):
        with pytest.raises(ValueError, match=message):
            read(raw, see)
    files = spark.createDataFrame([("a", bytearray(b"x\fy")), ("b", bytearray(b"x\f ")), ("c", bytearray(b" ")), ("d", bytearray(b"\xff")), ("e", None)], "path string, content binary")
    got = {r.path: (r.pages, r.native, r.recognised, r["class"]) for r in P.diagnose(files, split_pages, lambda raw, i: "ocr" if len(raw) > 2 else "").collect()}
    assert got == {"a": (2, 2, 0, "native"), "b": (2, 1, 1, "mixed"), "c": (1, 0, 0, "unreadable"), "d": (0, 0, 0, "unreadable"), "e": (1, 0, 0, "unreadable")}


def test_page_classes(spark):
    df = spark.createDataFrame([(3, 0, 3), (1, 2, 3), (0, 3, 3), (0, 0, 3)], "n int, o int, t int")
    assert [r.c for r in df.select(corpus.page_class(F.col("n"), F.col("o"), F.col("t")).alias("c")).collect()] == ["native", "mixed", "ocr", "unreadable"]


def test_paged_plugin_in_the_ingestion(spark, tmp_path):
    (tmp_path / "F1_a").mkdir()
    (tmp_path / "F1_a" / "x.pdf").write_bytes(b"primera\fsegunda")
    docs, lost = corpus.ingest(spark, str(tmp_path), plugins={".pdf": P.paged_reader(split_pages)})
    assert [r.texto for r in docs.collect()] == ["[Pagina 1]\nprimera\n\n[Pagina 2]\nsegunda"] and lost.count() == 0


def test_cache(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in "abc":
        (tmp_path / "in" / f"{n}.txt").write_text(f"texto {n}")
    files = corpus.walk(spark, str(tmp_path / "in"))
    first, entries = cache.read_through(files, cache.scan(spark, str(tmp_path / "none")))
    assert sorted((r.path, r.text, r.cached) for r in first.collect()) == [(f"{n}.txt", f"texto {n}", False) for n in "abc"]
    place = str(tmp_path / "cache")
    cache.write(cache.scan(spark, str(tmp_path / "none")), entries, place)
    known = cache.scan(spark, place)
    keys = {json.loads(r.key)["path"]: r.key for r in known.collect()}
    # bad lines are skipped, of one key the last line counts, and a key of recognised pages is the second choice
    recognised = json.loads(keys["b.txt"]) | {"ocr": True}
    lines = ["{broken", "[]", '{"key": "x"}', json.dumps({"key": keys["a.txt"], "doc_id": "1", "text": "alt"}), json.dumps({"key": keys["a.txt"], "doc_id": "2", "text": "neu"}), json.dumps({"key": json.dumps(recognised, sort_keys=True, separators=(",", ":")), "doc_id": "3", "text": "ocr"})]
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.json").write_text("\n".join(lines))
    other = cache.scan(spark, str(tmp_path / "other"))
    got, more = cache.read_through(files, other)
    assert sorted((r.path, r.text, r.cached) for r in got.collect()) == [("a.txt", "neu", True), ("b.txt", "ocr", True), ("c.txt", "texto c", False)]
    assert more.count() == 1
    cache.write(known, other, str(tmp_path / "merged"))
    merged = {r.key: r.text for r in cache.scan(spark, str(tmp_path / "merged")).collect()}
    assert merged[keys["a.txt"]] == "neu" and merged[keys["c.txt"]] == "texto c" and len(merged) == 4


def test_jsonl_and_chunks(spark, tmp_path):
    good = {"doc_id": "d", "chunk_id": "c", "fuente": "f", "formato": "txt", "fenomeno": 1, "posicion": 0, "num_tokens": 3, "texto": "á b c"}
    df = spark.createDataFrame([tuple(good.values())], A.CHUNK.replace("doc_id string, chunk_id string", "doc_id string, chunk_id string"))
    A.write_jsonl(df, f"{tmp_path}/out")
    assert "á b c" in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*")) and A.scan_chunks(spark, f"{tmp_path}/out").count() == 1
    for k, v in (("texto", " "), ("num_tokens", 600), ("num_tokens", 0), ("posicion", -1), ("chunk_id", None)):
        (tmp_path / "bad.jsonl").write_text(json.dumps(good | {k: v}))
        with pytest.raises(A.ContractError):
            A.scan_chunks(spark, f"{tmp_path}/bad.jsonl")
    (tmp_path / "p.jsonl").write_text('{"a": "x", "b": 1}\n{"a": "x", "b": "no"}\n\nnope\n[1]\n{"b": 2}\n')
    r = A.profile_jsonl(spark, f"{tmp_path}/p.jsonl", "a string, b int").first()
    assert (r.lines, r.blank, r.malformed, r.not_object, r.missing_a, r.mistyped_b, r.repeated_ids) == (6, 1, 1, 1, 1, 1, 1)
    (tmp_path / "m.json").write_text('{"doc_ids": ["a", "a"]}')
    for kind in ("benchmark", "artifact"):
        with pytest.raises(A.ContractError):
            A.load_manifest(spark, f"{tmp_path}/m.json", kind)
    sheet = spark.createDataFrame([("q1", 2), ("q1", 1)], "query_id string, rank int")
    A.write_judgment_sheet(sheet, f"{tmp_path}/sheet")
    text = next((tmp_path / "sheet").glob("part-*")).read_text().splitlines()
    assert text[0].lstrip("\ufeff").startswith("query_id,query_text,rank") and [x.split(",")[2] for x in text[1:]] == ["1", "2"]


def test_strict_documents(spark):
    rows = [("DOC-1", "a.txt", "txt", 1, "es", "x"), ("DOC-1", "b.txt", "txt", 1, None, "x"), ("DOC-2", "/a", "doc", 4, "fr", " "), ("X", " ", None, None, "en", None), ("DOC-3", "C:\\x", "pdf", 3, "pt", "x")]
    found = sorted((r.doc_id, r.fuente, r.category) for r in Q.strict_document_checks(spark.createDataFrame(rows, A.DOCUMENT)).collect())
    assert found == sorted([
        ("DOC-1", "b.txt", "duplicate_id"), ("DOC-2", "/a", "absolute_source"), ("DOC-2", "/a", "bad_format"), ("DOC-2", "/a", "bad_phenomenon"), ("DOC-2", "/a", "bad_language"), ("DOC-2", "/a", "empty_text"),
        ("X", " ", "bad_prefix"), ("X", " ", "bad_source"), ("X", " ", "bad_format"), ("X", " ", "bad_phenomenon"), ("X", " ", "missing_text"), ("DOC-3", "C:\\x", "absolute_source"),
    ])


def test_summaries(spark):
    chunks = spark.createDataFrame([("txt", 5, None), ("txt", 600, ("comma",)), ("csv", 7, None)], "formato string, num_tokens int, hard_split struct<strategy:string>")
    r = Q.chunk_totals(chunks).first()
    assert (r.n, r.min, r.max, r.total, r.over, r.by_format, r.by_strategy) == (3, 5, 600, 612, 1, {"csv": 1, "txt": 2}, {"comma": 1, "whole": 2})
    df = spark.createDataFrame([("es", ("es", 0.9, 3.0, False)), ("es", ("en", 0.4, 1.0, True)), ("en", ("en", 0.8, 2.0, False))], "t string, d struct<language:string,confidence:double,margin:double,is_ambiguous:boolean>")
    got = {x.t: (x.n, x.as_es, x.as_en, x.accuracy, x.ambiguous_rate, x.mean_confidence, x.mean_margin) for x in Q.classifier_report(df, "t", "d", ["es", "en"]).collect()}
    assert got == {"es": (2, 1, 1, 0.5, 0.5, 0.65, 2.0), "en": (1, 0, 1, 1.0, 0.0, 0.8, 2.0), None: (3, 1, 2, 0.666667, 0.333333, 0.7, 2.0)}
    runs = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, "x"), ("b", 1.0, "x"), ("b", 1.0, "y")], "k string, s double, d string")
    assert {r.k: (r.median, r.deterministic) for r in Q.repetition(runs, ["k"], "s", "d").collect()} == {"a": (2.0, True), "b": (1.0, False)}
    cases = spark.createDataFrame([("e", ["x"], ["x"]), ("f", ["x", "y"], ["x", "z"]), ("g", ["x"], ["x", "y"])], "case_id string, a array<string>, b array<string>")
    assert {r.case_id: (r.count_equal, r.digest_equal, r.first_difference) for r in Q.compare_segmentations(cases).collect()} == {"e": (True, True, None), "f": (True, False, 1), "g": (False, False, 1)}
    assert Q.stage_metrics({"a": {"rows": 10, "seconds": 2.0}, "b": {"seconds": 2.0}}) == {"a": {"rows_per_second": 5.0, "percent": 50.0}, "b": {"rows_per_second": None, "percent": 50.0}}


def test_lookups_and_children(spark):
    parents = spark.createDataFrame([("a",), ("b",)], "k string")
    children = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("z", 1, "q")], "k string, n int, t string")
    found, orphans = R.with_children(parents, children, "k", "n")
    assert {r.k: [(c.n, c.t) for c in r.children] for r in found.collect()} == {"a": [(1, "x"), (2, "y")], "b": []} and [r.k for r in orphans.collect()] == ["z"]
    rows = spark.createDataFrame([("q1", "c1"), ("q9", "c1"), ("q9", "c9")], "query string, chunk string")
    q, c = spark.createDataFrame([("q1", "texto")], "query_id string, text string"), spark.createDataFrame([("c1", "d")], "chunk_id string, doc_id string")
    good, bad = R.looked_up(rows.withColumnsRenamed({"query": "query_id", "chunk": "chunk_id"}), {"q": (q, "query_id"), "c": (c, "chunk_id")})
    assert [(r.q.text, r.c.doc_id) for r in good.collect()] == [("texto", "d")]
    assert sorted((r.query_id, r.chunk_id, r.lacking) for r in bad.collect()) == [("q9", "c1", ["q"]), ("q9", "c9", ["q", "c"])]
    ranks = R.ranked(spark.createDataFrame([(g, i % 7) for g in ("x", "y", None) for i in range(50)], "g string, n int").repartition(5), ["n"], ["g"])
    per = {}
    for r in ranks.collect():
        assert r._n == 50
        per.setdefault(r.g, []).append((r._i, r.n))
    for v in per.values():
        assert [i for i, _ in sorted(v)] == list(range(50)) and [n for _, n in sorted(v)] == sorted(n for _, n in v)
    kept = R.preferred(spark.createDataFrame([("a", 1), ("a", 9), ("b", 9), (None, 9), ("c", None)], "g string, n int"), F.col("n") < 5, ["g"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([("a", 1), ("b", 9), (None, 9), ("c", None)], key=str)
    first = R.first_wins(spark.createDataFrame([("a", 2, "x"), ("a", 1, "y")], "k string, o int, v string"), ["k"], ["o"])
    assert [r.v for r in first.collect()] == ["y"]


def test_small_text_functions(spark):
    one = lambda c, **v: spark.range(1).select(*[F.lit(x).alias(k) for k, x in v.items()]).select(c.alias("o")).first().o
    assert one(T.row_overlap(F.col("a"), F.col("b")), a="uno dos tres", b="dos tres cuatro") == 8
    assert one(T.row_overlap(F.col("a"), F.col("b")), a="unodos tres", b="dos tres cuatro") == 0
    assert one(T.row_overlap(F.col("a"), F.col("b")), a="uno", b="uno") == 3 and one(T.row_overlap(F.col("a"), F.col("b")), a="", b="x") == 0
    units = spark.createDataFrame([(["a", "b", "c"], ["b", "c", "d"]), (["a"], ["b"]), ([], ["b"])], "a array<string>, b array<string>")
    assert [r.o for r in units.select(T.unit_overlap(F.col("a"), F.col("b")).alias("o")).collect()] == [2, 0, 0]
    assert one(T.normalised_digest(F.col("a")), a=" Hola\n MUNDO ") == hashlib.sha256(b"Hola MUNDO").hexdigest()
    assert one(T.excerpt(F.col("a"), 5), a=" ab  cdefghij") == "ab cd" and one(T.edges(F.col("a"), 3), a=" abc def  ghi") == "abc ... ghi" and one(T.edges(F.col("a"), 9), a="a  b") == "a b"
    assert K.encoder_capacity(512, 2, 512, None) == 510
    for bad in ((512, 2, 256), (2, 2)):
        with pytest.raises(ValueError):
            K.encoder_capacity(*bad)
    values = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),)], "v double")
    assert [r.o for r in values.select(A.finite_or_missing(F.col("v")).alias("o")).collect()] == [True, True, False, False]
    assert [one(A.required_text(F.col("a")), a=x) for x in ("x", " ", "")] == [True, False, False]


def test_structural_endings_by_format(spark):
    rows = [("json", "keywords[0]: agua", True), ("json", "solo prosa", False), ("pdf", "1,5% 2,5% 3,5% 4,5%", True), ("pdf", "Tabla 3 Datos de 2020", True), ("pdf", "Tabla 3 trata del agua", True), ("pdf", "nada de eso", False), ("txt", "Tabla 3 Datos de 2020", False)]
    df = spark.createDataFrame(rows, "f string, t string, want boolean")
    assert [r.o for r in df.select(T.is_structural_ending(F.col("f"), F.col("t")).alias("o")).collect()] == [w for *_, w in rows]


def test_evidence_and_stream_counts(spark, tmp_path):
    fragment = "struct<rank:int,chunk_id:string,doc_id:string,text:string>"
    results = spark.createDataFrame([("q1", [(2, "c2", "d2", "t2"), (1, "c1", "d1", "t1")]), ("q2", [(1, "c9", "d9", "t9")])], f"query_id string, fragments array<{fragment}>")
    assert [(e.chunk_id, e.doc_id, e.text, e.rank) for e in G.evidence_of(results, "q1")] == [("c1", "d1", "t1", 1), ("c2", "d2", "t2", 2)]
    cited = spark.createDataFrame([("q1", "c1"), ("q1", "c9"), ("q2", "c9")], "query_id string, chunk_id string")
    shown = results.select("query_id", F.explode("fragments.chunk_id").alias("chunk_id"))
    assert [tuple(r) for r in G.unknown_citations(cited, shown).collect()] == [("q1", "c9")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"t": "2024-01-01T00:01:00", "source": "s"}\n{"t": "2024-01-01T00:02:00", "source": "s"}\n{"t": "2024-01-01T00:21:00", "source": "r"}\n')
    stream = spark.readStream.schema("t timestamp, source string").json(str(tmp_path / "in"))
    query = I.source_counts(stream, "t").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.source, r.n) for r in spark.table("counted").collect()) == [("r", 1), ("s", 2)]


def test_scores_of_segmentations(spark):
    rows = [("es", ["Uno  dos.", "Tres."], ["Uno dos.", "Tres."]), ("es", ["Uno.", "Dos."], ["Uno. Dos."]), ("en", ["Abcd"], ["Ab"])]
    df = spark.createDataFrame(rows, "lang string, expected array<string>, found array<string>")
    got = {r.lang: (r.precision, r.recall, r.exact, r.lost_share) for r in Q.segmentation_scores(df, "lang").collect()}
    assert got == {"es": (1.0, 0.5, 0.5, 0.0), "en": (1.0, 1.0, 0.0, 0.5), None: (1.0, 0.5, 0.333333, round(2 / 27, 6))}


def test_sizes_of_pictures(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBBBBB", 13, b"IHDR", 640, 480, 8, 6, 0, 0, 0)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xc2\x00\x11\x08" + struct.pack(">HHB", 30, 40, 3) + b"\0" * 9
    lossless = b"RIFF\0\0\0\0WEBPVP8L\0\0\0\0\x2f" + ((99) | (49 << 14) | (1 << 28)).to_bytes(4, "little")
    wide = b"RIFF\0\0\0\0WEBPVP8X\x0a\0\0\0\x10\0\0\0" + (299).to_bytes(3, "little") + (199).to_bytes(3, "little")
    lossy = b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 33, 44)
    want = {png: (640, 480, "RGBA"), jpeg: (40, 30, "RGB"), lossless: (100, 50, "RGBA"), wide: (300, 200, "RGBA"), lossy: (33, 44, "RGB"), b"": None, b"\xff\xd8": None, png[:20]: None, b"II*\0": None, b"text": None}
    assert {k: images.image_size(k) for k in want} == want and images.image_size(None) is None
    entries = [(256, 3, 7), (257, 4, 9), (277, 3, 3)]
    tiff = b"II*\0" + struct.pack("<IH", 8, len(entries)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, k, v in entries)
    assert images.image_size(tiff) == (7, 9, "RGB")
    (tmp_path / "F1_a").mkdir()
    (tmp_path / "F1_a" / "x.png").write_bytes(png)
    docs, _ = corpus.ingest(spark, str(tmp_path), plugins={".png": lambda raw: "texto leido"})
    (r,) = docs.collect()
    assert tuple(r.metadata.imagen) == (640, 480, "RGBA") and r.metadata.procedencia is None
