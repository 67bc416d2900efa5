import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from textlode.sources import artifacts as A
from textlode.sources import corpus, mvt, readers


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def block(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def layer(name, keys, values, features):
    body = block(1, name.encode())
    for ident, tags in features:
        body += block(2, (varint(8) + varint(ident) if ident is not None else b"") + block(2, b"".join(map(varint, tags))))
    return block(3, body + b"".join(block(3, k.encode()) for k in keys) + b"".join(block(4, v) for v in values))


VALUES = [block(1, "alfa".encode()), varint(4 << 3) + varint(2**64 - 1), varint(6 << 3) + varint(3), varint(7 << 3) + varint(1), b"\x19" + b"\0" * 8]


def xlsx(rows):
    cells = lambda r, n: "".join(f'<c r="{chr(65 + i)}{n}" t="{k}">{v}</c>' for i, (k, v) in enumerate(r) if v)
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Datos" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Nombre</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>" + "".join(f'<row r="{n}">{cells(r, n)}</row>' for n, r in enumerate(rows, 1)) + "</sheetData></worksheet>")
    return out.getvalue()


def test_json():
    data = {"titulo": " Uno ", "n": [1, 2.50, 1e-05, True, None], "a": {"b": [{"c": "x"}], "u": "https://a.b/c"}, "v": "", "t": "see https://a.b"}
    assert readers.read_json(("﻿" + json.dumps(data)).encode()) == "titulo: Uno\nn[0]: 1\nn[1]: 2.5\nn[2]: 1e-05\nn[3]: True\na.b[0].c: x\nt: see https://a.b"
    assert readers.read_json(b'"solo"') == "solo" and readers.read_json(b"[]") == "" and readers.read_json(b'["a"]') == "[0]: a"


def test_csv():
    assert readers.read_csv("﻿nombre, valor ,,x\nalfa,10,zz,\n ,,,\n\"b,c\",\"d\ne\"\n".encode()) == "nombre: alfa | valor: 10\nnombre: b,c | valor: d\ne"
    with pytest.raises(ValueError):
        readers.read_csv(b"")


def test_xlsx():
    rows = [[("n", "")], [("s", "<v>0</v>"), ("n", ""), ("inlineStr", "<is><t>Valor</t></is>")], [("inlineStr", "<is><t>alfa</t></is>"), ("n", "<v>7</v>"), ("n", "<v>1.5</v>")], [("b", "<v>1</v>"), ("n", "<v> </v>"), ("n", "")]]
    assert readers.read_xlsx(xlsx(rows)) == "[Hoja: Datos] Nombre: alfa | columna_2: 7 | Valor: 1.5\n[Hoja: Datos] Nombre: True"


def test_html():
    page = "<html><body><nav>no</nav><p>fuera</p><main><h1>Hola&amp;</h1><script>x</script><p>uno <b>dos</b><br>tres</main><main>otro</main></body></html>"
    assert readers.read_html(page.encode()) == "Hola&\nuno\ndos\ntres"
    assert readers.read_html(b"<article>a<svg>b</svg></article><p>c") == "a" and readers.read_html(b"<body>x<style>y</style></body>") == "x" and readers.read_html(b"solo <i>texto") == "solo\ntexto"


def test_vector_tiles(spark):
    tile = layer("z", ["k", "n", "s", "b", "f"], VALUES, [(5, [0, 0, 1, 1]), (None, [2, 2, 3, 3, 4, 4, 9, 0, 1]), (5, [0, 0])]) + layer("a", ["k"], VALUES[:1], [(None, [0, 0])])
    lines = mvt.tile_text(tile).split("\n")
    assert lines == ["capa: a | k: alfa", "capa: z | k: alfa | n: 18446744073709551615", "capa: z | b: True | s: -2"]
    for broken in (b"\x1a", b"\x1b\x00", block(3, b""), block(2, b"x"), b"\xff" * 11):
        with pytest.raises(ValueError):
            mvt.tile_text(broken)
    files = spark.createDataFrame([("1.pbf", bytearray(tile)), ("2.pbf", bytearray(layer("z", ["k"], VALUES[:1], [(5, [0, 0]), (6, [0, 0])]))), ("3.pbf", bytearray()), ("4.pbf", bytearray(b"\x1a"))], "path string, content binary")
    texts = {r.path: r.text for r in mvt.deduped_texts(mvt.feature_rows(files)).collect()}
    assert texts == {"1.pbf": "\n".join(lines), "2.pbf": "capa: z | k: alfa"}
    assert {r.path: (r.state, r.layers, r.features, r.distinct_features) for r in mvt.diagnose(files).collect()} == {"1.pbf": ("VALID", 2, 4, 3), "2.pbf": ("VALID", 1, 2, 2), "3.pbf": ("EMPTY", 0, 0, 0), "4.pbf": ("PARSE_ERROR", 0, 0, 0)}


@pytest.fixture
def folder(tmp_path):
    def put(path, data):
        target = tmp_path / "raw" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)

    put("F1_x/a.txt", "  Hola\t el mundo de la que en \r\n".encode())
    put("F1_x/b ñ%41+.json", b'{"t": "uno", "u": "https://z.y/w"}')
    put("F2_x/c.csv", b"h\nv\n")
    put("F2_x/empty.txt", b" ")
    put("F2_x/bad.txt", b"\xff\xfe")
    put("F3_x/p.pdf", b"%PDF")
    put("F3_x/i.png", b"x")
    put("F3_x/q.docx", b"x")
    put("F3_x/Aux.xlsx", b"x")
    put("__pycache__/z.txt", b"z")
    put("F1_x/.DS_Store", b"z")
    put("F1_x/~t.tmp", b"z")
    return str(tmp_path / "raw")


def test_ingestion_routes_every_file(spark, folder):
    docs, lost = corpus.ingest(spark, folder, {"f3_x/aux.xlsx": "auxiliar"})
    got = {r.fuente: r for r in docs.collect()}
    assert set(got) == {"F1_x/a.txt", "F1_x/b ñ%41+.json", "F2_x/c.csv"}
    a, b = got["F1_x/a.txt"], got["F1_x/b ñ%41+.json"]
    assert (a.texto, a.formato, a.fenomeno, a.idioma) == ("Hola el mundo de la que en", "txt", 1, "es") and a.doc_id.startswith("DOC-") and len(a.doc_id) == 16
    assert b.texto == "t: uno" and b.metadata.procedencia.urls == ["https://z.y/w"]
    assert {r.archivo: r.estado for r in lost.collect()} == {"F2_x/empty.txt": "vacío", "F2_x/bad.txt": "fallido", "F3_x/p.pdf": "pendiente_ocr", "F3_x/i.png": "pendiente_ocr", "F3_x/q.docx": "omitido", "F3_x/Aux.xlsx": "omitido"}
    assert {r.path for r in corpus.ocr_candidates(lost).collect()} == {"F3_x/p.pdf", "F3_x/i.png"}
    again, _ = corpus.ingest(spark, folder, plugins={".png": lambda raw: "leído"}, allowed=["F3_x/i.png"])
    assert [(r.fuente, r.formato) for r in again.collect()] == [("F3_x/i.png", "imagen")]


def test_cache_and_order(spark, folder):
    files = corpus.walk(spark, folder)
    paths = [r.path for r in files.orderBy("ordinal").collect()]
    assert paths == sorted(paths, key=lambda p: p.split("/")) and len(paths) == 9
    read = corpus.read_files(files)
    cache = read.where("suffix = '.txt' and error is null").select("path", "size", "mtime", F.lit("cached text").alias("text"))
    got = {r.path: (r.text, r.cached) for r in corpus.with_cache(files, cache).collect()}
    assert got["F1_x/a.txt"] == ("cached text", True) and got["F2_x/c.csv"] == ("h: v", False)
    routed = corpus.route(read.union(read))
    assert {r.estado: r.n for r in corpus.counters(routed).collect()}["fallido"] >= 3


def test_scans(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    good = put("q.jsonl", '{"query_id": "q001", "text": "a"}\n\n{"text": "b", "query_id": "q002"}\n')
    assert [r.query_id for r in A.scan_queries(spark, good, ["q001", "q002"]).orderBy("query_id").collect()] == ["q001", "q002"]
    with pytest.raises(A.ContractError):
        A.scan_queries(spark, good, ["q001"])
    for bad in ('{"query_id": "x1", "text": "a"}', '{"query_id": "q001", "text": " "}', '{"query_id": "q001", "text": "a", "z": 1}', '{"query_id": "q001", "text": "a"}\n{"query_id": "q001", "text": "b"}'):
        with pytest.raises(A.ContractError):
            A.scan_queries(spark, put("bad.jsonl", bad))
    docs = put("d.jsonl", '{"doc_id": "1", "texto": "x"}\n{"doc_id": "2"}\n[1]\nnope\n\n')
    p = A.profile_jsonl(spark, docs, A.DOCUMENT).first()
    assert (p.lines, p.blank, p.malformed, p.not_object, p.missing_texto) == (5, 1, 1, 1, 1)
    with pytest.raises(Exception):
        A.scan_jsonl(spark, docs, A.DOCUMENT, ["doc_id"]).count()
    sheet = "﻿query_id,query_text,rank,score,chunk_id,doc_id,source,chunk_text,human_grade,human_note\n" + "".join(f'q001,"a, b",{i},0.5,c,d,s,"t ""x""",{i % 4},\n' for i in range(1, 6))
    assert A.scan_judgments(spark, put("j.csv", sheet)).count() == 5
    for old, new in ((",3,\n", ",9,\n"), ("q001,\"a, b\",2", "q001,\"a, b\",1"), ("human_note", "note")):
        with pytest.raises(A.ContractError):
            A.scan_judgments(spark, put("k.csv", sheet.replace(old, new)))


def test_artifacts(spark, tmp_path):
    place = str(tmp_path / "a")
    df = spark.createDataFrame([(i, f"c{i}") for i in range(20)], "row_pos long, chunk_id string")
    made = A.publish(df.repartition(3), place, "row_pos", "chunk_id", model="m")
    data, manifest = A.load(spark, place)
    assert manifest == made and data.count() == 20
    with pytest.raises(FileExistsError):
        A.publish(df, place, "row_pos", "chunk_id")
    df.where("row_pos < 19").write.mode("overwrite").parquet(f"{place}/data")
    with pytest.raises(A.ContractError):
        A.load(spark, place)
    half = str(tmp_path / "h")
    df.write.parquet(f"{half}/data")
    with pytest.raises(A.ContractError):
        A.load(spark, half)
    assert A.recover(spark, half, "row_pos", "chunk_id")["sha256"] == made["sha256"]


def test_tiles_of_a_corpus_do_not_repeat_features(spark, tmp_path):
    (tmp_path / "F1_x").mkdir()
    one = layer("z", ["k"], VALUES[:1], [(5, [0, 0]), (6, [0, 0])])
    for name, raw in (("a.pbf", one), ("b.pbf", one), ("c.pbf", layer("z", ["k"], VALUES[:1], [(6, [0, 0]), (7, [0, 0])])), ("d.pbf", b"\x1a")):
        (tmp_path / "F1_x" / name).write_bytes(raw)
    docs, lost = corpus.ingest(spark, str(tmp_path))
    assert {r.fuente.split("/")[-1]: r.texto.count("capa: z") for r in docs.collect()} == {"a.pbf": 2, "c.pbf": 1}
    assert {r.archivo.split("/")[-1]: r.estado for r in lost.collect()} == {"b.pbf": "vacío", "d.pbf": "fallido"}
    ids = {r.path.split("/")[-1]: r.sha256 for r in corpus.file_identity(corpus.walk(spark, str(tmp_path))).collect()}
    assert ids["a.pbf"] == ids["b.pbf"] != ids["c.pbf"] and ids["a.pbf"].isupper()
    assert [r.fuente.split("/")[-1] for r in corpus.merged_in_order(docs.where("fuente like '%c.pbf'"), docs.where("fuente like '%a.pbf'")).collect()] == ["a.pbf", "c.pbf"]
