import json

import pytest

from textlode.functions import tokens as K
from textlode.plans import runs, stages
from textlode.sources import artifacts as A

from .test_stages import queries


@pytest.fixture
def raw(tmp_path):
    place = tmp_path / "raw" / "F1_synthetic"
    place.mkdir(parents=True)
    for i in range(12):
        (place / f"document-{i:02d}.txt").write_text(f"Documento {i} sobre tema{i} asunto{i} fin. Otra frase de relleno.")
    return str(tmp_path / "raw")


SETTINGS = stages.Settings(dim=64)


def test_plans():
    assert runs.Plan.of("quick").last == "retrieval" and runs.Plan.of("fresh").reuse is False and runs.Plan.of("resume-fresh").first == "embeddings"
    for bad in (("fresh", None, "index"), ("resume-fresh", "ingestion"), ("custom", "index", "chunking"), ("custom", "validation"), ("full", None, "index"), ("none",)):
        with pytest.raises(ValueError):
            runs.Plan.of(*bad)
    with pytest.raises(ValueError):
        runs.Plan.of("fresh", reuse=True)
    with pytest.raises(ValueError):
        runs.Plan.of("custom", "chunking", "index", forced=["retrieval"])


def test_fresh_then_approved_and_resumed(spark, tmp_path, raw):
    parent, child = str(tmp_path / "parent"), str(tmp_path / "child")
    make = lambda place, settings=SETTINGS: stages.Run(spark, place, settings, K.HashEncoder(64))
    run, told = make(parent), []
    run.progress = lambda name, facts: told.append((name, facts["rows"]))
    first = runs.execute(run, runs.Plan.of("fresh"), raw, queries(spark))
    assert told == [(s, 12) for s in ("ingestion", "chunking", "embeddings", "index")]
    assert "| chunking | executed | 12 |" in A.read_text(spark, f"{parent}/report.md")
    done = json.loads(A.read_text(spark, f"{parent}/run.json"))
    assert done["mode"] == "fresh" and done["index"]["rows"] == 12 and done["chunking"]["rows_per_second"] > 0
    assert abs(sum(s["percent"] for s in done.values() if isinstance(s, dict) and "percent" in s) - 100) < 1e-3
    with pytest.raises(FileExistsError):
        runs.execute(make(parent), runs.Plan.of("fresh"), raw, queries(spark))
    approval = runs.approve(spark, parent)
    run = make(child)
    again = runs.execute(run, runs.Plan.of("resume-fresh"), raw, queries(spark), parent, approval)
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    assert run.done["ingestion"]["inherited"] and run.done["chunk_policy"]["policy"] == "COMPARISON_ONLY_UPSTREAM_CHANGED"
    assert runs.chunk_policy(done["ingestion"], done["chunking"], done)["policy"] == "STRICT_HISTORICAL_IDENTITY"
    with pytest.raises(A.ContractError):
        runs.chunk_policy(done["ingestion"], done["chunking"] | {"sha256": "0"}, done)
    for other in (approval | {"chunking": {"rows": 1, "sha256": "0"}}, approval | {"settings": "0"}):
        with pytest.raises(A.ContractError):
            runs.inherited(spark, parent, other, SETTINGS)
    with pytest.raises(ValueError):
        runs.execute(make(child), runs.Plan.of("resume-fresh"), raw, queries(spark))


def test_index_fits_its_vectors_metadata_and_settings(spark, tmp_path, raw):
    place = str(tmp_path / "run")
    run = stages.Run(spark, place, SETTINGS, K.HashEncoder(64))
    run.run(raw, queries(spark), last="index")
    vectors, folder = f"{place}/embeddings", f"{place}/index"
    meta = A.load(spark, vectors)[0].select("row_pos", "chunk_id")
    assert A.load_index(spark, folder, vectors, meta, SETTINGS.fingerprint()).count() == 12
    for chunks, settings in ((meta.where("row_pos > 0"), SETTINGS.fingerprint()), (meta.selectExpr("11 - row_pos as row_pos", "chunk_id"), SETTINGS.fingerprint()), (meta, "0")):
        with pytest.raises(A.ContractError):
            A.load_index(spark, folder, vectors, chunks, settings)
    with pytest.raises(A.ContractError):
        A.build_index(spark, vectors, meta.where("row_pos > 0"), str(tmp_path / "i"), 64, "s")
    with pytest.raises(A.ContractError):
        A.build_index(spark, vectors, meta, str(tmp_path / "i"), 32, "s")
    again = stages.Run(spark, place, SETTINGS, K.HashEncoder(64))
    again.run(raw, queries(spark), last="index")
    assert again.done["index"]["reused"]
    assert A.load_manifest(spark, f"{place}/chunking.json", "chunking")["capacity"] == 510


def test_artifacts_above_a_hundred_thousand_rows_load_again(spark, tmp_path):
    df = spark.range(150_000).selectExpr("id as k", "concat('c', id) as v")
    made = A.publish(df.repartition(7), f"{tmp_path}/big", "k", "v")
    assert A.load(spark, f"{tmp_path}/big")[1] == made
    other = A.publish(df.repartition(3), f"{tmp_path}/other", "k", "v")
    assert (other["rows"], other["sha256"]) == (made["rows"], made["sha256"])


def test_commands(spark, tmp_path, capsys):
    docs = tmp_path / "documents.jsonl"
    docs.write_text("".join(json.dumps({"doc_id": f"DOC-{i}", "fuente": f"{i}.txt", "formato": "txt", "fenomeno": 1, "texto": f"Frase {i} entera con palabras suficientes. Otra frase sigue aquí."}) + "\n" for i in range(6)))
    place = str(tmp_path / "chunks")
    made = runs.main(["produce", "--documents", str(docs), "--folder", place], spark)
    assert made["rows"] == 6 and not made["reused"] and runs.main(["produce", "--documents", str(docs), "--folder", place], spark)["reused"]
    assert runs.main(["validate", "--folder", place], spark)["state"] == "PASS"
    bench = str(tmp_path / "bench")
    (tmp_path / "bench").mkdir()
    first = runs.main(["benchmark", "--documents", str(docs), "--folder", bench, "--repetitions", "2"], spark)
    more = runs.main(["benchmark", "--documents", str(docs), "--folder", bench, "--repetitions", "3"], spark)
    assert (first["resumed_from"], more["resumed_from"], more["repetitions"], more["deterministic"]) == (0, 2, 3, True)
    assert '"deterministic": true' in capsys.readouterr().out
    with runs.Lock(spark, f"{bench}/benchmark.lock"), pytest.raises(RuntimeError):
        runs.main(["benchmark", "--documents", str(docs), "--folder", bench], spark)


def test_chunks_by_a_tokenizer_fit_the_encoder(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    settings = stages.Settings(max_tokens=40, overlap_tokens=12, encoder_limit=64, tokenizer=path, dim=16)
    rows = [("a", "f", "txt", 1, "El perro desconocido corre velozmente. " * 9), ("b", "f", "csv", 1, "x: 1\n" + "largapalabra, " * 60), ("c", "f", "txt", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id string, fuente string, formato string, fenomeno int, texto string")
    counter = K.FileCounter(path)
    got = stages.chunk_documents(docs, settings).collect()
    assert got and all(r.num_tokens == counter.count(r.texto) <= settings.capacity for r in got) and any(r.hard_split for r in got)
    assert any(len(r.texto.split()) < r.num_tokens for r in got)
    chunks = stages.chunk_documents(docs, settings)
    assert stages.embed(chunks, K.HashEncoder(16), settings).count() == len(got)
    with pytest.raises(A.ContractError):
        stages.embed(chunks.withColumn("num_tokens", chunks.num_tokens - 1), K.HashEncoder(16), settings)
    with pytest.raises(stages.OversizedSentenceError):
        stages.chunk_documents(docs.selectExpr("doc_id", "fuente", "formato", "fenomeno", "repeat('palabra ', 80) as texto"), settings)
    words = stages.chunk_documents(docs, stages.Settings(max_tokens=40, overlap_tokens=12), counter=Words())
    assert all(r.num_tokens == 1 + len(r.texto.split()) for r in words.collect())


class Words:
    """A word is a token, and every text has one more."""

    def count(self, text):
        return 1 + len(text.split())

    def count_many(self, texts):
        return [self.count(t) for t in texts]

    def bare(self, text):
        return len(text.split())

    def offsets(self, text):
        import re

        return [m.span() for m in re.finditer(r"\S+", text)]


def test_gates(spark):
    chunks = spark.createDataFrame([("d", 0, "txt", "uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece de"), ("d", 1, "txt", "la casa grande.")], "doc_id string, posicion int, formato string, texto string")
    chunks = chunks.selectExpr("*", "concat(doc_id, posicion) as chunk_id", "'f' as fuente", "cast(null as struct<strategy:string>) as hard_split")
    assert stages.boundary_gate(chunks)[0] == "FAIL" and stages.boundary_gate(chunks.where("posicion = 1"))[0] == "PASS"
    assert stages.boundary_gate(chunks.withColumn("formato", chunks.doc_id.substr(9, 1)).selectExpr("doc_id", "posicion", "'csv' as formato", "texto", "hard_split"))[0] == "PASS"
    docs = spark.createDataFrame([("d", "uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece")], "doc_id string, texto string")
    bank = lambda t: spark.createDataFrame([("q001", t)], "query_id string, text string")
    gate = lambda t: stages.upstream_gate(docs, chunks, bank(t), SETTINGS)[0]
    assert gate("tres cuatro cinco seis siete") == "FAIL" and gate("ninguna pregunta de estas hay") == "PASS"
    assert gate("uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciseis diecisiete") in ("NEEDS_REVIEW", "PASS")
