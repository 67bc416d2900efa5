import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from textlode.llm import token_frames as T

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)


def expected(rows):
    out, start = [], 0
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = LIB.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((k, start, len(ids), np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    return out


def written(spark, rows, folder, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    T.write_token_frames(df, folder, PATH, **kw)
    return sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in T.read_token_frames(spark, folder).collect()), key=lambda r: r[1])


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_round_trip(spark, tmp_path, shards):
    rows = [(5, "Hello  World, it's 42!"), (1, None), (3, ""), (None, "null id"), (9, "É é  x　y   z"), (2, "<|endoftext|> a<|startoftext|>b"), (7, "x " * 90000), (8, " \n"), (10, "l'été—où? naïve×x ÷ e\u0301a =\u0338 don't 'tis rock'n'roll a'sx ＜|x <| ENDOFTEXT <|ENDOFTEXT|>")]
    assert written(spark, rows, f"file://{tmp_path}/t", shards=shards) == expected(rows)


def test_repeated_ids_and_empty_table(spark, tmp_path):
    got = written(spark, [(1, "b"), (1, "a"), (1, "a"), (0, "z")], f"file://{tmp_path}/t", shards=4)
    assert [g[0] for g in got] == [0, 1, 1, 1] and [g[1] for g in got] == [0, 2, 4, 6]
    assert written(spark, [], f"file://{tmp_path}/e") == []


def test_shard_is_a_zstandard_stream_with_checked_random_access():
    out = io.BytesIO()
    w = T.ShardWriter(out, 2)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 60000, n).astype(np.uint32) for n in (0, 3, 70000, 65535, 1, 2, 200000)]
    for i, d in enumerate(docs):
        w.add(i, d)
    w.close()
    raw = out.getvalue()
    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
    assert plain == np.concatenate(docs).astype("<u2").tobytes()
    reads = []

    class Counting(io.BytesIO):
        def read(self, n=-1):
            reads.append(n)
            return super().read(n)

    r = T.ShardReader(Counting(raw))
    for i in (6, 0, 2, 5, 4, 3, 1):
        assert np.array_equal(r.document(i), docs[i])
    r = T.ShardReader(Counting(raw))
    reads.clear()
    r.document(4)
    assert sum(reads) < len(raw) / 2
    broken = bytearray(raw)
    broken[20] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        for i in range(7):
            T.ShardReader(io.BytesIO(bytes(broken))).document(i)


def test_query_against_library_on_whole_table(spark):
    from textlode.llm.queries import op2_token_frames

    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((k, s, n, zlib.crc32(b)) for k, s, n, b in expected(rows))
    assert sorted(tuple(r) for r in op2_token_frames(spark, d).collect()) == want


def test_other_columns_are_ignored(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, start int, tie string")
    T.write_token_frames(df, f"file://{tmp_path}/t", PATH)
    assert [r.n_tokens for r in T.read_token_frames(spark, f"file://{tmp_path}/t").collect()] == [3]


def signs():
    import unicodedata

    every = (chr(c) for c in range(0x110000))
    return [c for c in every if unicodedata.category(c) not in ("Cn", "Co", "Cs")]


def test_every_sign_beside_letters_and_punctuation_has_the_ids_of_the_library():
    forms = ["a{0}b.{0}( {0}1{0}'s'{0} {0}", "x{0}. Y{0}! {0}-{0}é{0}ü", "H{0}J{0}T{0}W{0}A{0} {0}{0}a {0}.{0}  {0}\n{0}\t{0}x", "'{0}s it'{0}s"]
    table, _ = T._library_table(PATH)
    assert isinstance(table, T.PieceTable)
    every = signs()
    some = every[:12_000] + every[12_000::9]
    texts = [f.format(c) for c in some for f in forms] + ["xİ.", "İ'", "Aİ-B", "KIRİ!", "İzmir", "ẙ Y̊"]
    raw = [t.encode() for t in texts]
    ids, at = table.ids(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    want = [e.ids for e in LIB.encode_batch_fast(texts, add_special_tokens=False)]
    assert [t for k, t in enumerate(texts) if ids[at[k] : at[k + 1]].tolist() != want[k]] == []


def test_shards_roll_and_other_vocabularies_are_encoded_whole(spark, tmp_path):
    rows = [(k, "a word. " * k) for k in range(40)] + [(None, "x")]
    assert written(spark, rows, f"file://{tmp_path}/t", shards=2, shard_docs=7) == expected(rows)
    assert T.read_manifest(spark, f"file://{tmp_path}/t").agg({"n_docs": "max", "part": "max"}).first()[:] == (7, 2)
    assert written(spark, rows, f"file://{tmp_path}/u", shards=1, shard_ids=50) == expected(rows)
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, "Ein Wort, no \n  more"), (2, None)], "doc_id long, text string")
    T.write_token_frames(df, f"file://{tmp_path}/v", path)
    got = {r.doc_id: np.frombuffer(r.ids, dtype="<u4").tolist() for r in T.read_token_frames(spark, f"file://{tmp_path}/v").collect()}
    assert got == {1: [*Tokenizer.from_file(path).encode("Ein Wort, no \n  more").ids, 1], 2: [1]} and isinstance(T._library_table(path)[0], T.WholeTexts)
