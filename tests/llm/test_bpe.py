import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textlode.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def ours(texts):
    codec = bpe.load(PATH)
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    ids, at = codec.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    back = codec.decode(ids.astype(np.int64), at)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)], back


def theirs(texts):
    got = [e.ids for e in LIB.encode_batch(texts, add_special_tokens=False)]
    return got, [LIB.decode(i, skip_special_tokens=False) for i in got]


TRICKY = [
    "", " ", "  ", "a", " a  b\n\n c\t\td ", "it's we'll I'd they're", "x  y　　 z   q", "a\x85 \x85b", "\x1c\x1d \x1f x\x1e",
    "<|endoftext|>", "a<|endoftext|>b  <|endoftext|>", " <|endoftext|> <|endoftext|", "-" * 5000, "aaaa" * 900, "é" * 700 + "ß", "日本語テキスト 漢字 🙂🙂🏽 é",
    "\r\n\r\n x \x0b\x0c", "123 45a6 ½ ²", "\x00\x01", "ا ب ج", "  \n", "\n", "a\n", "a \n b",
    "l'été—où? naïve×x ÷ e\u0301a =\u0338 don't 'tis rock'n'roll a'sx it's\nx\ty \n\nz", "a\n\u00a0\nb \u00a0\n c\u2003\td", "x.y,z(a)b 3a a3 ²a",
]


def test_tricky_texts_match_the_library():
    assert ours(TRICKY) == theirs(TRICKY)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list(" \n\t  abethsing'0-"))), max_size=40), max_size=5))
def test_any_texts_match_the_library(texts):
    assert ours(texts) == theirs(texts)


def test_long_words_and_cache_renewal(monkeypatch):
    from textlode.llm import _units

    monkeypatch.setattr(_units, "CACHE_PIECES", 50)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdeXYZ .,=/") for _ in range(3000)) for _ in range(20)]
    assert ours(texts) == theirs(texts)
    assert ours(texts[::-1]) == theirs(texts[::-1])


def test_query_against_library_on_whole_table(spark):
    from textlode.llm.queries import op8_bpe_round_trip

    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    ids, back = theirs([r.text or "" for r in rows])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((r.doc_id, len(i), sha(np.array(i, dtype="<u4").tobytes()), sha(t.encode())) for r, i, t in zip(rows, ids, back, strict=True))
    assert sorted(tuple(r) for r in op8_bpe_round_trip(spark, d).collect()) == want


@pytest.mark.parametrize("rows", [[], [(1, None, "x"), (None, "", None), (1, "ab", "y")]])
def test_nulls_empty_tables_and_clashing_columns(spark, rows):
    out = bpe.bpe_round_trip(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    assert sorted((r.n_tokens, bytes(r.ids), r.decoded) for r in out.collect()) == sorted((len(LIB.encode(t or "").ids), np.array(LIB.encode(t or "").ids, dtype="<u4").tobytes(), t or "") for _, t, _ in rows)
