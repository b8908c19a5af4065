"""Token files and BPE against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from matchgrid.llm import bpe, tokenfile

SF = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
by_bytes, by_words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
ODD = st.text(st.sampled_from("aAb\xe9 \xdfΣσİIs'll\n\t  \x1c\x85\xa0　日\xb2\xbdⅧ٣0129.!?<|>endoftextr\0́\xf1ẞ\U0001f600_-  "), max_size=60)
TEXT = ODD | st.text(max_size=40) | st.lists(st.sampled_from(["the", "Theory", "isn't", " geh\u00f6rt###", " it's", " all'", " ends...", "a_b_", " \u00d7##", " \u0561##", "<|", "<|endoftext|>", "<|startoftext|>", " ", "  ", "\n", "\r\n", "x1y2", "ΟΔΟΣ", "…"]), max_size=12).map("".join)


@settings(max_examples=600, deadline=None)
@given(TEXT)
@example("ΑΣ ΑΣ' İstanbul\x1c\x1dx   y")
@example("a<|endoftext|> b  c \n d\n\ne 　f")
def test_byte_pieces(text):
    own = tokenfile.encoder(BYTES)
    ids = np.frombuffer(next(own.encode([text])), "<u4").tolist()
    assert ids == by_bytes.encode(text, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(TEXT)
@example("ΑΣ ΑΣ' İstanbul\x1c\x1dx   y")
@example("aaaaaaaa abababab mississippi")
@example("é <|endoftext|>Ü")
def test_word_bpe(text):
    own = bpe.codec(WORDS)
    want = by_words.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == want
    assert own.decode(want) == by_words.decode(want, skip_special_tokens=False)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.sampled_from(["byte", "bit"]))
def test_planes(ids, kind):
    ids = np.array(ids, np.uint32)
    sizes, planes = tokenfile.to_planes(ids, kind)
    assert len(sizes) == (4 if kind == "byte" else 32) and sum(sizes) == len(planes)
    assert tokenfile.from_planes(planes, sizes, len(ids), kind).tolist() == ids.tolist()


@given(st.binary(max_size=200), st.binary(max_size=200))
def test_joined_crc(a, b):
    assert tokenfile.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected_files(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = by_bytes.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in tokenfile.op1_token_files(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert got == expected_files(rows)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_documents_over_several_blocks(spark, tmp_path, kind):
    rows = [(9, "one two three " * 50), (1, None), (2, ""), (4, "end <|endoftext|> of\ntext"), (None, "null id"), (3, "x"), (3, "x"), (3, "x")]
    df = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 as id", "2 as h", "3 as r", "4 as part")
    folder = str(tmp_path / "files")
    tokenfile.write(df, folder, BYTES, block=16, kind=kind)
    got = [tuple(r) for r in tokenfile.documents(spark, folder).orderBy("start").collect()]
    assert got == expected_files(rows)
    ids = [i for r in tokenfile.read(spark, folder).orderBy("part", "block").collect() for i in r.ids]
    assert len(ids) == sum(r[2] for r in got)


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    tokenfile.write(none, str(tmp_path / "files"), BYTES)
    assert tokenfile.documents(spark, str(tmp_path / "files")).collect() == []
    assert bpe.digests(none, WORDS).collect() == []


def expected_bpe(rows):
    out = []
    for doc, text in rows:
        ids = by_words.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), by_words.decode(ids, skip_special_tokens=False))]
        out.append((doc, len(ids), *sha))
    return sorted(out, key=str)


def test_bpe_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in bpe.op8_bpe(spark, SF).collect()), key=str) == expected_bpe(rows)


def test_bpe_edge_cases(spark, monkeypatch):
    rows = [(None, "null id"), (1, None), (2, ""), (3, " \n"), (4, "Long Text's end. " * 4000), (4, "same"), (4, "same"), (5, "a" * 3000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 as id", "2 as ids")
    assert sorted((tuple(r) for r in bpe.digests(df, WORDS).collect()), key=str) == expected_bpe(rows)
    tokens = bpe.encoded(df, WORDS, ("doc_id", "id"))
    for r in bpe.decoded(tokens, WORDS).collect():
        want = by_words.encode(dict(rows[:-2] + rows[-1:]).get(r.doc_id) or "", add_special_tokens=False).ids if r.doc_id != 4 else None
        assert r.doc_id == 4 or (r.ids == want and r.decoded == by_words.decode(want, skip_special_tokens=False))
    assert sorted(r.n_tokens for r in tokens.filter("doc_id = 4").collect()) == [1, 1, 20000]
    monkeypatch.setattr(bpe, "LONG", 50)
    assert ["".join(bpe.parts(t or "", 50)) for _, t in rows] == [t or "" for _, t in rows]
    own = bpe.Codec(WORDS)
    monkeypatch.setattr(bpe, "CACHED", 5)
    got = bpe._digests([t for _, t in rows] * 2, own)
    assert got[: len(rows)] == got[len(rows) :]
    monkeypatch.setattr(tokenfile, "CACHED", 3)
    small = tokenfile.Encoder(BYTES)
    texts = ["a b c d e", "e d f g", "a b c d e", None]
    assert list(small.encode(texts)) == list(tokenfile.encoder(BYTES).encode(texts))
