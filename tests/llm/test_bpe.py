"""Forced-boundary BPE against the library that the vocabulary belongs to."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import bpe, queries

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", "a <|endoftext|> b", "x<|startoftext|>y<|endoftext|>", "<|ENDOFTEXT|> <|endoftext|", "naïve 漢字 🙂\n\n x",
    "İstanbul ΣΑΣ Σ", "it's 123'sam we'Ll 'tis \x85 x\x0b\x1cy", "é ́x á̧", "日本語テキスト" * 50, "zxqjk'Ll",
    "\x00\x01 �", "ﬁ Å    |　", " " * 500 + "x", "a" * 5000, "한국어 한",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_the_byte_letters_are_those_of_the_vocabulary(library):
    letters = bpe.byte_letters()
    assert len(set(letters)) == 256 and all(library.token_to_id(x) is not None for x in letters)


@pytest.mark.parametrize("path", [PATH, BYTES])
def test_texts_equal_the_library(path):
    codec, plain = bpe.Codec(path), Tokenizer.from_file(path)
    assert codec.parts_at_space == (path == PATH)
    for _ in range(2):  # the second time from memory
        found = [np.frombuffer(ids, np.int32).tolist() for ids in codec.encode([t.encode() for t in TEXTS])]
        assert found == [expected(plain, t) for t in TEXTS]


def test_fragments_end_at_pairs_that_no_token_holds(library):
    codec = bpe.Codec(PATH)
    tokens = [t.removesuffix("</w>") for t in library.get_vocab(False)]
    found = ["zxqjvkw", "thequick", "kxzbpq"]
    pieces, stops = codec.fragments(found)
    assert "".join(pieces) == "".join(found) and len(pieces) > len(found)
    for word, first, stop in zip(found, [0, *stops[:-1]], stops, strict=True):
        own = pieces[first:stop]
        assert "".join(own) == word
        assert not any(a[-1] + b[0] in t for a, b in zip(own, own[1:]) for t in tokens)
        assert all(any(x + y in t for t in tokens) for p in own for x, y in zip(p, p[1:]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet="abcxyz'stm12 .,!<|>́é漢\n", max_size=80), max_size=6))
def test_any_texts_equal_the_library(texts):
    codec, library = test_any_texts_equal_the_library.both
    found = codec.encode([t.encode() for t in texts])
    assert [np.frombuffer(ids, np.int32).tolist() for ids in found] == [expected(library, t) for t in texts]


test_any_texts_equal_the_library.both = (bpe.Codec(PATH), Tokenizer.from_file(PATH))


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 100)
    codec = bpe.Codec(PATH)
    for text in TEXTS * 2:
        assert np.frombuffer(codec.encode([text.encode()])[0], np.int32).tolist() == expected(library, text)


ODD = [(1, None), (2, ""), (3, "same words"), (3, "same words"), (4, "same words"), (None, "it's"), (None, None), (5, "ok, then " * 200_000), (6, "unbroken" * 40_000)]


def test_rows_and_decoded_texts(spark, library):
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    rows = rows.withColumns({c: F.lit("clash") for c in ("id", "ids", "decoded")})
    found = bpe.decode(bpe.encode(rows, PATH), PATH).collect()
    plain = [(i, expected(library, t)) for i, t in ODD]
    wanted = sorted((repr(i), ids, library.decode(ids, skip_special_tokens=False)) for i, ids in plain)
    assert sorted((repr(r["doc_id"]), r["ids"], r["decoded"]) for r in found) == wanted


def test_ids_of_any_type_other_decoders_and_empty_tables(spark):
    rows = spark.createDataFrame([("k", "Hello  wörld 🙂"), (None, "x")], "name string, body string")
    found = bpe.decode(bpe.encode(rows, BYTES, "name", "body"), BYTES, "name")
    assert {(r["name"], r["decoded"]) for r in found.collect()} == {("k", "Hello  wörld 🙂"), (None, "x")}
    assert bpe.decode(bpe.encode(rows.where("false"), PATH, "name", "body"), PATH, "name").count() == 0


def test_the_query_equals_the_library(spark, library):
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_bpe(spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for key, text in docs:
        ids = expected(library, text)
        digests = [" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)]
        assert found[key] == (len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in digests])
