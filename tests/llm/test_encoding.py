from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import encoding as E
from tests.conftest import rows

FILE = Path(E.DEFAULT_FOLDER) / "byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not FILE.exists(), reason="no vocabulary file")


@pytest.fixture(scope="module")
def encoder():
    return E.Encoder(**E.load_tables(str(FILE)))


@pytest.fixture(scope="module")
def truth():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(FILE))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_equals_the_public_encoder(encoder, truth, text):
    assert encoder.encode_batch([text])[0].tolist() == truth(text)


@pytest.mark.parametrize("text", ["", "<|endoftext|>", "a" * 3000, "ab" * 1500, "der Straßenbahnhaltestellenfahrplan", "  \n\n\t x", "é ​﻿", "🙂🙂‍👩", "1234567890" * 50, "don't we'll I'VE", "\x00\x01"])
def test_hard_words(encoder, truth, text):
    assert encoder.encode_batch([text])[0].tolist() == truth(text)


def test_decoding_gives_the_text_back(encoder):
    text = "Übung macht den Meister – œuvre, 漢字"
    assert b"".join(encoder.pieces[i] for i in encoder.encode_batch([text])[0]).decode() == text


def test_guesses_are_verified_and_repaired(encoder):
    fresh = E.Encoder(pieces=encoder.pieces, merges=encoder.merges)
    words = [f" wort{k}ung" for k in range(2000)]
    fresh.learn(words)
    assert 0 < fresh.repaired <= fresh.guessed == 2000
    assert all(fresh.known[w] == fresh.exact(w.encode()) for w in words)


def test_documents(spark, truth):
    df = spark.createDataFrame([(1, "Hallo <|endoftext|>", "x"), (2, "", "x"), (3, None, "x"), (4, "Hallo <|endoftext|>", "x"), (5, "x y " * 50_000, "x")], "doc_id long, text string, ids string")
    out = {r.doc_id: r.ids for r in E.encode(df).collect()}
    assert out[1] == out[4] == truth("Hallo <|endoftext|>") and out[2] == out[3] == [] and out[5] == truth("x y " * 50_000)
    assert E.encode(df).schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"
    assert rows(E.encode(df.limit(0))) == []
