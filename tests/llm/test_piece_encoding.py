"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as contract
from delaycast.llm import piece_encoding as pe
from delaycast.llm.queries import tokenizer_path

PARTS = ["a", "b", "the", "  ", " ", "\n", "▁", "é", "中", "😀", "\t", "<s>", "ing", "<0x41>", "Th", "\x00", "\r", "ಠ", "\xa0"]
EDGES = ["", " ", "   ", "\n", "\n\n", " \n ", "a \nb", "▁", "x" * 5000, "aB" * 3000, " " * 1000, "a" + " " * 43 + "b", "<unk></s>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return pe.worker_encoder(*pe.read_model(tokenizer_path()))


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def test_ids_and_text_equal_the_library(library, encoder):
    chance = random.Random(3)
    texts = EDGES + ["".join(chance.choice(PARTS) for _ in range(chance.randint(1, 15))) for _ in range(4000)]
    for text in texts:
        expected = library.encode(text, add_bos=True, add_eos=True)
        assert ids(encoder, text) == expected, text
        assert encoder.decode(expected) == library.decode(expected), text


def test_decoding_any_ids(library, encoder):
    chance = random.Random(4)
    for _ in range(3000):
        some = [chance.randrange(3, 400) for _ in range(chance.randint(0, 12))]
        assert encoder.decode(some) == library.decode(some), some


def test_small_memos_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pe, "UNIT_MEMO", 10)
    monkeypatch.setattr(pe, "PAIR_MEMO", 10)
    small = pe.Encoder(pe.Vocabulary(pe.read_model(tokenizer_path())[1]))
    for text in ["the theatre is there\nand here", "of the house of theirs"] * 3:
        assert ids(small, text) == library.encode(text, add_bos=True, add_eos=True)


def test_query_on_all_documents(spark, library):
    found = contract.queries()["op9_sentencepiece"](spark, contract.SMOKE_DIR).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{contract.SMOKE_DIR}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for row in found:
        expected = library.encode(texts[row.doc_id], add_bos=True, add_eos=True)
        packed = np.array(expected, "<u4").tobytes()
        assert (row.n_tokens, row.ids_sha256) == (len(expected), hashlib.sha256(packed).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(library.decode(expected).encode()).hexdigest()


def test_nulls_clashes_repeats_and_empty_tables(spark):
    rows = [(None, None, "x"), (1, "a b", "y"), (1, "a b", "y"), (2, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = pe.with_digests(df, tokenizer_path())
    assert sorted(found.columns) == sorted(["doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"])
    assert sorted(r.n_tokens for r in found.collect()) == [2, 2, 4, 4]
    assert pe.with_digests(df.limit(0), tokenizer_path()).count() == 0
    back = pe.decode_ids(pe.encode_ids(df, tokenizer_path()), tokenizer_path(), into="back").collect()
    assert sorted(r.back for r in back) == ["", "", "a b", "a b"]
