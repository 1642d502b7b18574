"""Token counts against the sentencepiece library."""

import random

import public_tokenizers
import pytest
import sentencepiece

from delaycast.llm.piece_encoding import SPACE, Vocabulary
from delaycast.llm.queries import op13
from delaycast.llm.token_counts import Counter, with_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, "rb") as file:
        return Counter(Vocabulary(file.read()))


def test_proven_strings_are_one_token(counter, library):
    assert len(counter.whole) > 10_000
    words = sorted(counter.whole)
    assert all(len(ids) == 1 for ids in library.encode(words))
    # What was not proven is no single token for the library either.
    ids = {library.id_to_piece(i) for i in range(len(library)) if library.id_to_piece(i).startswith(SPACE)}
    left = sorted(p[1:] for p in ids if p[1:] and SPACE not in p[1:] and p[1:] not in counter.whole)
    assert all(len(ids) > 1 for ids in library.encode(left))


def test_odd_texts(counter, library):
    pieces = ["a", "the", " ", "  ", "\n", SPACE, "é", "日本", "\t", "𝔘", "<s>", "</s>", "<0x0A>", "\x00", "x" * 40, "ing", "\r\n", "=" * 70]
    chance = random.Random(3)
    texts = ["".join(chance.choices(pieces, k=chance.randint(0, 14))) for _ in range(20_000)]
    found = [counter.count(t)[0] for t in texts]
    wanted = [len(ids) for ids in library.encode(texts)]
    assert [(t, f, w) for t, f, w in zip(texts, found, wanted) if f != w] == []


@pytest.mark.parametrize("text", [" " * 50_000, "ab" * 60_000, "\n" * 1000, "a b\n" * 30_000, "é" * 3000, "=-" * 9000])
def test_long_texts(counter, library, text):
    assert counter.count(text)[0] == len(library.encode(text))


def test_rows(spark, library):
    texts = [None, "", " ", "one two", "one two", "x" * 5000, "word " * 5000]
    rows = [(i if i else None, t, 5, "kept") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, counted string")
    got = {(r.doc_id, r.text): r for r in with_counts(df, PATH).collect()}
    assert len(got) == len(texts)
    for (_, text), r in got.items():
        n = len(library.encode(text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), n, n > 4096)
        assert r.counted == "kept" and r.n_direct <= r.n_tokens
    assert with_counts(df.limit(0), PATH).count() == 0


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = op13(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
