"""Token counts: spliced chunks against encoding whole texts."""

import random

import public_tokenizers
import pytest

from vendorscope.llm.tokens import PieceModel, count_tokens

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def piece():
    return PieceModel(PATH)


def test_splicing_equals_whole_encoding(piece):
    rng = random.Random(1)
    alphabet = "ab  \n\t.,é你好☃\r();▁<s>0x"
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 400)))
        chunk, overlap = rng.choice([20, 50, 100]), rng.choice([2, 5, 10])
        assert piece.count(text, chunk, overlap) == len(piece.sp.encode(text))


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "你" * 3000, "x y" * 2000, "ab" * 3000 + " c", "<s> </s>" * 900])
def test_texts_that_align_late_or_never(piece, text):
    assert piece.count(text, 500, 8) == len(piece.sp.encode(text))


def test_odd_rows(spark, odd_docs, piece):
    got = sorted(map(tuple, count_tokens(odd_docs, PATH, limit=100, chunk_chars=1000, overlap_chars=16).collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode()), n := len(piece.sp.encode(r.text or "")), n > 100) for r in odd_docs.collect()]
    assert got == sorted(want, key=str)


def test_empty(no_docs):
    assert count_tokens(no_docs, PATH).collect() == []
