"""Packing: exact round trip of all ids, and the Hilbert curve."""

import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vendorscope.llm import packing as P

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("partitions", [1, 7])
def test_round_trip(odd_docs, partitions):
    tok = Tokenizer.from_file(PATH)
    pieces = P.pack(odd_docs, PATH, length=64, end=1, partitions=partitions)
    assert {r.ids_crc32 for r in P.digests(pieces.limit(0)).collect()} == set()
    rows = pieces.collect()
    have = sorted((str(r.doc_id), r.start, r.doc_tokens, bytes(r.ids)) for r in rows)
    want = []
    for r in odd_docs.collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.append((str(r.doc_id), len(ids), np.array(ids, "<u4").tobytes()))
    # The pieces of a document lie end to end in the sequences, so the round trip follows (sequence, offset).
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    back, at = [], 0
    for k, r in enumerate(rows):
        assert (r.sequence_id, r.offset) == (at // 64, at % 64) and r.length == len(r.ids) // 4 and r.offset + r.length <= 64
        at += r.length
        if r.start == 0:
            back.append([str(r.doc_id), r.doc_tokens, b""])
        assert r.start == len(back[-1][2]) // 4
        back[-1][2] += bytes(r.ids)
    assert sorted(map(tuple, back)) == sorted(want) and have
    assert at == sum(n for _, n, _ in want)


def test_crc_and_empty(odd_docs, no_docs):
    assert P.pack(no_docs, PATH).collect() == []
    r = next(r for r in P.digests(P.pack(odd_docs, PATH)).collect() if r.doc_id == 40)
    assert (r.length, r.doc_tokens, r.ids_crc32) == (1, 1, zlib.crc32((1).to_bytes(4, "little")))


def test_words_tokenise_as_whole_texts(odd_docs):
    w, tok = P.word_ids(PATH), Tokenizer.from_file(PATH)
    texts = ["It's Ünïcode text <|endoftext|>x", "á ́b é", "ΑΣ Σ ΟΔΟΣ.", "x\x1cy\x85z", "don't\r\n'S 12 日本語!!",
             " ​  k", "İI ı ſ ﬁ", "..." * 50, "\t", "é" * 300]
    texts += ["", "<|ENDOFTEXT|> A", "MiXed CASE I\u0307"]
    ids, starts = w.ids(pa.array(texts), 1)
    for t, lo, hi in zip(texts, starts[:-1], starts[1:]):
        assert ids[lo:hi].tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1], t


def test_hilbert_visits_every_cell_step_by_step():
    for dims, bits in ((2, 3), (3, 2)):
        cells = np.array(list(product(range(1 << bits), repeat=dims)))
        key = P.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
