"""Substring dedup against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from vendorscope.llm import substrings as S


def plain(texts, window):
    words = [(t or "").encode().split() for t in texts]
    n = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if n[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_odd_rows(odd_docs):
    rows = [r for r in odd_docs.collect()]
    want = sorted(((r.doc_id, *p) for r, p in zip(rows, plain([r.text for r in rows], 35))), key=str)
    marked = S.marked_words(odd_docs)
    assert marked.columns == [*odd_docs.columns, "n_words", "n_removed", "kept"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in marked.collect()), key=str) == want


@pytest.mark.parametrize("bits", [28, 10])
def test_random_texts_whatever_the_sketch_load(spark, monkeypatch, bits):
    monkeypatch.setattr(S, "MAX_CELL_BITS", bits)
    rng = random.Random(bits)
    pool = [[f"v{rng.randrange(30)}" for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    texts = [" ".join(w for _ in range(rng.randrange(1, 5)) for w in rng.choice(pool)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in S.marked_words(docs, window=12, gram=5).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 12)


def test_rolling_hash_depends_on_the_window_only():
    h = np.random.default_rng(1).integers(0, 2 ** 63, 300).astype(np.uint64)
    for size in (1, 2, 3, 16, 35):
        r = S.rolling(h, size, S.ODD[0])
        assert len(r) == 300 - size + 1
        for at in (0, 1, 77, 300 - size):
            assert S.rolling(h[at:at + size], size, S.ODD[0])[0] == r[at]
    swapped = h.copy()
    swapped[[3, 19]] = swapped[[19, 3]]
    assert S.rolling(h, 35, S.ODD[0])[0] != S.rolling(swapped, 35, S.ODD[0])[0]


@pytest.mark.parametrize("run", [2, 16])
def test_copies_with_edits(spark, monkeypatch, run):
    """Copies of long texts, cut, joined and edited: settled runs, their edges, and windows that only meet settled runs."""
    monkeypatch.setattr(S, "RUN", run)
    rng = random.Random(run)
    base = [[f"v{rng.randrange(4000)}" for _ in range(rng.randrange(100, 700))] for _ in range(15)]
    texts = [" ".join(b) for b in base]
    for _ in range(60):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "edit"
        lo = rng.randrange(len(w) - 40)
        other = rng.choice(base)
        texts.append(" ".join(w[lo:lo + rng.randrange(20, 400)] + other[:rng.randrange(60)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept)) for r in S.marked_words(docs).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 35)
    digests = {r.doc_id: r.kept_sha256 for r in S.removed_counts(docs).collect()}
    assert digests == {i: hashlib.sha256(k).hexdigest() for i, (_, _, k) in got.items()}


def test_empty_and_stage(no_docs, odd_docs):
    assert S.marked_words(no_docs).collect() == []
    out = S.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    same = {r.doc_id: r.text for r in out.collect()}
    assert same[42] == " \t\n " and same[40] is None and same[43] == "é日本 ß"
