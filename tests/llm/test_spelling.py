"""Spelling groups against plain Python, and against SQL in tests of the registered queries."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from vendorscope.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs, every=199, least=6, least_n=5):
    total = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= least_n}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def plain(docs, **kw):
    n = plain_words(docs, **kw)
    around = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(v, w)] for w in n}
    form = {}
    for w, vs in around.items():
        if vs:
            v = min(vs, key=lambda v: (-n[v], v))
            if n[v] >= 5 * n[w]:
                form[w] = v
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(around[w]), n.get(form.get(w))))
    return sorted(out)


def got(docs, **kw):
    out = S.variants(docs, **kw)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in out.collect())


def test_random_words(spark):
    rng = random.Random(4)
    bases = ["".join(rng.choice("aabcdéÿ×") for _ in range(rng.randrange(6, 12))) for _ in range(25)]

    def word():
        w = rng.choice(bases[:rng.choice([3, 25])])
        for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abé") + w[k:], w[:k] + rng.choice("abé") + w[k + 1:]])
        return w.upper() if rng.random() < 0.1 else w

    docs = [(rng.choice([None, k, -k]), "".join(word() + rng.choice([" ", "\n", "-", "ß1", "œ", "日", "’", "_"]) for _ in range(rng.randrange(1, 300))))
            for k in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert got(df, every=7) == plain(docs, every=7)
    words = S.vocabulary(df, every=7).cache()
    want = sorted(tuple(r) for r in S.near_words(words).collect())
    for classes, block in ((2, 3), (1, 1), (9, 5)):
        assert sorted(tuple(r) for r in S.near_words(words, classes, block).collect()) == want
    assert len({r[2] for r in plain(docs, every=7)}) > 3 and any(r[1] and r[2] != r[1] for r in plain(docs, every=7))


def test_odd_rows(spark, odd_docs):
    extra = [(1, "Testing testing TESTING testing testing x" * 3), (2, "testng " * 2 + "tésting " * 5), (3, "z" * 300000 + " " + ("y" * 200000 + " ") * 5)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    assert got(docs) == plain([tuple(r) for r in docs.collect()])


def test_wide_words_and_ties(spark):
    docs = [(1, ("abcdef " * 25 + "abcdeg " * 25 + "abcdex " * 5 + "abcdefg " * 5) * 1), (2, None), (3, "")]
    rows = {r[0]: r for r in got(spark.createDataFrame(docs, "doc_id long, text string"), every=10 ** 9)}
    assert rows["abcdex"][1:] == ("abcdef", "abcdef", 5, 2, 25) and rows["abcdef"][1] is None and rows["abcdef"][4] == 3


def test_nothing(spark, no_docs):
    assert got(no_docs) == [] and got(spark.createDataFrame([(1, "one two"), (None, None)], "doc_id long, text string")) == []


def test_near_pairs_of_blocks():
    rng = random.Random(9)
    a = ["".join(rng.choice("abc") for _ in range(6)) for _ in range(200)]
    b = ["".join(rng.choice("abc") for _ in range(7)) for _ in range(200)]
    for x, y in ((a, a), (a, b), (b, b)):
        i, j = S.near_pairs(S._letters(x), S._letters(y), False)
        assert set(zip(i.tolist(), j.tolist())) == {(p, q) for p in range(200) for q in range(200) if near(x[p], y[q])}


def test_pieces_cut_no_word():
    text = "aaa bé cœd ".encode() * 50 + "éé".encode() * 40 + b" x1y"
    for piece in (1, 7, 64, 10 ** 6):
        assert [w for part in S._pieces(text, piece) for w in part] == [w.encode() for w in RUN.findall(text.decode())]


def test_letter_classes_cover_all_letters():
    classes = S.letter_classes(np.arange(256), 6)
    assert set(classes) == set(range(6)) and len(classes) == 256
