"""SimHash near-duplicates against brute force."""

import random
from itertools import combinations, product

import numpy as np
import pytest
import xxhash

from vendorscope.llm import simhash as S
from vendorscope.llm.graph import components


def plain_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", low) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_odd_rows(spark, odd_docs):
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in S.near_duplicates(odd_docs).collect()), key=str)
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in odd_docs.select("doc_id", "text").collect()]
    fps = {fp for _, fp in rows}
    root = plain_components(fps, [(a, b) for a, b in combinations(fps, 2) if bin(a ^ b).count("1") <= 4])
    least = {}
    for i, fp in rows:
        if i is not None:
            least[root[fp]] = min(least.get(root[fp], i), i)
    want = sorted(((i, fp - (1 << 64) if fp >> 63 else fp, least.get(root[fp])) for i, fp in rows), key=str)
    assert got == want


def test_empty(no_docs):
    assert S.near_duplicates(no_docs).collect() == []
    assert S.first_of_each(no_docs).collect() == []


def test_first_of_each(odd_docs):
    got = S.first_of_each(odd_docs)
    assert got.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in got.where("doc_id is not null").collect())
    assert ids == sorted({r.doc_id for r in S.near_duplicates(odd_docs).collect()
                          if r.doc_id is not None and r.doc_id == r.component_id})
    assert 0 in ids and 20 not in ids and ids.count(7) == 1


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 16)])
def test_links_connect_what_brute_force_connects(spark, seed, block):
    rng = random.Random(seed)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64) & (rng.getrandbits(64) if rng.random() < .5 else -1)  # skewed bits too
        for _ in range(rng.choice([1, 2, 5, 20])):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [(r.u, r.v) for r in S.links(df, 4, block=block).collect()]
    mask = (1 << 64) - 1
    real = [(a, b) for a, b in combinations(signed, 2) if bin((a ^ b) & mask).count("1") <= 4]
    assert plain_components(signed, got) == plain_components(signed, real)
    roots = {r.node: r.root for r in components(df.sparkSession.createDataFrame(got, "u long, v long")).collect()}
    assert roots == {n: r for n, r in plain_components(signed, real).items() if n in roots}


def test_plan_is_a_partition_with_enough_threshold(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(x),) for x in rng.integers(-2**62, 2**62, 500)], "fp long")
    chosen = S.plan(df, 4)
    bits = [b for g, _ in chosen for b in g]
    assert len(bits) == len(set(bits))
    assert sum(t + 1 for _, t in chosen) == 4 + 1  # groups left out have threshold -1


def test_allocation_is_the_cheapest():
    cost = [[1, 10, 100, 1000, 10000], [50, 5000, 5e5, 5e6, 5e7], [1, 2, 4, 8, 16]]
    for want in (-1, 0, 1, 2, 3):
        every = [t for t in product(range(-1, 5), repeat=3) if sum(t) == want]
        best = min(sum(c[x] for c, x in zip(cost, t) if x >= 0) for t in every)
        total, t = S.allocate(cost, want)
        assert total == best == sum(c[x] for c, x in zip(cost, t) if x >= 0) and sum(t) == want
