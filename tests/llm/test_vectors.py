"""Exact top-k and approximate neighbours against brute force."""

import math

import numpy as np
import pytest

from vendorscope.llm import ann, topk


def odd_vectors(seed=0, n=400, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, dim))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(n + i, x[0].tolist(), 1) for i in range(30)]                       # copies
    rows += [(n + 40, None, 1), (n + 41, [None] * dim, 1), (n + 42, [math.nan] * dim, 1), (n + 43, [math.inf] + [0.0] * (dim - 1), 1),
             (n + 44, [0.0] * dim, 1), (n + 45, [], 1), (None, x[1].tolist(), 1), (5, x[5].tolist(), 1), (n + 50, (2 * x[0]).tolist(), None)]
    return rows


def valid(rows, zero_ok):
    out = {}
    for i, v, _ in rows:
        if i is None or not v or any(c is None or not math.isfinite(c) for c in v) or (not zero_ok and not any(v)):
            continue
        out[i] = min(out.get(i, v), v)
    return out


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("pivots,first", [(8, 1), (2, 3)])
def test_top_k_is_exact(spark, monkeypatch, pivots, first):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, df.where("vec_id % 5 = 0"), k=5, pivots=pivots, first=first).collect()
    v = valid(rows, True)
    whole = {i: [math.floor(256.0 * c) for c in x] for i, x in v.items()}
    want = []
    for q in (i for i in whole if i % 5 == 0):
        order = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)[:5]
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(order)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_products_beyond_doubles_are_exact():
    q, x = np.array([[2.0 ** 30 + 1, 3.0]]), np.array([[2.0 ** 30 + 1, 5.0]])
    assert topk.exact_products(q, x)[0, 0] == (2 ** 30 + 1) ** 2 + 15


def test_neighbours(spark):
    rows = odd_vectors(1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in ann.neighbours(df, df.where("vec_id % 10 = 0"), k=5, degree=8, rounds=2).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = valid(rows, False)

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))
    hit = total = 0
    assert set(got) == {i for i in v if i % 10 == 0}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and len({f[1] for f in found}) == 5
        assert all(f[1] != q and math.isclose(f[2], cos(v[q], v[f[1]]), abs_tol=1e-12) for f in found)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        fifth = sorted((cos(v[q], v[c]) for c in v if c != q), reverse=True)[4]
        hit += sum(f[2] >= fifth - 1e-9 for f in found)
        total += 5
    assert hit / total >= 0.9
    # Copies: ties go to the smallest ids.
    assert [f[1] for f in got[0]] == [400, 401, 402, 403, 404]


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (7, [1.0, 1.0], 1)], SCHEMA)
    for found in (topk.top_k(df, df), ann.neighbours(df, df)):
        assert sorted((r.query_id, r.vec_id) for r in found.collect()) == [(0, 7), (0, 50), (7, 0), (7, 50), (50, 0), (50, 7)]
    none = df.limit(0)
    assert topk.top_k(none, none).collect() == [] and ann.neighbours(none, none).collect() == []


def test_rounds_go_on_until_lists_settle(spark, monkeypatch):
    # Blocks of 8 rows are a poor start for lists of 6: four rounds found 0.52 of the nearest five.
    monkeypatch.setattr(ann, "CELL", 8)
    x = np.random.default_rng(3).standard_normal((1200, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    nodes = ann.saved(ann.nodes_of(df, 1, "vec_id", "embedding"), "nodes")
    near = {r.node: set(r.near) for r in ann.build(nodes, 6, trees=2).collect()}
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    best = np.argsort(-sims, axis=1)[:, :5]
    assert np.mean([b in near[i] for i, row in enumerate(best.tolist()) for b in row]) >= 0.7


def test_search_goes_on_until_all_is_expanded(spark, monkeypatch):
    # Points along an arc that know three on either side: from one entry node an end is many hops away.
    monkeypatch.setattr(ann, "ENTRIES", 1)
    arc = spark.createDataFrame([(i, [math.cos(i / 20), math.sin(i / 20)], 0) for i in range(48)], SCHEMA)
    nodes = ann.saved(ann.nodes_of(arc, 1, "vec_id", "embedding"), "nodes")
    unit = {r.node: r.unit for r in nodes.collect()}
    graph = spark.createDataFrame([(i, js, [unit[j] for j in js]) for i in range(48)
                                   for js in [[j for j in range(i - 3, i + 4) if j != i and 0 <= j < 48]]],
                                  "node long, near array<long>, units array<binary>")
    asked = spark.createDataFrame([(0, unit[0], None), (47, unit[47], None)], "query_id long, unit binary, own long")
    found = ann.search(asked, nodes, graph, beam=4, expand=1).collect()
    assert {r.query_id: r.found[0].node for r in found} == {0: 0, 47: 47}


def test_start_does_not_depend_on_partitions(spark):
    # 600 vectors are one block; dealt over 64 partitions they were compared in blocks of about 10.
    x = np.random.default_rng(5).standard_normal((600, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        nodes = ann.saved(ann.nodes_of(df, 1, "vec_id", "embedding"), "nodes")
        near = {r.node: set(r.near) for r in ann.build(nodes, 8, rounds=0).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    best = np.argsort(-sims, axis=1)[:, :5]
    assert np.mean([b in near[i] for i, row in enumerate(best.tolist()) for b in row]) >= 0.99


def test_blocks_are_cut_at_cells(monkeypatch):
    monkeypatch.setattr(ann, "CELL", 4)
    cell = [0] * 3 + [1] * 13 + [2] * 8 + [5]
    whole = ann.pa.RecordBatch.from_pydict({"cell": cell, "node": list(range(len(cell)))})
    for size in (1, 5, 100):
        cut = [b for b in ann.blocks(ann.rows([whole], size))]
        assert [n for b in cut for n in b["node"].to_pylist()] == list(range(len(cell)))
        assert all(len(set(b["cell"].to_pylist())) == 1 and len(b) < 8 for b in cut)
        assert [len(b) for b in cut if b["cell"][0].as_py() == 1] == [4, 4, 5]
