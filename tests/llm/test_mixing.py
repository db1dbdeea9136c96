"""Mixing against a plain computation in Python."""

import hashlib
import math
import re

import pytest

from vendorscope.llm import mixing as M


def unit(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def plain(rows):
    """(doc_id, size, source_size, target, copies) of rows (doc_id, text, source)."""
    rows = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    names = sorted({s for _, _, s in rows if s is not None}) + [None] * any(s is None for _, _, s in rows)
    size = {n: sum(z for _, z, s in rows if s == n) for n in names}
    weight = {n: float(k % 3 + 1) for k, n in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size.values()))
    while open_:  # share out, hold those above their limit, share the rest again
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if weight[n] * level >= 3 * size[n]}
        if not over:
            target |= {n: weight[n] * level for n in open_}
            break
        target |= {n: 3.0 * size[n] for n in over}
        left -= sum(target[n] for n in over)
        open_ -= over
    out = []
    for n in names:
        mine = sorted((z, unit(M.SEED + ("-" if i is None else str(i))), (i is not None, i or 0)) for i, z, s in rows if s == n)
        rate = target[n] / size[n] if size[n] else 0.0
        u = unit(M.SEED + "/" + ("-" if n is None else "+" + n)) / 2 ** 32
        for p, (z, _, (has, i)) in enumerate(mine, 1):
            out.append((i if has else None, z, size[n], target[n], math.floor(p * rate + u) - math.floor((p - 1) * rate + u)))
    return sorted(out, key=str)


def got(df):
    rows = [(r.doc_id, r["size"], r.source_size, r.target, r.copies) for r in df.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("block", [4096, 2])
def test_odd_rows(odd_docs, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    mixed = M.with_copies(odd_docs)
    want = plain([(r.doc_id, r.text, r.source) for r in odd_docs.collect()])
    have = got(mixed)
    assert [r[:3] + r[4:] for r in have] == [r[:3] + r[4:] for r in want]
    assert all(math.isclose(a[3], b[3], rel_tol=1e-12) for a, b in zip(have, want))
    assert "count" in mixed.columns and "value" in mixed.columns


def test_targets_are_met_and_rows_repeat(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), "en", f"s{i % 4 if i % 3 else 0}", i) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    by = {}
    for r in M.with_copies(docs).collect():
        t = by.setdefault(r.source, [0, r.target])
        t[0] += r["size"] * r.copies
        assert 0 <= r.copies <= 3
    assert all(abs(t - want) <= 150 for t, want in by.values())
    again = M.repeated_rows(docs)
    assert again.columns == docs.columns
    assert again.count() == sum(r.copies for r in M.with_copies(docs).collect())


def test_empty(no_docs):
    assert M.with_copies(no_docs).collect() == []
    assert M.repeated_rows(no_docs).collect() == []
