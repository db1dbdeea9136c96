"""Pipeline stages on extra columns of any name and type, on repeated ids and without ids, each against brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.llm.conftest import words
from tests.llm.test_mixing import plain as plain_mix
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_substrings import plain as plain_cut
from vendorscope.llm import langid, mixing, simhash, substrings

ODD = ("doc_id long, text string, lang string, source string, n_chars long, `a.b` string, `m` map<string,int>, `x y` struct<`p q`:int,r:string>, "
       "`__row` long, `count` int, `kept` string, `component_id` string, `tick``ed` int")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    base = [words(rng, 60) for _ in range(8)]
    rows = [(i, t, "en", "a" if i % 2 else None, len(t)) for i, t in enumerate(base)]
    rows += [(1, base[5], "en", "a", 1), (1, words(rng, 50), "en", "b", 2), (1, base[1], "en", "a", 3)]        # one id, other texts
    rows += [(None, base[2], "en", "a", 4), (None, words(rng, 70), "en", "b", 5), (None, None, None, None, None), (20, None, "de", "b", 0), (21, "", "de", "c", 0)]
    rows += [(22, words(rng, 4000), "en", "c", 6)]
    extra = [("v", {"k": i}, (i, "r"), i % 3, i, "k", "c", i) for i in range(len(rows))]
    return spark.createDataFrame([(*r, *e) for r, e in zip(rows, extra)], ODD).repartition(3)


def line(r):
    """A row with its extra columns, as text; the number in the last column tells the rows apart."""
    return str((r["tick`ed"], r.doc_id, r["a.b"], r.m, r["x y"]["p q"], r["__row"], r["count"], r.kept, r.component_id))


def test_one_row_of_each_group_stays(spark, docs):
    rows = docs.collect()
    fps = {r["tick`ed"]: plain_fingerprint(r.text) for r in rows}
    root = plain_components(set(fps.values()), [(a, b) for a, b in combinations(set(fps.values()), 2) if bin(a ^ b).count("1") <= 4])
    groups = {}
    for r in rows:
        groups.setdefault(root[fps[r["tick`ed"]]], []).append(r)
    out = simhash.first_of_each(docs)
    assert out.dtypes == docs.dtypes
    got = out.collect()
    assert len(got) == len(groups) and {line(r) for r in got} <= {line(r) for r in rows}
    for r in got:  # the smallest id of its group; null only where all are
        mine = groups.pop(root[fps[r["tick`ed"]]])
        ids = [x.doc_id for x in mine if x.doc_id is not None]
        assert r.doc_id == (min(ids) if ids else None)
    assert not groups


def test_substrings(spark, docs):
    rows = docs.collect()
    want = {r["tick`ed"]: p for r, p in zip(rows, plain_cut([r.text for r in rows], 35))}
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows) and sorted(map(line, got)) == sorted(map(line, rows))
    texts = {r["tick`ed"]: r.text for r in rows}
    for r in got:
        n, gone, kept = want[r["tick`ed"]]
        assert r.text == (kept.decode() if gone else texts[r["tick`ed"]])
    marked = substrings.marked_words(docs)
    assert marked.columns == [c for c in docs.columns if c != "kept"] + ["n_words", "n_removed", "kept"]


def test_mixing(spark, docs):
    rows = docs.collect()
    copies = {}
    for i, size, _, _, n in plain_mix([(r.doc_id, r.text, r.source) for r in rows]):
        copies[i, size] = copies.get((i, size), 0) + n
    out = mixing.repeated_rows(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert {line(r) for r in got} <= {line(r) for r in rows}
    have = {}
    for r in got:
        k = (r.doc_id, len((r.text or "").split()))
        have[k] = have.get(k, 0) + 1
    assert have == {k: n for k, n in copies.items() if n}


def test_language(spark, docs):
    out = langid.accepted(docs)
    assert out.columns == docs.columns
    got, rows = out.collect(), docs.collect()
    assert {line(r) for r in got} <= {line(r) for r in rows}
    learned = docs.where(~langid.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    model = langid.train(learned)
    usual = langid.levels(learned, model)
    keep = set()
    for r in rows:
        name, score, parts = model.predict(r.text)
        if name != "und" and score >= 0.5 and model.known(r.text, parts, usual):
            keep.add(line(r))
    assert {line(r) for r in got} == keep and keep
    found = langid.identified(docs, model)
    assert found.columns == [*docs.columns, "lang_pred", "score", "proportions"] and found.count() == len(rows)


def plain_share(text, model):
    """Proportions of all languages by plain expectation-maximisation, and the best single language."""
    x = langid.trigrams(text)
    k = len(model.names)
    share = [1 / k] * k
    for _ in range(60):
        new = [0.0] * k
        for b in x:
            p = [share[j] * model.p[b, j] for j in range(k)]
            total = sum(p)
            for j in range(k):
                new[j] += p[j] / total
        share = [v / len(x) for v in new]
    return share


def test_mixture_inference_against_plain_loops(spark):
    rng = random.Random(4)
    pools = [["alpha", "beta", "gamma", "delta"], ["uno", "dos", "tres", "cuatro"], ["ichi", "ni", "san", "shi"]]
    rows = [(k, " ".join(rng.choice(pools[k % 3]) for _ in range(30)), "abc"[k % 3]) for k in range(60)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for a, b, n in ((0, 1, 30), (1, 2, 20), (2, 0, 12), (0, 0, 30), (1, 1, 5)):
        text = " ".join([rng.choice(pools[a]) for _ in range(n)] + [rng.choice(pools[b]) for _ in range(n)])
        name, score, parts = model.predict(text)
        share = plain_share(text, model)
        assert set(parts) == {"abc"[a], "abc"[b]}
        assert all(abs(share["abc".index(x)] - v) < 0.06 for x, v in parts.items()), (parts, share)
        assert name in ("abc"[a], "abc"[b]) and 0 < score <= 1


def test_stages_on_given_documents(spark):
    """All stages on the smallest table: what near-duplicates keeps and substrings cuts, by brute force on each stage's own input."""
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    one = C.language(spark, docs, SF_SMALL)
    kept = spark.createDataFrame(one.collect(), one.schema)
    rows = kept.collect()
    assert len(rows) > 0.7 * docs.count()
    two = C.near_duplicates(spark, kept, SF_SMALL)
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    values = set(fps.values())
    root = plain_components(values, [(a, b) for a, b in combinations(values, 2) if bin(a ^ b).count("1") <= 4])
    least = {}
    for i, fp in fps.items():
        least[root[fp]] = min(i, least.get(root[fp], i))
    firsts = two.collect()
    assert sorted(r.doc_id for r in firsts) == sorted(least.values())
    three = C.substrings(spark, spark.createDataFrame(firsts, two.schema), SF_SMALL).collect()
    want = {r.doc_id: p for r, p in zip(firsts, plain_cut([r.text for r in firsts], 35))}
    texts = {r.doc_id: r.text for r in firsts}
    assert {r.doc_id: r.text for r in three} == {i: (k.decode() if g else texts[i]) for i, (_, g, k) in want.items()}
    four = C.mixing(spark, spark.createDataFrame(three, two.schema), SF_SMALL).collect()
    copies = {i: n for i, _, _, _, n in plain_mix([(r.doc_id, r.text, r.source) for r in three]) if n}
    have = {}
    for r in four:
        have[r.doc_id] = have.get(r.doc_id, 0) + 1
    assert have == copies
