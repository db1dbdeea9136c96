"""The pipeline's stages on awkward rows and on nothing, and its guards."""

import corpus_pipeline as C


def test_stages_chain(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in C.STAGES:
        before = docs
        docs = stage(spark, docs, "")
        if name != C.STAGES[-1][0]:
            assert docs.columns == before.columns, name
            docs = spark.createDataFrame(docs.collect(), before.schema)
    rows = sorted(docs.collect(), key=lambda r: (r.sequence_id, r.offset))
    assert sum(r.length for r in rows) == (rows[-1].sequence_id * 2048 + rows[-1].offset + rows[-1].length)
    assert {r.doc_id for r in rows} <= {r.doc_id for r in odd_docs.collect()}


def test_empty(spark, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []


def test_every_query_is_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
