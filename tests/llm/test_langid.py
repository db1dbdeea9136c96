"""Language identification: held-out accuracy, mixtures, awkward rows."""

import zlib

from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from vendorscope.llm import langid as L
from vendorscope.llm.common import table


def test_held_out_accuracy_and_mixtures(spark):
    docs = table(spark, SF_CHECK, "documents")
    model = L.train(docs.where(~L.held_out(F.col("doc_id"))))
    found = L.identified(docs, model).withColumn("held", L.held_out(F.col("doc_id"))).collect()
    test = [r for r in found if r.held and r.lang is not None]
    assert {r.doc_id for r in found if r.held} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in test) / len(test) > 0.97
    assert all(0 <= r.score <= 1 for r in found)
    by = {}
    for r in found:
        if r.lang_pred == r.lang and r.text and len(r.text) > 800:
            by.setdefault(r.lang, r.text[:1500])
    a, b = list(by)[:2]
    name, score, parts = model.predict(by[a][:1500] + "\n" + by[b][:500])
    assert name == a and b in parts and 0.55 < score < 0.95


def test_odd_rows(odd_docs, no_docs):
    model = L.train(odd_docs)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in L.identified(odd_docs, model).collect()}
    assert got[(40, None)] == got[(41, "")] == got[(42, " \t\n ")] == ("und", 0.0)
    assert len(got) and L.identified(odd_docs, model).count() == odd_docs.count()
    assert L.identified(no_docs, model).collect() == []
    nothing = L.train(no_docs)
    assert {r.lang_pred for r in L.identified(odd_docs, nothing).collect()} == {"und"}
    kept = L.accepted(odd_docs)
    assert kept.columns == odd_docs.columns and not {40, 41, 42} & {r.doc_id for r in kept.collect()}
    assert L.accepted(no_docs).collect() == []


def test_trigrams():
    assert len(L.trigrams("12 34 .")) == 0 and len(L.trigrams(None)) == 0
    assert len(L.trigrams("a")) == 1 and (L.trigrams("Ab 1 c") == L.trigrams("ab--C")).all()


def test_unlearned_languages_are_rejected(spark):
    docs = table(spark, SF_CHECK, "documents").select("doc_id", "text", "lang")
    finnish = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
               "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. ") * 3
    georgian = "ყველა ადამიანი იბადება თავისუფალი და თანასწორი თავისი ღირსებითა და უფლებებით. " * 4
    odd = [(10 ** 9, finnish, None), (10 ** 9 + 1, georgian, None), (10 ** 9 + 2, "zqxj kvwq xxzj qqvk wzjx " * 20, None)]
    kept = L.accepted(docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string")))
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & {r[0] for r in odd}
    lettered = docs.where(F.col("text").rlike(r"\p{L}")).count()
    assert kept.where(F.col("doc_id") < 10 ** 9).count() >= 0.99 * lettered
