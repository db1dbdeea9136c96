"""WARC archives: exact round trip, pushed filters, skipped payloads, foreign files."""

import gzip
import hashlib

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from vendorscope.llm import archives as A
from vendorscope.llm import warc as W


@pytest.fixture()
def pages(spark):
    big, huge = "é" * 700, "<p>" + "x" * 300000
    rows = [(1, "u1", big), (2, None, big), (9, "u9", big), (9, "again", big), (3, "u3", "small"), (4, "u4", "small"), (5, "u\r\n5", None),
            (6, "u6", ""), (7, "u7", huge), (8, "u8", huge), (None, "n", big), (10, "u", "a\r\n\r\nb" * 300), (11, "w", "WARC/1.1\r\n\r\n" * 200)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


def test_round_trip(spark, pages, tmp_path):
    path = A.write_archive(A.page_records(pages), f"file://{tmp_path}/w")
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    want = []
    for i, body in rows:
        most = max((j for j, b in rows if b == body and j is not None), default=None)
        again = len(body) >= 1000 and i != most
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", most if again else None))
    assert sorted(map(tuple, A.page_summary(spark, path).collect()), key=str) == sorted(want, key=str)
    back = A.read_archive(spark, path)
    kept = {bytes(r.payload) for r in back.where("record_type = 'response'").collect()}
    assert kept == {b for _, b in rows}
    assert {r.payload for r in A.read_archive(spark, path, payload=False).collect()} == {None}
    assert back.where("refers_to is not null and record_type in ('revisit')").count() == sum(w[3] == "revisit" for w in want)


def test_filters_are_taken_over(tmp_path):
    reader = W.WarcReader({"path": str(tmp_path)}, ["record_id"])
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("payload_digest",), ("a", "b")),
                                    GreaterThan(("content_length",), 3), EqualTo(("payload",), b"x")]))
    assert [type(f).__name__ for f in left] == ["GreaterThan", "EqualTo"]
    assert reader.passes({"record_type": "response", "payload_digest": "a"})
    assert not reader.passes({"record_type": "revisit", "payload_digest": "a"})


@pytest.mark.parametrize("kind", ["plain", "gzip members", "one gzip member"])
def test_foreign_archives(spark, tmp_path, kind):
    bodies = [b"first", b"x" * 200000, b"", b"WARC/1.0\r\n\r\nnested"]
    records = [b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:%d>\r\nX-Long: a\r\n b\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
               % (i, len(b), b) for i, b in enumerate(bodies)]
    if kind == "plain":
        (tmp_path / "a.warc").write_bytes(b"".join(records))
    elif kind == "gzip members":
        (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    else:
        (tmp_path / "a.warc.gz").write_bytes(b"".join(W.member(r, 1) for r in records))
    df = A.read_archive(spark, str(tmp_path))
    assert [bytes(r.payload) for r in df.orderBy("record_id").collect()] == bodies
    assert df.where("record_id = '<urn:3>'").count() == 1
    assert A.read_archive(spark, str(tmp_path), payload=False).count() == 4


def test_empty(spark, pages, tmp_path):
    path = A.write_archive(A.page_records(pages.limit(0)), str(tmp_path / "none"))
    assert A.page_summary(spark, path).collect() == []
