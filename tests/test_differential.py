"""Differential test: page lines from the Spark column chain vs a stdlib html.parser walk."""

import html
from html.entities import name2codepoint
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vendorscope.functions import html as H

NOISE = {"script", "style", "noscript", "svg"}


class _Walk(HTMLParser):
    """Text nodes in document order; a tag or comment ends a node; noise subtrees are skipped."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.nodes, self.buf, self.skip = [], [], []

    def _flush(self):
        if self.buf:
            self.nodes.append("".join(self.buf))
            self.buf = []

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in NOISE:
            self.skip.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._flush()

    def handle_endtag(self, tag):
        self._flush()
        if self.skip and self.skip[-1] == tag:
            self.skip.pop()

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def _text(self, s):
        if not self.skip:
            self.buf.append(s)

    def handle_data(self, data):
        self._text(data)

    def handle_entityref(self, name):
        # Known names decode (with or without ";"); unknown ones stay "&name" (";" consumed).
        self._text(chr(name2codepoint[name]) if name in name2codepoint else f"&{name}")

    def handle_charref(self, name):
        self._text(html.unescape(f"&#{name};"))


def brute_lines(doc: str) -> list[str]:
    w = _Walk()
    w.feed(doc)
    w.close()
    w._flush()
    text = "\n".join(w.nodes)
    return [ln.strip() for ln in text.splitlines() if ln.strip()]


@pytest.mark.parametrize("sf", [SF_SMALL, "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_lines_match_stdlib_walk(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html")
    got = {r.page_id: (r.html, r.lines) for r in
           pages.select("page_id", "html", H.html_lines(F.col("html")).alias("lines")).toLocalIterator()}
    bad = [pid for pid, (doc, lines) in got.items() if lines != brute_lines(doc)]
    assert not bad, bad[:5]
