"""The numbered element tree against a tree built on the standard library's parser, and what is read from it."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from vendorscope.functions import dom as D
from vendorscope.functions import html as H
from vendorscope.operators import pages as P
from vendorscope.operators import tables as TB
from vendorscope.operators import tokens as TK

NOISE = {"script", "style", "noscript", "svg"}


class _Tree(HTMLParser):
    """Elements as [tag, parent, children]; children are element numbers, ("text", ..) or ("other", ..)."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.elements, self.stack, self.top, self.run = [], [], [], []
        self.feed(page)
        self.close()
        self._end()

    def _add(self, child):
        (self.elements[self.stack[-1]][2] if self.stack else self.top).append(child)

    def _end(self):
        if self.run:
            self._add(("text", "".join(self.run)))
            self.run = []

    def handle_starttag(self, tag, attrs):
        self._end()
        self._add(len(self.elements))
        self.elements.append([tag, self.stack[-1] if self.stack else -1, []])
        if tag not in D.VOID:
            self.stack.append(len(self.elements) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in D.VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        self._end()
        if any(self.elements[k][0] == tag for k in self.stack):
            while self.elements[self.stack.pop()][0] != tag:
                pass

    def handle_data(self, data):
        if self.stack and self.elements[self.stack[-1]][0] in ("script", "style"):
            return
        self.run.append(data)

    def handle_entityref(self, name):
        self.run.append({"amp": "&", "lt": "<"}[name])

    def handle_charref(self, name):
        self.run.append(chr(int(name)))

    def handle_comment(self, data):
        self._end()
        self._add(("other", data))

    def texts(self, children, noise=True):
        for c in children:
            if isinstance(c, int):
                if noise or self.elements[c][0] not in NOISE:
                    yield from self.texts(self.elements[c][2], noise)
            elif c[0] == "text":
                yield c[1]

    def last(self, k):
        return max([k, *(self.last(c) for c in self.elements[k][2] if isinstance(c, int))])


NAMES = ["div", "p", "b", "svg", "table", "tr", "td", "li", "noscript", "div class='a'"]


def broken_page(rng, names):
    parts = []
    for _ in range(rng.randrange(1, 60)):
        n = rng.choice(names)
        parts.append(rng.choice([f"<{n}>", f"<{n}>", f"</{n.split()[0]}>", f"</{n.split()[0]}>", "text ", " a&amp;b&#65; ", "<br>", "<hr/>",
                                 "<p/>", "<!-- c <p> -->", "<script>if (a) { b('<p>') }</script>", "\n", f"<{n.upper()}>"]))
    return "".join(parts)


def pages(count=1000, names=NAMES):
    rng = random.Random(11)
    return [broken_page(rng, names) for _ in range(count)]


def test_tree_of_broken_pages():
    for page in pages():
        t = _Tree(page)
        nodes, texts, _ = D.walk(page)
        assert [(n[D.TAG], n[D.PARENT], n[D.LAST]) for n in nodes] == [
            (e[0], e[1], t.last(k)) for k, e in enumerate(t.elements)], page
        assert [x[0] for x in texts] == list(t.texts(t.top)), page
        for n, e in zip(nodes, t.elements):
            assert [x[0] for x in texts[n[D.T1 - 1]:n[D.T1]]] == list(t.texts(e[2])), page
            assert sum(len(x[0]) for x in texts[n[D.T1 - 1]:n[D.T1]]) == n[D.C1] - n[D.C1 - 1]


def test_lines_and_noise_of_broken_pages(spark):
    df = spark.createDataFrame(list(enumerate(pages(300))), "page_id long, html string")
    for r in df.select("html", H.html_lines("html").alias("lines"), H.html_lines(H.denoise("html")).alias("clean"),
                       H.denoise("html").alias("d")).collect():
        t = _Tree(r.html)
        want = [x.strip() for text in t.texts(t.top, noise=False) for x in text.splitlines() if x.strip()]
        assert r.lines == want == r.clean and "<svg" not in r.d.lower() and "<script" not in r.d, r.html


def test_noise_at_any_depth(spark):
    page = "a<svg>" * 9 + "<text>L</text>" + "</svg>" * 9 + "b<style>x</style><noscript><p>n</noscript>c<svg>open"
    r = spark.createDataFrame([(page,)], "h string").select(H.html_lines("h").alias("l"), H.denoise("h").alias("d")).first()
    assert r.l == ["a", "b", "c"] and r.d == "a\nb\n\nc\n"


def test_tables_of_broken_pages(spark):
    def plain(t, k, names):
        for c in t.elements[k][2]:
            if isinstance(c, int) and t.elements[c][0] not in NOISE:
                if t.elements[c][0] in names:
                    yield c
                yield from plain(t, c, names)

    def in_noise(t, k):
        return k >= 0 and (t.elements[k][0] in NOISE or in_noise(t, t.elements[k][1]))

    made = pages(400, ["table", "tr", "td", "th"] * 4 + ["svg", "p"])
    df = spark.createDataFrame(list(enumerate(made)), "page_id long, html string")
    got = {r.page_id: r.t for r in D.with_dom(df).select("page_id", TB.parse_tables(F.col("dom")).alias("t")).collect()}
    seen = 0
    for i, page in enumerate(made):
        t, want = _Tree(page), []
        for k, e in enumerate(t.elements):
            if e[0] == "table" and not in_noise(t, k):
                rows = [[" ".join(" ".join(x.split()) for x in t.texts(t.elements[c][2], noise=False) if x.strip())
                         for c in plain(t, r, ("td", "th"))] for r in plain(t, k, ("tr",))]
                want.append([r for r in rows if any(r)])
        assert got[i] == [x for x in want if x], page
        seen += len(got[i])
    assert seen > 30


def test_nested_table_keeps_outer_and_inner_rows(spark):
    page = ("<table><tr><td>1<table><tr><td>in</td></tr></table></td><td>2</td></tr><tr><td>3</td></tr></table>"
            "<table><tr><td>other</td></tr></table>")
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    got = {(r.table_idx, r.row_idx): [] for r in TB.table_cells(df).collect()}
    for r in sorted(TB.table_cells(df).collect()):
        got[r.table_idx, r.row_idx].append(r.cell)
    assert got == {(0, 0): ["1 in", "in", "2"], (0, 1): ["in"], (0, 2): ["3"], (1, 0): ["in"], (2, 0): ["other"]}


def climb(spark, inner, around):
    """Places of anchor and container of an h2 in nested divs, outermost first."""
    page = "".join(around) + "<h2>AI Overview</h2>" + inner + "</div>" * len(around)
    return TK.overview_container(spark.createDataFrame([(1, page)], "page_id long, html string"), anchors=["h2"]).first()


def test_climb(spark):
    plain, flag = "<div>", "<div data-attrid='x'>"
    cases = [([plain] * 3 + [flag], 3, "climb"), ([plain, flag] + [plain] * 4, 1, "climb"), ([flag] + [plain] * 6, 1, "climb"),
             ([flag] + [plain] * 5, 0, "climb"), ([plain] * 5, None, None), ([plain] * 6, 0, "climb"), (["<div data-attrid>"] + [plain] * 2, 0, "climb"),
             (["<div class='Kevs9 b'>"] + [plain] * 2, 0, "fallback"), (["<div class='xAIO'>"], 0, "fallback")]
    for around, place, how in cases:
        r = climb(spark, "", around)
        assert (r.anchor_pos, r.container_pos, r.how) == (len(around), place, how), around
    assert climb(spark, "<p><svg></svg></p>", [plain] * 3).container_pos == 2   # the nearest div holds the svg
    assert climb(spark, "", [plain + "<svg/>", plain, plain]).container_pos == 0


def test_end_tag_around_open_paragraphs_makes_a_block(spark):
    page = "<div class='Kevs9'><h2>AI Overview</h2><p>unclosed one<p>unclosed two</div>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "<p>x</p>")], "page_id long, html string")
    assert [r.overview_text for r in TK.overview_blocks(df).collect()] == ["unclosed two"]
    assert {r.page_id: r.status for r in TK.page_status(df).collect()} == {1: "ok", 2: "error", 3: "no_overview"}


def test_pages_are_never_shuffled(spark):
    df = spark.createDataFrame([(1, "<p>x</p>")], "page_id long, html string")
    for out in (TK.region_pick(df), TK.overview_blocks(df), TK.page_status(df), TK.overview_container(df), TB.table_cells(df), TK.tokens(df),
                TK.extents(df, "p"), P.page_to_answer(df, tables=True)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan
        assert plan.count("ArrowEvalPython") == 1  # each page is read once


def test_empty_and_odd_pages(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "no markup"), (4, "<"), (5, "<p"), (6, "</div></p>"), (None, "<div>")],
                               "page_id long, html string")
    assert {r.page_id: (r.n_lines, r.answer) for r in P.page_to_answer(df, tables=True).collect()}[3] == (1, "no markup")
    for out in (TK.region_pick(df), TK.overview_blocks(df), TK.page_status(df), TB.table_cells(df), TK.tokens(df), TK.extents(df, "div")):
        out.collect()
    assert TK.region_pick(df.limit(0)).collect() == []
