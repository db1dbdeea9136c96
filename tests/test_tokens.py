"""Golden cases for token rows, extents, region pick and the overview pipeline."""

from vendorscope.operators import tokens as TK

HTML_REGION = ('<html><body><div id="search"><div class="x">short</div><div data-attrid="AIResponse">' + "A" * 60
               + '</div></div><div class="kp-blk">' + "k" * 70 + "</div></body></html>")
HTML_NESTED_ANCHOR = ('<body><div><div data-attrid="x"><h2>AI Overview</h2><div><p>First block</p></div></div>'
                      "</div></body>")
HTML_BODY = "<body><p>" + "x" * 120 + "</p></body>"
HTML_SCOPED = ('<div class="g">' + "y" * 80 + '</div><div id="rso"><div><div class="abg c">' + "z" * 80
               + "</div></div></div>")
HTML_OVERVIEW = ('<body><div class="Kevs9 z"><h2>AI Overview</h2><p>First block</p><p><b>Bold one</b></p>'
                 '<span>Second</span><a href="#">link</a><p>First block</p><div aria-hidden="true"><p>hidden</p>'
                 '</div><p>Show more</p><p>kept <a>x</a></p><li class="source">drop</li></div></body>')


def pages(spark):
    rows = [(1, HTML_REGION), (2, HTML_NESTED_ANCHOR), (3, HTML_BODY), (4, HTML_SCOPED), (5, HTML_OVERVIEW)]
    return spark.createDataFrame(rows, "page_id long, html string")


def test_extents_nesting(spark):
    ext = {r.start_pos: (r.end_pos, r.depth) for r in TK.extents(pages(spark).where("page_id = 1"), "div").collect()}
    assert ext == {2: (9, 1), 3: (5, 2), 6: (8, 2), 10: (12, 1)}


def test_token_offsets_cover_page(spark):
    df = pages(spark)
    tok = TK.tokens(df)
    got = {r.page_id: r.n for r in tok.groupBy("page_id").agg({"char_len": "sum"}).withColumnRenamed(
        "sum(char_len)", "n").collect()}
    assert got == {r.page_id: len(r.html) for r in df.collect()}


def test_region_pick(spark):
    got = {r.page_id: (r.selector_rank, (r.region_html or "")[:3]) for r in TK.region_pick(pages(spark)).collect()}
    assert got[1] == (2, "AAA")          # data-attrid beats the lower-ranked id=search
    assert got[3] == (0, "<p>")          # body fallback
    assert got[4] == (8, "zzz")          # class "g" only counts inside div#rso
    assert got[2] == (None, "")          # body under the 100-char floor: no region


def test_overview_outermost_anchor_has_no_parent(spark):
    status = {r.page_id: r.status for r in TK.page_status(pages(spark)).collect()}
    assert status[2] == "container_unparsed"
    assert status[1] == "no_overview"
    assert status[5] == "ok"


def test_overview_blocks(spark):
    got = TK.overview_blocks(pages(spark).where("page_id = 5")).first()["overview_text"]
    assert got == "First block\n\nBold one\n\nSecond\n\nkept"


def test_overview_sanitize_drops_subtrees(spark):
    kept = [r.token for r in TK.overview_sanitize(pages(spark).where("page_id = 5")).orderBy("pos").collect()
            if r.kind == "text"]
    assert "link" not in kept and "hidden" not in kept and "drop" not in kept and "x" not in kept
    assert "Bold one" in kept and "Second" in kept
