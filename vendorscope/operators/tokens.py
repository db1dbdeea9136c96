"""Token rows, element extents and DOM-region operators (HTM-5/6/9/10/14/15, WIN-2/4).

All of them are expressions on the page's numbered element tree (``functions/dom.py``): one row per page in, no join, no window and
no shuffle of HTML. "Inside" is a slice of the numbered elements, an ancestor an interval that holds a number, a region an
offset pair cut out of the page once.

Each step is a column of its own behind a fence, so nothing is computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import dom as D
from vendorscope.functions.text import WS, strip_ws
from vendorscope.operators.pages import BLOCK_FORM_RX, fence


def tokens(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """HTM-6 token rows: key, pos, kind, tag, token, char_start, char_len.

    kind: open / close / self / raw (script, style) / comment / decl / text.
    """
    rows = fence(pages.select(key, D.tokens_of(F.col(html)).alias("_tokens")))
    return rows.select(key, F.inline("_tokens"))


def extents(pages: DataFrame, tag: str | list[str], key: str = "page_id", html: str = "html") -> DataFrame:
    """HTM-6: extents of the elements of one or more tag names that have a content.

    Output: key, tag, start_pos, end_pos (null = open to page end; an element that an outer end tag closes ends there), depth (1 =
    outermost of its name), inner_start (char offset after the start tag), inner_end (char offset of the tag that ends it, null when
    open), token (the start tag).
    """
    tags = [tag] if isinstance(tag, str) else list(tag)
    d = D.with_dom(pages.select(key, html), html, ("tag", "token", "pos", "end_pos", "depth", "inner", "inner_end"))
    of = F.filter("dom.nodes", lambda n: n["tag"].isin(tags) & (n["end_pos"].isNull() | (n["end_pos"] > n["pos"])))
    e = d.select(key, F.explode(of).alias("n"))
    return e.select(key, "n.tag", F.col("n.pos").alias("start_pos"), "n.end_pos", "n.depth", F.col("n.inner").alias("inner_start"),
                    "n.inner_end", "n.token")


def inner_html(html: Column, n: Column) -> Column:
    """innerHTML of an element (to the end of the page when it is open)."""
    length = F.coalesce(n["inner_end"], F.length(html).cast("bigint")) - n["inner"]
    return F.substring(html, (n["inner"] + 1).cast("int"), length.cast("int"))


def selector_rank(n: Column, scopes: dict[str, Column]) -> Column:
    """Lowest-rank response selector that a div satisfies (null: none); ``scopes``: the divs of each id that a selector asks for around it."""
    out = F.lit(None).cast("int")
    for rank in reversed(range(1, len(fixed.RESPONSE_SELECTORS) + 1)):
        kind, name, value, scope = fixed.RESPONSE_SELECTORS[rank - 1]
        a = n[{"class": "cls", "data-attrid": "attrid", "id": "id"}[name]]
        hit = a.contains(value) if kind == "class" else (a == value)
        if scope is not None:
            hit = hit & F.exists(scopes[scope], lambda s: D.contains(s, n))
        out = F.when(F.coalesce(hit, F.lit(False)), F.lit(rank)).otherwise(out)
    return out


REGION_FIELDS = ("i", "tag", "inner", "inner_end", "last", "cls", "id", "attrid")


def with_region(pages: DataFrame, html: str = "html", min_chars: int = fixed.REGION_MIN_CHARS,
                body_min: int = fixed.BODY_MIN_CHARS, fields: tuple[str, ...] = ()) -> DataFrame:
    """HTM-5 + FLT-2 + WIN-2: ``pages`` with ``selector_rank``, ``region_html``, ``region`` (the element) and ``dom``.

    First selector in rank order, first element in document order whose
    stripped innerHTML is longer than ``min_chars``; else the body when its
    stripped innerHTML is longer than ``body_min`` (rank 0). All are null where there is none. Candidates are
    ordered inside the row and cut out of the page until one is long enough. ``fields``: what the caller needs of the tree's elements.
    """
    cols = pages.columns
    page, nodes = F.col(html), F.col("dom.nodes")
    d = D.with_dom(pages, html, (*REGION_FIELDS, *fields))

    def of_id(scope: str) -> Column:
        return F.filter(nodes, lambda n: (n["tag"] == "div") & F.coalesce(n["id"] == scope, F.lit(False)))

    asked = list(dict.fromkeys(s[3] for s in fixed.RESPONSE_SELECTORS if s[3] is not None))
    d = fence(d.select(*cols, "dom", *[of_id(s).alias(f"_in_{k}") for k, s in enumerate(asked)]))
    scopes = {s: F.col(f"_in_{k}") for k, s in enumerate(asked)}
    ranked = F.transform(F.filter(nodes, lambda n: (n["tag"] == "div") & F.coalesce(n["cls"], n["id"], n["attrid"]).isNotNull()),
                         lambda n: F.struct(selector_rank(n, scopes).alias("rank"), n["i"].alias("i"), n["inner"].alias("inner"),
                                            n["inner_end"].alias("inner_end")))
    end = F.length(page).cast("bigint")
    may = F.array_sort(F.filter(ranked, lambda c: c["rank"].isNotNull() & (F.coalesce(c["inner_end"], end) - c["inner"] > min_chars)))
    cut = lambda c: strip_ws(inner_html(page, c))
    body = F.get(F.filter(nodes, lambda n: n["tag"] == "body"), 0)
    d = fence(d.select(*cols, "dom", may.alias("_may"), body.alias("_body")))
    first = F.aggregate("_may", F.lit(-1), lambda found, c: F.when(found >= 0, found).when(
        F.length(cut(c)) > min_chars, c["i"]).otherwise(found))
    d = fence(d.select(*cols, "dom", "_may", "_body", first.alias("_i")))
    rank = F.get(F.filter("_may", lambda c: c["i"] == F.col("_i")), 0)["rank"]
    d = fence(d.select(*cols, "dom", rank.alias("_rank"), F.when(F.col("_i") >= 0, F.get(nodes, F.col("_i"))).otherwise(
        F.col("_body")).alias("_node")))
    d = fence(d.select(*cols, "dom", "_rank", "_node", cut(F.col("_node")).alias("_cut")))
    some = F.col("_rank").isNotNull() | (F.length("_cut") > body_min)
    out = [c for c in cols if c not in ("selector_rank", "region_html", "region", "dom")]
    return fence(d.select(*out, "dom", F.when(some, F.coalesce("_rank", F.lit(0))).cast("bigint").alias("selector_rank"),
                          F.when(some, F.col("_cut")).alias("region_html"), F.when(some, F.col("_node")).alias("region")))


def region_pick(pages: DataFrame, key: str = "page_id", html: str = "html",
                min_chars: int = fixed.REGION_MIN_CHARS, body_min: int = fixed.BODY_MIN_CHARS) -> DataFrame:
    """The response region of each page: key, selector_rank (0 = body, null = nothing), region_html."""
    return with_region(pages.select(key, html), html, min_chars, body_min).select(key, "selector_rank", "region_html")


def _places(text: Column, phrase: str) -> Column:
    """Character offsets at which ``phrase`` starts in a text."""
    pieces = F.split(text, r"\Q" + phrase + r"\E", -1)
    n = len(phrase)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda _, i: F.aggregate(
        F.slice(pieces, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)) + i * n)


def with_overview(pages: DataFrame, html: str = "html", anchors: list[str] = fixed.OVERVIEW_ANCHOR_TAGS) -> DataFrame:
    """HTM-9 + HTM-10: ``pages`` with their ``dom``, the overview's ``anchor`` and ``container`` (elements, null if there is none) and ``how``.

    The anchor is the first element of the ``anchors`` tags whose text, put together over tags and character references, holds the phrase;
    with ``div`` among them it is the outermost one, so only other anchors have divs to climb. From
    its enclosing div, climb at most 5 times, stopping at a div that has ``data-attrid`` or an ``svg`` inside; the 6th enclosing div
    is taken unchecked; with no enclosing div left, fall back to ``div.Kevs9``, then to a div of whose classes one matches
    ``AI_Overview|AIO``.
    """
    cols = pages.columns
    d = D.with_dom(pages, html)
    phrase, nodes = fixed.OVERVIEW_ANCHOR_TEXT, F.col("dom.nodes")
    whole = F.array_join(F.transform("dom.texts", lambda t: t["text"]), "")
    d = fence(d.select(*cols, "dom", whole.alias("_whole")))
    d = fence(d.select(*cols, "dom", _places(F.col("_whole"), phrase).alias("_at")))
    first = F.get(F.filter(nodes, lambda n: n["tag"].isin(anchors) & F.exists(
        "_at", lambda p: (p >= n["c0"]) & (p + len(phrase) <= n["c1"]))), 0)
    d = fence(d.select(*cols, "dom", F.when(F.size("_at") > 0, first).alias("anchor")))
    around = F.reverse(F.filter(nodes, lambda n: (n["tag"] == "div") & D.contains(n, F.col("anchor"))))
    d = fence(d.select(*cols, "dom", "anchor", F.when(F.col("anchor").isNotNull(), around).alias("_up")))
    steps = fixed.OVERVIEW_CLIMB_STEPS
    stops = F.filter(F.slice("_up", 1, steps), lambda n: n["attrid"].isNotNull() | F.exists(
        D.within(nodes, n), lambda x: x["tag"] == "svg"))
    classes = lambda n: F.split(n["cls"], WS + "+")
    named = F.filter(nodes, lambda n: (n["tag"] == "div") & F.coalesce(
        F.array_contains(classes(n), fixed.OVERVIEW_FALLBACK_CLASS), F.lit(False)))
    like = F.filter(nodes, lambda n: (n["tag"] == "div") & F.coalesce(F.exists(
        classes(n), lambda c: c.rlike(fixed.OVERVIEW_FALLBACK_CLASS_PATTERN)), F.lit(False)))
    d = fence(d.select(*cols, "dom", "anchor", F.coalesce(F.get(stops, 0), F.get("_up", steps)).alias("_climbed")))
    held = F.when(F.col("anchor").isNotNull(), F.coalesce("_climbed", F.get(named, 0), F.get(like, 0)))
    d = fence(d.select(*cols, "dom", "anchor", "_climbed", held.alias("container")))
    how = F.when(F.col("_climbed").isNotNull(), "climb").when(F.col("container").isNotNull(), "fallback")
    return d.select(*cols, "dom", "anchor", "container", how.alias("how"))


def overview_container(pages: DataFrame, key: str = "page_id", html: str = "html",
                       anchors: list[str] = fixed.OVERVIEW_ANCHOR_TAGS) -> DataFrame:
    """HTM-9 + HTM-10: key, anchor_pos, container_pos (null = not found), how; one row per page that has the anchor."""
    o = with_overview(pages.select(key, html), html, anchors).where(F.col("anchor").isNotNull())
    return o.select(key, F.col("anchor.pos").alias("anchor_pos"), F.col("container.pos").alias("container_pos"), "how")


def _kept(dom: Column, container: Column) -> Column:
    """Elements of the container outside what the clean-up (HTM-14) drops within it."""
    return F.filter(D.within(dom["nodes"], container), lambda n: n["drop"] <= container["i"])


def overview_sanitize(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """HTM-14: start tags and texts of the overview container left after dropping style, links,
    aria-hidden subtrees and badge classes. Output: key, pos, kind (open / text), tag, token (start tag, or decoded text)."""
    o = fence(with_overview(pages.select(key, html), html).where(F.col("container").isNotNull()))
    dom, box = F.col("dom"), F.col("container")
    starts = F.transform(_kept(dom, box), lambda n: F.struct(n["pos"].alias("pos"), F.lit("open").alias("kind"), n["tag"].alias("tag"),
                                                             n["token"].alias("token")))
    left = F.filter(D.texts_of(dom["texts"], box), lambda t: F.get(dom["nodes"], t["owner"])["drop"] <= box["i"])
    texts = F.transform(left, lambda t: F.struct(t["pos"].alias("pos"), F.lit("text").alias("kind"),
                                                 F.lit(None).cast("string").alias("tag"), t["text"].alias("token")))
    return o.select(key, F.inline(F.array_sort(F.concat(starts, texts))))


def overview_text(dom: Column, container: Column) -> Column:
    """HTM-14 + HTM-15 + FLT-6 + WIN-4 on a page's tree: the container's clean text blocks, joined by a blank line ("" without any)."""
    leaves = F.filter(_kept(dom, container), lambda n: n["tag"].isin(fixed.OVERVIEW_LEAF_TAGS) & (n["single"] >= 0))
    blocks = F.transform(leaves, lambda n: strip_ws(F.get(dom["texts"], n["single"])["text"]))

    def shown(b: Column) -> Column:
        lower, stop = F.lower(b), F.lit(False)
        for p in fixed.OVERVIEW_STOP_PHRASES:
            stop = stop | lower.contains(p)
        return (b != "") & ~stop

    return F.array_join(F.array_distinct(F.filter(blocks, shown)), "\n\n")


def overview_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """HTM-14 + HTM-15 + FLT-6 + WIN-4: clean text blocks of the overview container.

    Inside the container, subtrees of ``style``, ``a``, ``aria-hidden="true"``
    and badge classes are dropped; ``p/li/div/span`` elements that hold one text and nothing else but elements around it
    give a block (stripped); the first of equal blocks
    is kept, blocks holding a stop phrase are dropped; blocks are joined by a
    blank line. Output: key, overview_text; pages without a block have no row.
    """
    o = with_overview(pages.select(key, html), html)
    text = F.when(F.col("container").isNotNull(), overview_text(F.col("dom"), F.col("container")))
    return fence(o.select(key, text.alias("overview_text"))).where(F.col("overview_text") != "")


def page_status(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """FLT-5 + FLT-8: outcome per page: error / blocked / no_overview / container_unparsed / empty_text / ok.

    A page that was not fetched (null HTML) is an ``error``.
    """
    o = with_overview(pages.select(key, html), html)
    lines = F.array_join(F.transform(F.filter("dom.texts", lambda t: ~t["noise"]), lambda t: strip_ws(t["text"])), "\n")
    o = fence(o.select(key, F.col(html).isNull().alias("_error"), (F.col(html).rlike(BLOCK_FORM_RX) | lines.contains(fixed.BLOCK_TEXT)).alias("_blocked"),
                       F.col("anchor").isNotNull().alias("_anchor"), F.col("container").isNotNull().alias("_box"),
                       F.when(F.col("container").isNotNull(), overview_text(F.col("dom"), F.col("container"))).alias("_text")))
    status = (F.when(F.col("_error"), "error").when(F.col("_blocked"), "blocked").when(~F.col("_anchor"), "no_overview")
              .when(~F.col("_box"), "container_unparsed").when(strip_ws(F.col("_text")) == "", "empty_text").otherwise("ok"))
    return o.select(key, status.alias("status"))
