"""HTML -> text as column expressions.

One page is one row and never leaves its partition. The page is read once by the walk in ``dom.py``; lines, anchors and the answer slice
are higher-order functions on what it returns.

Text model: a tag, comment or declaration separates text nodes; text nodes
are split into lines, stripped, and empty lines dropped. Script, style,
noscript and svg subtrees carry no text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import dom
from vendorscope.functions.text import LINE_BREAK, WS, _c, single_line, strip_ws

# Tag pattern with possessive quantifiers: linear on hostile input (many
# unclosed "<a"), quoted attribute values may hold ">".
ATTRS = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
TAG = rf"</?[A-Za-z!?]{ATTRS}>"
# A comment that is never closed runs to the end, so nothing is scanned twice.
COMMENT = r"(?s)<!--.*?(?:-->|\z)"


def denoise(c) -> Column:
    """Remove script/style/noscript/svg elements at any depth (each outermost one replaced by a line break); an open one runs to the end."""
    return dom.denoised(_c(c))


def decode_entities(c) -> Column:
    """Decode all character references of HTML 5, by name and by number, in one pass; what names nothing stays."""
    return dom.decoded(_c(c))


def text_lines(text) -> Column:
    """Split text into stripped, non-empty lines (array<string>)."""
    parts = F.split(_c(text), LINE_BREAK)
    return F.filter(F.transform(parts, lambda x: strip_ws(x)), lambda x: x != "")


def html_lines(html) -> Column:
    """HTML -> array of clean text lines (noise removed, tags split text nodes)."""
    return text_lines(dom.page_text(_c(html))["text"])


def full_text(lines) -> Column:
    return F.array_join(_c(lines), "\n")


def title_text(html) -> Column:
    """Decoded, stripped text of the page ``<title>``."""
    return single_line(dom.page_text(_c(html))["title"])


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def answer_start(lines, question, lower_lines=None) -> Column:
    """1-based index of the first line after the answer anchor, null without an anchor.

    ``you said:`` (whole line) wins over the first line containing the question;
    the line following the anchor's own line is skipped. ``question`` should be a
    plain column (it is read inside a lambda).
    """
    ll = F.transform(_c(lines), lambda x: F.lower(x)) if lower_lines is None else lower_lines
    q = F.coalesce(F.lower(strip_ws(question)), F.lit(""))
    a1 = F.array_position(ll, "you said:")
    a2 = F.when(q != "", F.array_position(F.transform(ll, lambda x: x.contains(q)), True))
    return F.when(a1 > 0, a1 + 2).when(a2 > 0, a2 + 1)


def _tail(arr, start) -> Column:
    """Elements from 1-based ``start`` to the end (empty past the end, null start -> null)."""
    n = F.size(arr)
    return F.when(start.isNotNull() & (start >= 1),
                  F.slice(arr, start, F.greatest(n - start + 1, F.lit(0))))


def _first_kept(ll, first) -> Column:
    skip = _lit_array(fixed.SKIP_EXACT)
    kk = F.array_position(F.transform(_tail(ll, first), lambda x: ~F.array_contains(skip, x)), True)
    return F.when(kk > 0, first + kk - 1)


def _footer_end(lines, ll, k) -> Column:
    markers = _lit_array(fixed.FOOTER_MARKERS)
    ff = F.array_position(
        F.transform(_tail(ll, k), lambda x: F.exists(markers, lambda m: x.contains(m))), True)
    return F.when(ff > 0, k + ff - 1).otherwise(F.size(lines) + 1)


def _answer_between(lines, k, end) -> Column:
    skip = _lit_array(fixed.SKIP_EXACT)
    body = F.when(k.isNotNull() & (end > k), F.slice(lines, k, end - k)) \
        .otherwise(F.array().cast("array<string>"))
    kept = F.filter(body, lambda x: ~(~x.rlike(WS) & F.array_contains(skip, F.lower(x))))
    return F.coalesce(single_line(F.array_join(kept, "\n")), F.lit(""))


def with_answer_slice(df, lines: str, question: str, out: str = "answer_only"):
    """HTM-7 staged: lower-cased lines, anchor, first kept line, footer cut, then the paragraph.

    Each index is its own column, so no index expression is re-evaluated
    inside another; every line is visited a constant number of times.
    """
    lc = F.col(lines)
    df = df.withColumn("_ll", F.transform(lc, lambda x: F.lower(x)))
    df = df.withColumn("_first", answer_start(lc, F.col(question), F.col("_ll")))
    df = df.withColumn("_k", _first_kept(F.col("_ll"), F.col("_first")))
    df = df.withColumn("_end", _footer_end(lc, F.col("_ll"), F.col("_k")))
    return df.withColumn(out, _answer_between(lc, F.col("_k"), F.col("_end"))) \
        .drop("_ll", "_first", "_k", "_end")
