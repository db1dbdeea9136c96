"""A page's element tree as numbered arrays, read in one pass with an explicit element stack.

The stack is the one thing here that SQL's higher-order functions cannot do in linear time (a fold copies its accumulator at every
token), so the pass is a small Arrow function: batches of pages in, flat arrays out. Everything that reads the tree is a
column expression on these arrays (see the operators), so no page is ever shuffled or exploded for its structure.

Tree rules, those of a parser without implied end tags: an end tag closes the nearest open element of its name and all that is open within
that; one without an open element of its name is ignored; void elements and ``<x/>`` have no content; what is never closed runs to the
end of the page. Script and style are one token each.

Numbers: elements are counted from 0 in order of their start tags (``i``); ``last`` is the last element within one, so the elements
within element e are ``e.i + 1 .. e.last``, and its texts are ``e.t0 .. e.t1 - 1``: containment is a slice, never a search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from vendorscope import fixed

# Raw-text elements are one token; then comments, tags, declarations, text runs, a stray "<".
# What is never closed (a raw-text element, a comment) runs to the end of the page, so no text is scanned twice.
_ATTRS = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN_RX = (rf"(?is)<script\b{_ATTRS}>.*?(?:</script\s*>|\z)|<style\b{_ATTRS}>.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)|"
            rf"</?[A-Za-z]{_ATTRS}>|<[!?][^<>]*+>|[^<]++|<")
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]

# pos, end_pos: places of the tags among all tokens (end_pos null: never closed); start, inner, inner_end: character offsets; depth: open
# elements of the same name, itself included; c0, c1: stretch of the page's joined texts; drop: nearest element at or above it that the
# overview's clean-up removes (-1: none); single: its one text, if it holds nothing else but elements around that (-1: not so); r0, r1 and
# d0, d1: which of the page's rows (tr) and cells (th, td) outside noise lie within it.
_STR, _INT, _LONG, _BOOL = pa.string(), pa.int32(), pa.int64(), pa.bool_()
NODE = pa.struct([("i", _INT), ("tag", _STR), ("token", _STR), ("pos", _LONG), ("end_pos", _LONG), ("depth", _LONG), ("start", _LONG),
                  ("inner", _LONG), ("inner_end", _LONG), ("parent", _INT), ("last", _INT), ("t0", _INT), ("t1", _INT), ("c0", _INT),
                  ("c1", _INT), ("noise", _BOOL), ("drop", _INT), ("single", _INT), ("cls", _STR), ("id", _STR), ("attrid", _STR),
                  ("r0", _INT), ("r1", _INT), ("d0", _INT), ("d1", _INT)])
TAG, POS, END_POS, START, INNER_END, PARENT, LAST, T1, C1, NOISE, DROP, SINGLE, R1, D1 = 1, 3, 4, 6, 8, 9, 10, 12, 14, 15, 16, 17, 22, 24
TEXT = pa.struct([("text", _STR), ("pos", _LONG), ("owner", _INT), ("noise", _BOOL)])
TOKEN = pa.struct([("pos", _LONG), ("kind", _STR), ("tag", _STR), ("token", _STR), ("char_start", _LONG), ("char_len", _LONG)])

_TOKEN = re.compile(TOKEN_RX.replace(r"\z", r"\Z"), re.ASCII)
_TAG = re.compile(rf"<[A-Za-z]{_ATTRS}>")
_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9:_-]*)")
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*+;?)")
_ATTRIBUTES = {name: re.compile(rf"""(?i)[\s/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)|)""")
               for name in ("class", "id", "data-attrid", "aria-hidden")}
_ATTRID = re.compile(r"(?i)[\s/]data-attrid(?=[\s/>])")
_BADGE = re.compile(fixed.OVERVIEW_DROP_CLASS_PATTERN)
_DROP_TAGS = frozenset(("style", "a"))
_NOISE = frozenset(fixed.NOISE_TAGS)
_VOID = frozenset(VOID)


def _character(m: re.Match) -> str:
    """The text of one character reference; the reference itself where it names nothing."""
    ref = m.group().removesuffix(";")
    if ref[1] != "#":
        return html5.get(ref[1:] + ";", m.group())
    n = int(ref[3:], 16) if ref[2] in "xX" else int(ref[2:]) if len(ref) < 20 else 0
    if n == 0 or n > 0x10FFFF or 0xD800 <= n <= 0xDFFF:
        return "�"
    return bytes([n]).decode("cp1252", "ignore") or chr(n) if 0x80 <= n <= 0x9F else chr(n)


def _start(token: str) -> tuple:
    """Of a start tag: name, class, id, data-attrid, and whether the overview's clean-up removes it (style, link, hidden, badge class)."""
    tag = _NAME.match(token)[1].lower()
    if " " not in token and "=" not in token and len(token) == len(tag) + 2:
        return tag, None, None, None, tag in _DROP_TAGS
    values = []
    for rx in _ATTRIBUTES.values():
        m = rx.search(token)
        values.append(None if m is None else m[1] or m[2] or m[3] or "")
    cls, ident, attrid, hidden = values
    if attrid is None and _ATTRID.search(token):
        attrid = ""
    return tag, cls, ident, attrid, tag in _DROP_TAGS or hidden == "true" or (cls is not None and bool(_BADGE.search(cls)))


def walk(page: str) -> tuple[list[list], list[tuple], list[tuple]]:
    """Elements (fields of ``NODE``), texts (fields of ``TEXT``) and the character spans of the outermost noise elements of one page."""
    nodes: list[list] = []
    texts: list[tuple] = []
    spans: list[tuple] = []
    kids: list[int] = []      # children of an element, dropped ones not counted
    only: list[int] = []      # its last such child: an element's number, or -2 - a text's number; -1 for a comment
    stack: list[int] = []
    opened: dict[str, int] = {}
    known: dict[str, tuple] = {}
    buffer: list[str] = []
    char = began = chars = n_rows = n_cells = 0

    def child(number: int) -> None:
        if stack:
            kids[stack[-1]] += 1
            only[stack[-1]] = number

    def flush() -> None:
        nonlocal chars
        text = buffer[0] if len(buffer) == 1 else "".join(buffer)
        buffer.clear()
        if "&" in text:
            text = _REFERENCE.sub(_character, text)
        owner = stack[-1] if stack else -1
        child(-2 - len(texts))
        texts.append((text, began, owner, owner >= 0 and nodes[owner][NOISE]))
        chars += len(text)

    def close(upto: int, pos: int | None, at: int | None, behind: int) -> None:
        while len(stack) > upto:
            n = nodes[stack.pop()]
            opened[n[TAG]] -= 1
            n[END_POS], n[INNER_END], n[LAST], n[T1], n[C1], n[R1], n[D1] = pos, at, len(nodes) - 1, len(texts), chars, n_rows, n_cells
            if n[NOISE] and not (n[PARENT] >= 0 and nodes[n[PARENT]][NOISE]):
                spans.append((n[START], behind))

    pos = -1
    for token in _TOKEN.findall(page):
        pos += 1
        at, char = char, char + len(token)
        if token[0] != "<" or len(token) == 1:
            if not buffer:
                began = pos
            buffer.append(token)
            continue
        if buffer:
            flush()
        second = token[1]
        if second in "!?":
            child(-1)
            continue
        if second == "/":
            tag = _NAME.match(token)[1].lower()
            if opened.get(tag):
                k = len(stack) - 1
                while nodes[stack[k]][TAG] != tag:
                    k -= 1
                close(k + 1, pos, at, at)  # what was left open within the element ends where its end tag starts
                close(k, pos, at, char)
            continue
        shown = _TAG.match(token)[0]  # a raw-text token goes on behind its start tag
        start = known.get(shown)
        if start is None:
            start = known[shown] = _start(shown)
        tag, cls, ident, attrid, drops = start
        raw = tag in ("script", "style")
        i, parent = len(nodes), stack[-1] if stack else -1
        up = nodes[parent] if parent >= 0 else None
        if not drops:
            child(i)
        noise = tag in _NOISE or (up is not None and up[NOISE])
        if not noise:
            n_rows += tag == "tr"
            n_cells += tag in ("td", "th")
        node = [i, tag, shown, pos, None, opened.get(tag, 0) + 1, at, at + len(shown), None, parent, i, len(texts), len(texts), chars, chars,
                noise, i if drops else up[DROP] if up is not None else -1, -1, cls, ident, attrid,
                n_rows, n_rows, n_cells, n_cells]
        nodes.append(node)
        kids.append(0)
        only.append(-1)
        if raw or tag in _VOID or token.endswith("/>"):
            node[END_POS], node[INNER_END] = pos, char
            if noise and not (up is not None and up[NOISE]):
                spans.append((at, char))
        else:
            stack.append(i)
            opened[tag] = opened.get(tag, 0) + 1
    if buffer:
        flush()
    close(0, None, None, char)
    for i in range(len(nodes) - 1, -1, -1):
        if kids[i] == 1:
            nodes[i][SINGLE] = -2 - only[i] if only[i] < -1 else nodes[only[i]][SINGLE] if only[i] >= 0 else -1
    return nodes, texts, spans


def page_lines_text(page: str) -> tuple[str, str]:
    """The texts outside script, style, noscript and svg, one per line; and the texts of the first title."""
    nodes, texts, _ = walk(page)
    title = next((n for n in nodes if n[TAG] == "title"), None)
    return ("\n".join([t[0] for t in texts if not t[3]]),
            "" if title is None else " ".join([t[0] for t in texts[title[T1 - 1]:title[T1]]]))


def page_tokens(page: str) -> list[tuple]:
    """The tokens of a page with their kind: open / close / self / raw (script, style) / comment / decl / text."""
    out, at = [], 0
    for pos, token in enumerate(_TOKEN.findall(page)):
        name = _NAME.match(token)
        tag = name[1].lower() if name else ""
        if token.startswith("<!--"):
            kind = "comment"
        elif token.startswith(("<!", "<?")) and len(token) > 1:
            kind = "decl"
        elif not tag:
            kind, tag = "text", None
        elif token[1] == "/":
            kind = "close"
        else:
            kind = "raw" if tag in ("script", "style") else "self" if tag in _VOID or token.endswith("/>") else "open"
        out.append((pos, kind, tag, token, at, len(token)))
        at += len(token)
    return out


def page_without_noise(page: str) -> str:
    """The page with each outermost script, style, noscript and svg element replaced by a line break."""
    parts, at = [], 0
    for start, end in sorted(walk(page)[2]):
        parts += [page[at:start], "\n"]
        at = end
    return "".join(parts) + page[at:]


def _lists(rows: list[list], kind: pa.StructType, places) -> pa.Array:
    """One Arrow list of structs per page, built from flat columns: the values at ``places`` of each row."""
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    every = [x for r in rows for x in r]
    columns = [pa.array([x[k] for x in every], f.type) for k, f in zip(places, kind)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(kind)))


# Bytes of markup whose trees are held as Python objects at one time; a larger page is read alone.
READ_BYTES = 1 << 18


def _few(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The same pages in runs of about ``READ_BYTES``: a batch's pages as objects take many times its bytes, so few of them are made at once."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(b):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + READ_BYTES, side="right")))
            upto = min(upto, at + 4096)
            yield b.slice(at, upto - at)
            at = upto


def page_dom(html: Column, *fields: str) -> Column:
    """Struct (nodes, texts) of a page: its elements with the named ``fields`` of ``NODE`` (all if none is named) and its texts; a null page
    is an empty one."""
    places = [k for k, f in enumerate(NODE) if not fields or f.name in fields]
    node = pa.struct([NODE[k] for k in places])
    kind = pa.struct([("nodes", pa.list_(node)), ("texts", pa.list_(TEXT))])

    @F.arrow_udf(from_arrow_type(kind))
    def dom(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in _few(batches):
            read = [walk(p or "")[:2] for p in pages.to_pylist()]
            yield pa.StructArray.from_arrays([_lists([r[0] for r in read], node, places),
                                              _lists([r[1] for r in read], TEXT, range(len(TEXT)))], fields=list(kind))

    return dom(html)


def page_text(html: Column) -> Column:
    """Struct (text, title) of a page: texts outside noise elements, one per line (not stripped yet), and its title; "" for a null page."""
    @F.arrow_udf("struct<text:string,title:string>")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in _few(batches):
            read = [page_lines_text(p or "") for p in pages.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([r[k] for r in read], pa.string()) for k in (0, 1)], ["text", "title"])

    return text(html)


def tokens_of(html: Column) -> Column:
    """The page's tokens as an array of ``TOKEN``."""
    @F.arrow_udf(from_arrow_type(pa.list_(TOKEN)))
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in _few(batches):
            yield _lists([page_tokens(p or "") for p in pages.to_pylist()], TOKEN, range(len(TOKEN)))

    return tokens(html)


def denoised(html: Column) -> Column:
    """The page without its noise elements, at any depth of nesting; null stays null."""
    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in _few(batches):
            yield pa.array([None if p is None else page_without_noise(p) for p in pages.to_pylist()], pa.string())

    return clean(html)


def decoded(text: Column) -> Column:
    """Text with its character references decoded; null stays null."""
    @F.arrow_udf("string")
    def decode(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None or "&" not in t else _REFERENCE.sub(_character, t) for t in texts.to_pylist()], pa.string())

    return decode(text)


def with_dom(df: DataFrame, html: str = "html", fields: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``dom``, the tree of its pages (elements with the named fields), computed once (behind a fence)."""
    from vendorscope.operators.pages import fence
    return fence(df.withColumn("dom", page_dom(F.col(html), *fields)))


def within(nodes: Column, n: Column) -> Column:
    """The elements inside element ``n``."""
    return F.slice(nodes, n["i"] + 2, n["last"] - n["i"])


def texts_of(texts: Column, n: Column) -> Column:
    """The text nodes inside element ``n``."""
    return F.slice(texts, n["t0"] + 1, n["t1"] - n["t0"])


def contains(outer: Column, inner: Column) -> Column:
    """Whether element ``inner`` lies within element ``outer``."""
    return (inner["i"] > outer["i"]) & (inner["i"] <= outer["last"])
