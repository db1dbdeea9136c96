"""Column helpers for plain text (all built-in expressions, JVM side).

Whitespace follows Python's ``str.isspace`` set, not Java's ASCII ``\\s``:
the class below is written with escapes both Java and RE2 read the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vendorscope import fixed

# Unicode whitespace (str.isspace) and line breaks (str.splitlines) as regex classes.
WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The same set as characters, built from Python's own rule (str.isspace).
WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends (character-set trim, no regex)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def single_line(c) -> Column:
    """``" ".join(s.split())``: runs of whitespace -> one space, ends stripped."""
    return strip_ws(F.regexp_replace(_c(c), f"{WS}+", " "))


def slug(c, cap: int | None = None, fallback: str | None = None) -> Column:
    """Runs of non ``[A-Za-z0-9]`` -> ``_``, strip ``_``, lower; optional cap and fallback."""
    # The same signs as [^a-zA-Z0-9]: Java reads the named class about thirty times as fast.
    s = F.lower(F.regexp_replace(F.regexp_replace(_c(c), r"\P{Alnum}+", "_"), "^_+|_+$", ""))
    if cap is not None:
        s = F.substring(s, 1, cap)
    if fallback is not None:
        s = F.coalesce(F.nullif(s, F.lit("")), F.lit(fallback))
    return s


def category_label(c) -> Column:
    """``WEDDING_PLANNERS`` -> ``Wedding Planners``."""
    return F.initcap(F.regexp_replace(_c(c), "_", " "))


def id_cast(c) -> Column:
    """Integer id when the raw text is all ASCII digits and fits a BIGINT; otherwise null (raw kept apart)."""
    c = _c(c)
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def param_bullets(arr) -> Column:
    """``- field`` per stripped, non-blank field, joined by newlines."""
    kept = F.filter(_c(arr), lambda x: strip_ws(x) != "")
    return F.array_join(F.transform(kept, lambda x: F.concat(F.lit("- "), strip_ws(x))), "\n")


def sanitize_may_change(c) -> Column:
    """False when ``sanitize_answer`` leaves an already single-line text unchanged."""
    s = _c(c)
    low = F.lower(s)
    return low.contains("justdial") | low.contains("weddingwire") | s.contains("+") | low.contains("transcribing...")


def sanitize_answer(c) -> Column:
    """Drop brand names, ``+N`` runs and ``Transcribing...``; collapse whitespace.

    Each regex runs only on rows where a plain ``contains`` says it can match.
    """
    s = _c(c)
    low = F.lower(s)
    brands = low.contains("justdial") | low.contains("weddingwire")
    s = F.when(brands, F.regexp_replace(s, rf"(?i)\b{fixed.ANSWER_BRAND_PATTERN}\b", "")).otherwise(s)
    s = F.when(s.contains("+"), F.regexp_replace(s, rf"{WS}*\+[0-9]+\b", "")).otherwise(s)
    s = F.when(F.lower(s).contains("transcribing..."),
               F.regexp_replace(s, r"(?i)\bTranscribing\.\.\.", "")).otherwise(s)
    return single_line(s)


def clean_cell(c) -> Column:
    """Collapse whitespace, then drop a trailing ``<space>(IBM|Quora|TechTarget) +N``."""
    junk = "|".join(fixed.CELL_SOURCE_JUNK)
    return F.regexp_replace(single_line(c), rf"(?i){WS}+(?:{junk}){WS}*\+[0-9]+$", "")


def is_meaningful(c, collapsed: bool = False) -> Column:
    """Usable answer: >= 80 normalised chars, no UI phrase in the first 300.

    ``collapsed``: the input is already single-line (e.g. a sanitised answer).
    """
    n = F.lower(_c(c) if collapsed else single_line(_c(c)))
    head = F.substring(n, 1, fixed.UI_PHRASE_WINDOW)
    hit = F.lit(False)
    for p in fixed.UI_PHRASES:
        hit = hit | head.contains(p)
    return (F.coalesce(F.length(n), F.lit(0)) >= fixed.MEANINGFUL_MIN_CHARS) & ~F.coalesce(hit, F.lit(False))


def section_block(group_name, text) -> Column:
    """``=====... <GROUP> =====...`` blank line, 4 spaces, text."""
    return F.concat(F.lit(fixed.SECTION_RULE + " "), F.upper(_c(group_name)),
                    F.lit(" " + fixed.SECTION_RULE + "\n\n" + fixed.SECTION_TEXT_INDENT), _c(text))


def short_query(name, city) -> Column:
    """``<name> <city> wedding planner``; a missing part renders as ``None``."""
    return F.concat_ws(" ", F.coalesce(_c(name), F.lit("None")), F.coalesce(_c(city), F.lit("None")),
                       F.lit(fixed.SHORT_QUERY_SUFFIX))


def py_str(c) -> Column:
    """Python ``str()`` of an optional string: null renders as ``None``."""
    return F.coalesce(_c(c), F.lit("None"))
