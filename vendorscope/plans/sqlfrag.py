"""DuckDB SQL fragments for the correctness oracle.

These are written independently of the Spark expressions (plain RE2
patterns, list lambdas, CTE stages) so the oracle checks the engine rather
than re-running it.
"""

from __future__ import annotations

from vendorscope import fixed
from vendorscope.functions.text import LINE_BREAK, WS

NL = "chr(10)"
# The references that stand in the tables; "&amp;" is decoded last so "&amp;lt;" stays "&lt;".
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"),
    ("&laquo;", "«"), ("&raquo;", "»"), ("&euro;", "€"), ("&rsquo;", "’"),
    ("&lsquo;", "‘"), ("&rdquo;", "”"), ("&ldquo;", "“"), ("&amp;", "&"),
]
TAG = """</?[A-Za-z!?](?:[^<>"']|"[^"]*"|'[^']*')*>"""


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lit_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def rx(x: str, pattern: str, repl: str = "''") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {repl}, 'g')"


def strip(x: str) -> str:
    return rx(x, f"^{WS}+|{WS}+$")


def single_line(x: str) -> str:
    return strip(rx(x, f"{WS}+", "' '"))


def decode(x: str) -> str:
    """Named entities with ``;``, or without it before a non-alphanumeric (kept via the group)."""
    for ent, ch in ENTITIES:
        if ent.startswith("&#"):
            x = f"replace({x}, {lit(ent)}, {lit(ch)})"
        else:
            x = f"regexp_replace({x}, {lit('&' + ent[1:-1] + '(;|([^A-Za-z0-9])|$)')}, {lit(ch + chr(92) + '2')}, 'g')"
    return x


def denoise(x: str) -> str:
    for t in fixed.NOISE_TAGS:
        x = rx(x, rf"(?is)<{t}\b[^>]*>.*?</{t}{WS}*>", NL)
    return x


def strip_tags(x: str) -> str:
    x = rx(x, r"(?s)<!--.*?-->", NL)
    x = rx(x, TAG, NL)
    return decode(x)


def lines(html: str) -> str:
    cleaned = strip_tags(denoise(f"coalesce({html}, '')"))
    parts = f"regexp_split_to_array({cleaned}, {lit(LINE_BREAK)})"
    return f"list_filter(list_transform({parts}, lambda x: {strip('x')}), lambda x: x <> '')"


def title(html: str) -> str:
    raw = f"regexp_extract({html}, {lit(r'(?is)<title\b[^>]*>(.*?)</title')}, 1)"
    return single_line(decode(rx(raw, TAG, "' '")))


def sanitize(x: str) -> str:
    x = rx(x, rf"(?i)\b{fixed.ANSWER_BRAND_PATTERN}\b")
    x = rx(x, rf"{WS}*\+[0-9]+\b")
    x = rx(x, r"(?i)\bTranscribing\.\.\.")
    return single_line(x)


def meaningful(x: str) -> str:
    n = f"lower({single_line(x)})"
    head = f"substring({n}, 1, {fixed.UI_PHRASE_WINDOW})"
    hits = " OR ".join(f"contains({head}, {lit(p)})" for p in fixed.UI_PHRASES)
    return f"(coalesce(length({n}), 0) >= {fixed.MEANINGFUL_MIN_CHARS} AND NOT coalesce(({hits}), false))"


def clean_cell(x: str) -> str:
    junk = "|".join(fixed.CELL_SOURCE_JUNK)
    return rx(single_line(x), rf"(?i){WS}+(?:{junk}){WS}*\+[0-9]+$")


def slug(x: str, cap: int | None = None, fallback: str | None = None) -> str:
    s = f"lower({rx(rx(x, '[^a-zA-Z0-9]+', lit('_')), '^_+|_+$')})"
    if cap is not None:
        s = f"substring({s}, 1, {cap})"
    if fallback is not None:
        s = f"coalesce(nullif({s}, ''), {lit(fallback)})"
    return s


def answer_ctes(src: str, keys: str, lines_col: str, q_col: str) -> str:
    """CTE chain computing ``answer_only`` from a line list and a question.

    ``src`` is a relation with columns keys, lines_col, q_col. Produces CTEs
    ``s1``..``s6``; ``s6`` has keys, lines, answer_only.
    """
    skip = lit_list(fixed.SKIP_EXACT)
    markers = "|".join(fixed.FOOTER_MARKERS)
    return f"""
s1 AS (
  SELECT {keys}, {lines_col} AS lines, list_transform({lines_col}, lambda x: lower(x)) AS ll,
         coalesce(lower({strip(q_col)}), '') AS lq
  FROM {src}
), s2 AS (
  SELECT *,
    CASE WHEN coalesce(list_position(ll, 'you said:'), 0) > 0 THEN list_position(ll, 'you said:') + 2
         WHEN lq <> '' AND coalesce(list_position(list_transform(ll, lambda x: contains(x, lq)), true), 0) > 0
           THEN list_position(list_transform(ll, lambda x: contains(x, lq)), true) + 1
    END AS first_i
  FROM s1
), s3 AS (
  SELECT *, list_min(list_filter(range(first_i, len(ll) + 1), lambda i: NOT list_contains({skip}, ll[i]))) AS k
  FROM s2
), s4 AS (
  SELECT *,
    coalesce(list_min(list_filter(range(k, len(ll) + 1),
                                  lambda i: regexp_matches(ll[i], {lit(markers)}))), len(ll) + 1) AS end_i
  FROM s3
), s5 AS (
  SELECT *, list_filter(CASE WHEN k IS NOT NULL AND end_i > k THEN list_slice(lines, k, end_i - 1) ELSE [] END,
                        lambda x: NOT (NOT regexp_matches(x, {lit(WS)}) AND list_contains({skip}, lower(x)))) AS kept
  FROM s4
), s6 AS (
  SELECT {keys}, lines, coalesce({single_line(f"array_to_string(kept, {NL})")}, '') AS answer_only
  FROM s5
)"""
