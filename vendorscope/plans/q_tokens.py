"""Token and DOM-region queries (HTM-5/6/9/10/14/15, WIN-2/4, FLT-5/8) on raw pages and
on the AI-answer pages."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import dom as D
from vendorscope.operators import pages as P
from vendorscope.operators import tokens as TK
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.plans.q_pages import _AP
from vendorscope.sources import tables as S

_PLAIN_TOKEN = D.TOKEN_RX.replace("++", "+").replace("*+", "*")


def _tokens_sql(src: str, key: str) -> str:
    t = "token"
    tag = f"lower(regexp_extract({t}, '^</?([A-Za-z][A-Za-z0-9:_-]*)', 1))"
    kind = (f"CASE WHEN starts_with({t}, '<!--') THEN 'comment' "
            f"WHEN regexp_matches({t}, '(?i)^<(script|style)\\b') THEN 'raw' "
            f"WHEN starts_with({t}, '</') AND {tag} <> '' THEN 'close' "
            f"WHEN regexp_matches({t}, '^<[!?]') THEN 'decl' "
            f"WHEN regexp_matches({t}, '^<[A-Za-z]') AND (ends_with({t}, '/>') OR {tag} IN "
            f"({', '.join(Q.lit(v) for v in D.VOID)})) THEN 'self' "
            f"WHEN regexp_matches({t}, '^<[A-Za-z]') THEN 'open' ELSE 'text' END")
    return f"""t0 AS (
  SELECT {key}, regexp_extract_all(coalesce(html, ''), {Q.lit(_PLAIN_TOKEN)}, 0) AS toks FROM {src}
), t1 AS (
  SELECT {key}, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM t0
), tk AS (
  SELECT {key}, CAST(pos AS BIGINT) AS pos, {kind} AS kind, token, CAST(length(token) AS BIGINT) AS char_len
  FROM t1
), tok AS (
  SELECT {key}, pos, kind, CASE WHEN kind = 'text' THEN NULL ELSE {tag} END AS tag, token, char_len,
         CAST(sum(char_len) OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              - char_len AS BIGINT) AS char_start
  FROM tk
)"""


def _extents_sql(key: str, tags: list[str]) -> str:
    """Elements under one stack over all names: a recursion that reads one tag of every page per step.

    The stack is a list of (name, number of its start tag); an end tag cuts it at the last element of its name.
    """
    return f"""RECURSIVE_TAGS AS (
  SELECT {key}, tag, pos, kind, char_start, char_start + char_len AS behind, token,
         row_number() OVER (PARTITION BY {key} ORDER BY pos) AS k
  FROM tok WHERE kind IN ('open', 'close')
), stacks AS (
  SELECT DISTINCT {key}, 0::BIGINT AS k, []::STRUCT(tag VARCHAR, pos BIGINT)[] AS before, []::STRUCT(tag VARCHAR, pos BIGINT)[] AS after
  FROM tok
  UNION ALL
  SELECT t.{key}, t.k, s.after,
         CASE WHEN t.kind = 'open' THEN list_append(s.after, {{'tag': t.tag, 'pos': t.pos}})
              ELSE list_slice(s.after, 1, coalesce(list_max(list_filter(range(1, len(s.after) + 1), lambda i: s.after[i].tag = t.tag)) - 1,
                                                   len(s.after)))
         END
  FROM stacks s JOIN RECURSIVE_TAGS t ON t.{key} = s.{key} AND t.k = s.k + 1
), closed AS (
  SELECT s.{key}, unnest(list_slice(s.before, len(s.after) + 1, len(s.before))).pos AS start_pos, t.pos AS end_pos, t.char_start AS inner_end
  FROM stacks s JOIN RECURSIVE_TAGS t USING ({key}, k) WHERE t.kind = 'close' AND len(s.after) < len(s.before)
), ext AS (
  SELECT t.{key}, t.tag, t.pos AS start_pos, c.end_pos, CAST(len(list_filter(s.after, lambda x: x.tag = t.tag)) AS BIGINT) AS depth,
         t.behind AS inner_start, c.inner_end, t.token
  FROM RECURSIVE_TAGS t JOIN stacks s USING ({key}, k) LEFT JOIN closed c ON c.{key} = t.{key} AND c.start_pos = t.pos
  WHERE t.kind = 'open' AND t.tag IN ({', '.join(Q.lit(t) for t in tags)})
)""".replace("RECURSIVE_TAGS", "tags")


@query("html_tokens", f"""WITH {_tokens_sql('pages', 'page_id')}
SELECT page_id, kind, count(*) AS n_tokens, CAST(sum(char_len) AS BIGINT) AS chars,
       CAST(max(char_start + char_len) AS BIGINT) AS page_chars
FROM tok GROUP BY page_id, kind""")
def html_tokens(spark, sf_dir):
    """HTM-6 token rows: per page and token kind, token count and character coverage."""
    tok = TK.tokens(S.pages(spark, sf_dir))
    return tok.groupBy("page_id", "kind").agg(
        F.count("*").alias("n_tokens"), F.sum("char_len").cast("bigint").alias("chars"),
        F.max(F.col("char_start") + F.col("char_len")).cast("bigint").alias("page_chars"))


_EXT_TAGS = ["div", "p", "article", "ul", "li", "nav", "a", "b"]


@query("element_extent", f"""WITH RECURSIVE {_tokens_sql('pages', 'page_id')}, {_extents_sql('page_id', _EXT_TAGS)}
SELECT page_id, tag, start_pos, end_pos, depth, inner_start, inner_end FROM ext""")
def element_extent(spark, sf_dir):
    """HTM-6: extents (token span, nesting depth, innerHTML offsets) of common elements on every page."""
    return TK.extents(S.pages(spark, sf_dir), _EXT_TAGS).drop("token")


def _attr_sql(tok: str, name: str) -> str:
    rx = rf"""(?i)[\s/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    vals = ", ".join(f"nullif(regexp_extract({tok}, {Q.lit(rx)}, {i}), '')" for i in (1, 2, 3))
    return f"CASE WHEN regexp_matches({tok}, {Q.lit(rf'(?i)[\s/]{name}\s*=')}) THEN coalesce({vals}, '') END"


def _region_sql(src: str, key: str) -> str:
    whens = []
    for rank, (kind, name, value, scope) in enumerate(fixed.RESPONSE_SELECTORS, start=1):
        a = _attr_sql("d.token", name)
        if scope is None:
            cond = f"contains({a}, {Q.lit(value)})" if kind == "class" else f"{a} = {Q.lit(value)}"
        else:
            cond = (f"contains({a}, {Q.lit(value)}) AND EXISTS (SELECT 1 FROM ext o WHERE o.{key} = d.{key} "
                    f"AND o.tag = 'div' AND {_attr_sql('o.token', 'id')} = {Q.lit(scope)} AND d.start_pos > o.start_pos "
                    f"AND (o.end_pos IS NULL OR d.start_pos < o.end_pos))")
        whens.append(f"WHEN coalesce({cond}, false) THEN {rank}")
    body = Q.strip(f"regexp_extract(html, {Q.lit(r'(?is)<body\b[^>]*>(.*?)(?:</body|$)')}, 1)")
    return f"""WITH RECURSIVE {_tokens_sql(src, key)}, {_extents_sql(key, ['div'])}, cand AS (
  SELECT d.{key}, d.start_pos, CASE {' '.join(whens)} END AS rank,
    {Q.strip(f"substring(p.html, CAST(d.inner_start + 1 AS INTEGER), CAST(coalesce(d.inner_end, length(p.html)) - d.inner_start AS INTEGER))")} AS region_html
  FROM ext d JOIN {src} p ON p.{key} = d.{key}
), best AS (
  SELECT {key}, rank, region_html FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY rank, start_pos) AS rn
    FROM cand WHERE rank IS NOT NULL AND length(region_html) > {fixed.REGION_MIN_CHARS}) WHERE rn = 1
)
SELECT p.{key}, CAST(CASE WHEN b.rank IS NOT NULL THEN b.rank WHEN length({body}) > {fixed.BODY_MIN_CHARS} THEN 0 END
                     AS BIGINT) AS selector_rank,
       CASE WHEN b.rank IS NOT NULL THEN b.region_html WHEN length({body}) > {fixed.BODY_MIN_CHARS} THEN {body} END
         AS region_html
FROM {src} p LEFT JOIN best b ON p.{key} = b.{key}"""


@query("region_pick", _region_sql("pages", "page_id"))
def region_pick(spark, sf_dir):
    """HTM-5 + WIN-2 + FLT-2 + LIM-2: response region of every page (selector rank; 0 = body fallback)."""
    return TK.region_pick(S.pages(spark, sf_dir))


_APK = """apk AS (SELECT conv_id * 100 + turn AS page_id, html FROM ap)"""


@query("region_pick_answers", _region_sql("apk", "page_id").replace("WITH RECURSIVE ", f"WITH RECURSIVE {_AP}, {_APK}, ", 1))
def region_pick_answers(spark, sf_dir):
    """HTM-5 on the AI-answer pages (their ``div#main`` wins over the body)."""
    ap = S.answer_pages(spark, sf_dir).select((F.col("conv_id") * 100 + F.col("turn")).alias("page_id"), "html")
    return TK.region_pick(ap)


@query("page_status", f"""WITH RECURSIVE {_tokens_sql('pages', 'page_id')}, {_extents_sql('page_id', fixed.OVERVIEW_ANCHOR_TAGS)},
hits AS (SELECT page_id, pos FROM tok WHERE kind = 'text' AND contains(token, {Q.lit(fixed.OVERVIEW_ANCHOR_TEXT)})),
anchored AS (
  SELECT DISTINCT e.page_id FROM ext e JOIN hits h ON e.page_id = h.page_id
  WHERE h.pos > e.start_pos AND (e.end_pos IS NULL OR h.pos < e.end_pos)
)
SELECT p.page_id,
  CASE WHEN regexp_matches(p.html, {Q.lit(P.BLOCK_FORM_RX)})
         OR contains(array_to_string({Q.lines('p.html')}, chr(10)), {Q.lit(fixed.BLOCK_TEXT)}) THEN 'blocked'
       WHEN a.page_id IS NULL THEN 'no_overview' ELSE 'anchored' END AS status
FROM pages p LEFT JOIN anchored a ON p.page_id = a.page_id""")
def page_status(spark, sf_dir):
    """FLT-8: outcome per page (blocked / no_overview / container_unparsed / empty_text / ok)."""
    return TK.page_status(S.pages(spark, sf_dir))


def _cases_sql(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


# Tokens of a raw page before the block appended to it: its own, less the two end tags that are put behind the block.
_BEFORE = f"""b AS (
  SELECT page_id, url, CAST(len(regexp_extract_all(regexp_replace(html, {Q.lit(S.PAGE_END + '$')}, ''), {Q.lit(_PLAIN_TOKEN)}, 0)) AS BIGINT) AS n
  FROM pages
)"""
_PLACES = [place for _, place, _ in S.OVERVIEW_CASES]
_ANCHORS = [len(re.findall("<[^>]*>|[^<]+", html.split("<h2>")[0])) for html, _, _ in S.OVERVIEW_CASES]
_NULL = "CAST(NULL AS BIGINT)"


@query("overview_container", f"""WITH {_BEFORE}
SELECT page_id, n + {_cases_sql('page_id', [str(a) for a in _ANCHORS])} AS anchor_pos,
       n + {_cases_sql('page_id', [_NULL if x is None else str(x) for x in _PLACES])} AS container_pos,
       {_cases_sql('page_id', ['NULL' if how is None else Q.lit(how) for _, _, how in S.OVERVIEW_CASES])} AS how
FROM b""")
def overview_container(spark, sf_dir):
    """HTM-9 + HTM-10 on raw pages with an overview block, from heading anchors: climbs of 1, 5 and 6 divs, data-attrid, svg, fallbacks."""
    return TK.overview_container(S.overview_raw_pages(spark, sf_dir), anchors=["h1", "h2", "h3"])


# Outermost divs are the anchors here, so only the fallback classes give a container.
_CLASSED = f"page_id % {len(S.OVERVIEW_CASES)} >= {len(S.OVERVIEW_CASES) - 2}"


@query("overview_blocks", f"""
SELECT page_id, {Q.strip('url')} || chr(10) || chr(10) || 'page & text' || chr(10) || chr(10) || 'open two' AS overview_text
FROM pages WHERE {_CLASSED}""")
def overview_blocks(spark, sf_dir):
    """HTM-14 + HTM-15 + FLT-6 + WIN-4 on raw pages with an overview block: an end tag around an open paragraph makes it a block."""
    return TK.overview_blocks(S.overview_raw_pages(spark, sf_dir))


_LEFT = ["h2", "AI Over", "b", "view", "p", "{url}", "ul", "li", "page & text", "p", "Show more", "p", "open one", "p", "open two"]
_LEFT_TAGS = ("h2", "b", "p", "ul", "li")


@query("overview_sanitize", f"""WITH k AS (
  SELECT page_id, unnest([{', '.join("url" if x == '{url}' else Q.lit(x) for x in _LEFT)}]) AS word,
         unnest(range({len(_LEFT)})) AS n FROM pages WHERE {_CLASSED}
)
SELECT page_id, CAST(n AS BIGINT) AS n, CASE WHEN word IN ({', '.join(Q.lit(t) for t in _LEFT_TAGS)}) THEN 'open' ELSE 'text' END AS kind,
       word FROM k""")
def overview_sanitize(spark, sf_dir):
    """HTM-14 on raw pages with an overview block: the start tags and texts that the clean-up leaves, in order."""
    kept = TK.overview_sanitize(S.overview_raw_pages(spark, sf_dir))
    rows = kept.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(
        "pos", "kind", F.coalesce("tag", "token").alias("word")))).alias("_k"))  # a page's own tokens
    rows = rows.select("page_id", F.posexplode("_k").alias("n", "k"))
    return rows.select("page_id", F.col("n").cast("bigint").alias("n"), "k.kind", "k.word")


@query("page_status_cases", f"""
SELECT page_id, {_cases_sql('page_id', [Q.lit(status) for _, status in S.STATUS_CASES])} AS status FROM pages""")
def page_status_cases(spark, sf_dir):
    """FLT-5 + FLT-8 on raw pages with endings for every outcome: error / blocked / no_overview / container_unparsed / empty_text / ok."""
    return TK.page_status(S.status_pages(spark, sf_dir))


_QA = """qa AS (
  SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer
  FROM conversations q LEFT JOIN conversations a
    ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
  WHERE q.role = 'user'
)"""


def _stop_sql(x: str) -> str:
    return " OR ".join(f"contains(lower({x}), {Q.lit(p)})" for p in fixed.OVERVIEW_STOP_PHRASES)


# Expected blocks of an overview page, stated from its construction: the question,
# then the answer (stripped, non-empty, no stop phrase, first of equal texts).
_OV_SQL = f"""{_QA}, ob AS (
  SELECT conv_id * 100 + turn AS page_id,
         list_filter([{Q.strip('question')}, {Q.strip("coalesce(answer, '')")}],
                     lambda x: x <> '' AND NOT ({_stop_sql('x')})) AS l0
  FROM qa
), ob2 AS (SELECT page_id, list_filter(l0, lambda x, i: list_position(l0, x) = i) AS l FROM ob)"""


@query("overview_blocks_answers", f"""WITH {_OV_SQL}
SELECT page_id, array_to_string(l, chr(10) || chr(10)) AS overview_text FROM ob2 WHERE len(l) > 0""")
def overview_blocks_answers(spark, sf_dir):
    """HTM-14/15 + FLT-6 + WIN-4 on overview pages: question and answer blocks, link/hidden/stop lines dropped."""
    return TK.overview_blocks(S.overview_pages(spark, sf_dir))


@query("overview_container_answers", f"""WITH {_QA}
SELECT conv_id * 100 + turn AS page_id, CAST(2 AS BIGINT) AS anchor_pos, CAST(3 AS BIGINT) AS container_pos,
       'fallback' AS how FROM qa""")
def overview_container_answers(spark, sf_dir):
    """HTM-9/10 on overview pages: the outermost div is the anchor, so the Kevs9 fallback gives the container."""
    return TK.overview_container(S.overview_pages(spark, sf_dir))


@query("page_status_answers", f"""WITH {_OV_SQL}
SELECT page_id, CASE WHEN len(l) > 0 THEN 'ok' ELSE 'empty_text' END AS status FROM ob2""")
def page_status_answers(spark, sf_dir):
    """FLT-8 on overview pages: ok when blocks remain, else empty_text."""
    return TK.page_status(S.overview_pages(spark, sf_dir))
