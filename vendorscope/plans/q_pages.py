"""Page queries: HTML -> lines -> answer (HTM-1..4, HTM-7, HTM-8, PRJ-15/17, FLT-1/2/5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import html as H
from vendorscope.functions import text as T
from vendorscope.operators import pages as P
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.sources import tables as S

def _page_answer_sql() -> str:
    from vendorscope.plans.q_tables import header_rule_sql, markdown_sql, tables_sql
    return f"""
WITH p AS (
  SELECT page_id, {Q.lines('html')} AS lines0, {Q.title('html')} AS q,
         list_transform({header_rule_sql(tables_sql('html'))}, lambda t: {markdown_sql('t')}) AS tables
  FROM pages
), {Q.answer_ctes('p', 'page_id', 'lines0', 'q')}, f AS (
  SELECT s6.page_id, CAST(len(lines) AS BIGINT) AS n_lines, array_to_string(lines, chr(10)) AS full_text,
         answer_only, to_json(p.tables) AS tables_json,
         {Q.sanitize("coalesce(nullif(answer_only, ''), array_to_string(lines, chr(10)))")} AS answer
  FROM s6 JOIN p ON p.page_id = s6.page_id
)
SELECT page_id, n_lines, full_text, answer_only, tables_json, answer, {Q.meaningful('answer')} AS meaningful FROM f
"""


_PAGE_ANSWER_SQL = _page_answer_sql()


@query("page_to_answer", _PAGE_ANSWER_SQL)
def page_to_answer(spark, sf_dir):
    """HTM-8: every page -> full text, sliced answer (question = page title), tables, usable flag."""
    a = P.page_to_answer(S.pages(spark, sf_dir), tables=True)
    return a.select("page_id", "n_lines", "full_text", "answer_only", F.to_json("tables").alias("tables_json"),
                    "answer", "meaningful")


@query("page_answer_status", f"""
WITH a AS ({_PAGE_ANSWER_SQL})
SELECT meaningful, answer_only = '' AS no_anchor, count(*) AS n_pages,
       CAST(sum(length(answer)) AS BIGINT) AS answer_chars
FROM a GROUP BY 1, 2
""")
def page_answer_status(spark, sf_dir):
    """Minimum slice roll-up: pages per (usable, anchor found) with answer volume."""
    a = P.page_to_answer(S.pages(spark, sf_dir))
    return (a.groupBy("meaningful", (F.col("answer_only") == "").alias("no_anchor"))
            .agg(F.count("*").alias("n_pages"), F.sum(F.length("answer")).cast("bigint").alias("answer_chars")))


@query("html_denoise", f"SELECT page_id, {Q.denoise('html')} AS html_clean FROM pages")
def html_denoise(spark, sf_dir):
    """HTM-1: script/style/noscript/svg subtrees removed."""
    return S.pages(spark, sf_dir).select("page_id", H.denoise(F.col("html")).alias("html_clean"))


@query("html_full_text", f"SELECT page_id, array_to_string({Q.lines('html')}, chr(10)) AS full_text FROM pages")
def html_full_text(spark, sf_dir):
    """HTM-2/3: clean lines joined by newlines."""
    return S.pages(spark, sf_dir).select("page_id", H.full_text(H.html_lines(F.col("html"))).alias("full_text"))


@query("html_line_rows", f"""
SELECT page_id, CAST(pos - 1 AS BIGINT) AS pos, line
FROM (SELECT page_id, unnest({Q.lines('html')}) AS line,
             unnest(range(1, len({Q.lines('html')}) + 1)) AS pos FROM pages)
""")
def html_line_rows(spark, sf_dir):
    """HTM-4: one row per clean line with its position."""
    return P.line_rows(S.pages(spark, sf_dir))


_AP = """
qa AS (
  SELECT q.conv_id, q.turn, q.text AS question, a.text AS answer
  FROM conversations q LEFT JOIN conversations a
    ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
  WHERE q.role = 'user'
), ap AS (
  SELECT conv_id, turn,
    '<div id="main"><style>p{}</style><div>' || CASE WHEN conv_id % 4 = 0 THEN 'Menu' ELSE 'You said:' END
    || '</div><p>' || replace(replace(question,'&','&amp;'),'<','&lt;') || '</p><div>Thinking</div><p>'
    || replace(replace(coalesce(answer,'loading'),'&','&amp;'),'<','&lt;') || '</p>'
    || CASE WHEN conv_id % 3 = 1 THEN '<table><tr><th>Feature of</th><th>Turn</th></tr><tr><td>turn</td><td>' || CAST(turn AS VARCHAR)
                                      || '</td></tr></table>' ELSE '' END
    || '<script>var a="</p>";</script><div>All</div><div>AI can make mistakes</div><p>tail</p></div>' AS html,
    question
  FROM qa
)"""


@query("answer_slice", f"""
WITH {_AP}, p AS (SELECT conv_id, turn, {Q.lines('html')} AS lines0, question FROM ap),
{Q.answer_ctes('p', 'conv_id, turn', 'lines0', 'question')}
SELECT conv_id, turn, answer_only FROM s6
""")
def answer_slice(spark, sf_dir):
    """HTM-7 + LIM-2: answer paragraph on AI-answer pages (first anchor, skip, first footer cut, collapse)."""
    ap = S.answer_pages(spark, sf_dir).select("conv_id", "turn", H.html_lines(F.col("html")).alias("lines"),
                                              "question")
    return H.with_answer_slice(ap, "lines", "question").select("conv_id", "turn", "answer_only")


@query("answer_anchor", f"""
WITH {_AP}, p AS (SELECT conv_id, turn, {Q.lines('html')} AS lines0, question FROM ap),
{Q.answer_ctes('p', 'conv_id, turn', 'lines0', 'question')}
SELECT conv_id, turn,
  CASE WHEN coalesce(list_position(ll, 'you said:'), 0) > 0 THEN 'you_said'
       WHEN first_i IS NOT NULL THEN 'question' ELSE 'none' END AS anchor_kind,
  CAST(first_i AS BIGINT) AS start_pos
FROM s2
""")
def answer_anchor(spark, sf_dir):
    """HTM-7a/b: which anchor starts the answer, and the 1-based start line."""
    ap = S.answer_pages(spark, sf_dir).select("conv_id", "turn", H.html_lines(F.col("html")).alias("lines"),
                                              "question")
    start = H.answer_start(F.col("lines"), F.col("question"))
    said = F.array_position(F.transform("lines", lambda x: F.lower(x)), "you said:") > 0
    kind = F.when(said, "you_said").when(start.isNotNull(), "question").otherwise("none")
    return ap.select("conv_id", "turn", kind.alias("anchor_kind"), start.cast("bigint").alias("start_pos"))


@query("answer_fallback", f"""
WITH {_AP}, p AS (SELECT conv_id, turn, {Q.lines('html')} AS lines0, question FROM ap),
{Q.answer_ctes('p', 'conv_id, turn', 'lines0', 'question')}
SELECT conv_id, turn, {Q.sanitize("coalesce(nullif(answer_only, ''), array_to_string(lines, chr(10)))")} AS answer,
       {Q.meaningful(Q.sanitize("coalesce(nullif(answer_only, ''), array_to_string(lines, chr(10)))"))} AS meaningful
FROM s6
""")
def answer_fallback(spark, sf_dir):
    """PRJ-17 + PRJ-15 + FLT-1 on AI-answer pages: answer or full text, sanitised, usable."""
    a = P.page_to_answer(S.answer_pages(spark, sf_dir), question="question", keep=("conv_id", "turn"))
    return a.select("conv_id", "turn", "answer", "meaningful")


@query("sanitize_answer", f"""
SELECT conv_id, turn, {Q.sanitize('text')} AS clean FROM conversations WHERE role = 'assistant'
""")
def sanitize_answer(spark, sf_dir):
    """PRJ-15 on every assistant turn."""
    c = S.read_table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "assistant").select("conv_id", "turn", T.sanitize_answer(F.col("text")).alias("clean"))


@query("meaningful_answer", f"""
SELECT conv_id, turn, {Q.meaningful('text')} AS meaningful FROM conversations
""")
def meaningful_answer(spark, sf_dir):
    """FLT-1 + LIM-1: usable-answer test (300-char UI window) on every conversation turn."""
    c = S.read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.is_meaningful(F.col("text")).alias("meaningful"))


_BODY_RX = r"(?is)<body\b[^>]*>(.*)</body"


@query("region_min_len", f"""
SELECT page_id, 'region' AS kind FROM pages WHERE length({Q.strip('html')}) > {fixed.REGION_MIN_CHARS}
UNION ALL
SELECT page_id, 'body' AS kind FROM pages
WHERE length({Q.strip(f"regexp_extract(html, {Q.lit(_BODY_RX)}, 1)")}) > {fixed.BODY_MIN_CHARS}
""")
def region_min_len(spark, sf_dir):
    """FLT-2: candidates above the size floor: whole page as region (>50), body fallback (>100)."""
    return P.region_kinds(S.pages(spark, sf_dir))


@query("blocked_page", f"""
SELECT page_id,
  regexp_matches(html, {Q.lit(P.BLOCK_FORM_RX)})
  OR contains(array_to_string({Q.lines('html')}, chr(10)), {Q.lit(fixed.BLOCK_TEXT)}) AS blocked
FROM pages
""")
def blocked_page(spark, sf_dir):
    """FLT-5: captcha form or block sentence."""
    pg = S.pages(spark, sf_dir).withColumn("text", H.full_text(H.html_lines(F.col("html"))))
    return pg.select("page_id", P.is_blocked("html", "text").alias("blocked"))


@query("html_lines", f"""
SELECT page_id, CAST(len({Q.lines('html')}) AS BIGINT) AS n_lines, to_json({Q.lines('html')}) AS lines_json FROM pages""")
def html_lines(spark, sf_dir):
    """HTM-2 + FLT-3: each page's clean line array (stripped, empty lines dropped)."""
    pg = S.pages(spark, sf_dir).select("page_id", H.html_lines(F.col("html")).alias("l"))
    return pg.select("page_id", F.size("l").cast("bigint").alias("n_lines"), F.to_json("l").alias("lines_json"))
