"""Answer queries: JOIN-4, PRJ-11/12/18, AGG-1/2, SET-1, SNK-5, WIN-1.

Vendors are the customers; a conversation is a vendor's research session
(conv_id = vendor id) whose n-th user question answers search group n
(``turn div 2``). Its answer page is the AI-answer page built from that turn.
Vendors with no session, or with an unusable answer, keep their row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.operators import answers as A
from vendorscope.operators import questions as QN
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.plans.q_pages import _AP
from vendorscope.plans.q_vendors import V_SQL, _groups_sql, _question_sql
from vendorscope.sources import io as IO
from vendorscope.sources import tables as S

# --- Spark side -----------------------------------------------------------


def answers_table(spark, sf_dir):
    """Outcome per (vendor id, group_ord): answer text, usable flag, tables, HTML, time and error."""
    a = A.page_outcomes(S.fetched_pages(spark, sf_dir), ["conv_id", "turn"])
    return a.select(F.col("conv_id").alias("id"), F.expr("turn div 2").cast("bigint").alias("group_ord"), *A.OUTCOME)


def attached(spark, sf_dir, with_question: bool = False):
    vg = QN.vendor_groups(S.vendors(spark, sf_dir)).select("id", "name", "city", "state", "group_ord", "group_name")
    found = A.attach_answers(vg, answers_table(spark, sf_dir), ["id", "group_ord"])
    # The question's text is long and made of the row itself, so it is made behind the join: only short columns are shuffled.
    return QN.questions_of(found).select(*found.columns, "question") if with_question else found


# --- Oracle side ----------------------------------------------------------

_ANS_SQL = f"""{V_SQL}, {_groups_sql()}, {_AP},
p AS (SELECT conv_id, turn, {Q.lines('html')} AS lines0, question FROM ap),
{Q.answer_ctes('p', 'conv_id, turn', 'lines0', 'question')},
ans0 AS (
  SELECT conv_id AS id, turn, CAST(turn // 2 AS BIGINT) AS group_ord, {S.FETCH_FAILS} AS fails,
         {Q.sanitize("coalesce(nullif(answer_only, ''), array_to_string(lines, chr(10)))")} AS answer
  FROM s6
), ans AS (
  SELECT ans0.*, {Q.meaningful('answer')} AND NOT fails AS success,
         TIMESTAMP '{S.FETCHED_AT}' + to_minutes(CAST(id AS BIGINT)) + to_seconds(ans0.turn) AS ts,
         CASE WHEN id % 3 = 1 THEN ['| Feature | Turn |' || chr(10) || '| --- | --- |' || chr(10) || '| turn | ' || CAST(ans0.turn AS VARCHAR) || ' |']
              ELSE []::VARCHAR[] END AS tables,
         {Q.lit(S.PAGE_TOP)} || ap.html || {Q.lit(S.PAGE_FOOT)} AS page,
         {Q.strip(r"regexp_extract(ap.html, '(?s)^<div id=.main.>(.*)</div>$', 1)")} AS region
  FROM ans0 JOIN ap ON ap.conv_id = ans0.id AND ap.turn = ans0.turn
),
qs AS (SELECT id, name, city, state, CAST(group_ord AS BIGINT) AS group_ord, group_name, description, fields, source_list
       FROM v, g),
j AS (
  SELECT qs.*, nullif(CASE WHEN ans.success THEN ans.answer END, '') AS answer_text,
         ans.id IS NOT NULL AS fetched, fails, ts, tables, region, CASE WHEN NOT fails THEN page END AS page
  FROM qs LEFT JOIN ans ON qs.id = ans.id AND qs.group_ord = ans.group_ord
), ja AS (
  SELECT *, answer_text IS NULL AS failed,
         CASE WHEN answer_text IS NOT NULL THEN NULL WHEN NOT fetched THEN 'no_input' WHEN fails THEN 'error'
              ELSE 'no_response' END AS reason
  FROM j
)"""

_BLOCK_SQL = ("'================ ' || upper(group_name) || ' ================' || chr(10) || chr(10) "
              "|| '    ' || answer_text")


@query("answer_text", f"""WITH {_ANS_SQL}
SELECT id, group_ord, nullif(CASE WHEN success THEN answer END, '') AS answer_text FROM ans""")
def answer_text(spark, sf_dir):
    """PRJ-11: usable answer text per answered question (null when unusable)."""
    a = answers_table(spark, sf_dir)
    return a.select("id", "group_ord", F.nullif(F.when(F.col("success"), F.col("answer")), F.lit("")).alias("answer_text"))


@query("attach_answers", f"""WITH {_ANS_SQL}
SELECT id, group_ord, answer_text, failed, reason FROM ja""")
def attach_answers(spark, sf_dir):
    """JOIN-4: every (vendor, group) question with its answer; failures keep the vendor."""
    return attached(spark, sf_dir).select("id", "group_ord", "answer_text", "failed", "reason")


@query("failed_groups", f"""WITH {_ANS_SQL}
SELECT id, CAST(count(*) FILTER (WHERE failed) AS BIGINT) AS n_failed, count(*) AS n_groups FROM ja GROUP BY id""")
def failed_groups(spark, sf_dir):
    """AGG-2: failed search groups per vendor."""
    return A.failed_groups(attached(spark, sf_dir), "id")


@query("section_block", f"""WITH {_ANS_SQL}
SELECT id, group_ord, {_BLOCK_SQL} AS block FROM ja WHERE answer_text IS NOT NULL""")
def section_block(spark, sf_dir):
    """PRJ-12: header-ruled block of every usable group answer."""
    from vendorscope.functions.text import section_block as sb
    a = attached(spark, sf_dir).where(~F.col("failed"))
    return a.select("id", "group_ord", sb(F.col("group_name"), F.col("answer_text")).alias("block"))


@query("combine_text", f"""WITH {_ANS_SQL}
SELECT id, coalesce(string_agg({_BLOCK_SQL}, chr(10) || chr(10) ORDER BY group_ord)
                    FILTER (WHERE answer_text IS NOT NULL), '') AS combined_text
FROM ja GROUP BY id""")
def combine_text(spark, sf_dir):
    """AGG-1: per vendor, usable blocks in group order with a blank line between ('' if none)."""
    return A.combine_text(attached(spark, sf_dir), "id")


_ENV_SQL = f"""
SELECT id, group_ord, {_question_sql('name', 'city')} AS question, NOT failed AS success,
       answer_text AS answer, to_json(CASE WHEN failed THEN []::VARCHAR[] ELSE tables END) AS tables,
       CASE WHEN NOT failed THEN region END AS raw_html, CASE WHEN NOT failed THEN ts END AS timestamp,
       CASE reason WHEN 'no_input' THEN {Q.lit(fixed.NO_INPUT_TEXT)} WHEN 'error' THEN {Q.lit(S.FETCH_ERROR)}
                   WHEN 'no_response' THEN {Q.lit(fixed.FAILURE_TEXT)} END AS error,
       CASE WHEN NOT failed THEN 'text' END AS format
FROM ja"""
_ENV = ("question", "answer", "tables", "raw_html", "success", "timestamp", "error", "format")


@query("answer_envelope", f"WITH {_ANS_SQL} {_ENV_SQL}")
def answer_envelope(spark, sf_dir):
    """PRJ-18: uniform result rows (question, answer, tables, raw_html, success, timestamp, error, format)."""
    env = A.envelope(attached(spark, sf_dir, with_question=True))
    return env.select("id", "group_ord", *_ENV).withColumn("tables", F.to_json("tables"))


@query("union_results", f"""WITH {_ANS_SQL}, e AS ({_ENV_SQL})
SELECT success, format, error IS NOT NULL AS has_error, count(*) AS n, count(answer) AS n_answer FROM e
GROUP BY 1, 2, 3""")
def union_results(spark, sf_dir):
    """SET-1: success and failure batches of different shapes merged by name."""
    env = A.envelope(attached(spark, sf_dir), question="name")
    return (env.groupBy("success", "format", F.col("error").isNotNull().alias("has_error"))
            .agg(F.count("*").alias("n"), F.count("answer").alias("n_answer")))


@query("quarantine_pages", f"""WITH {_ANS_SQL}
SELECT id, group_ord, reason, {Q.slug(_question_sql('name', 'city'), 80, 'ai_mode')} AS slug, page AS page_html,
       CASE WHEN fails THEN {Q.lit(S.FETCH_ERROR)} END AS error, ts
FROM ja WHERE failed""")
def quarantine_pages(spark, sf_dir):
    """SNK-5: failed questions written partitioned by reason with their capped slug, page HTML, error and time; read back."""
    bad = attached(spark, sf_dir, with_question=True).where(F.col("failed"))
    out = IO.quarantine(bad.select("id", "group_ord", "reason", "question", "page_html", "error", "ts")).drop("question")
    path = IO.work_path(spark, "quarantine")
    IO.write_partitioned(out, path, ["reason"])
    return IO.read_partitioned(spark, path).select("id", "group_ord", "reason", "slug", "page_html", "error", "ts")


_SN_SQL = """sn AS (
  SELECT user_id AS question_id, event_id, ts, MIN(ts) OVER (PARTITION BY user_id) AS asked_ts,
    CASE WHEN event_type = 'error' THEN 'loading' ELSE rpad('answer ' || event_type || ' ', 90, 'x') END AS answer
  FROM events
)"""


def _first_sql(deadline_s: int) -> str:
    return f"""WITH {_SN_SQL}, ok AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY ts, event_id) AS rn
  FROM sn WHERE {Q.meaningful('answer')} AND ts <= asked_ts + INTERVAL {deadline_s} SECOND
), qs AS (SELECT DISTINCT question_id FROM sn)
SELECT qs.question_id, CASE WHEN ok.event_id IS NULL THEN 'no_response' ELSE 'success' END AS status,
       ok.ts, ok.event_id, ok.answer
FROM qs LEFT JOIN ok ON qs.question_id = ok.question_id AND ok.rn = 1"""


@query("first_meaningful", _first_sql(70))
def first_meaningful(spark, sf_dir):
    """WIN-1: first usable snapshot per question within 70 s of asking, else no_response."""
    return A.first_meaningful(S.snapshots(spark, sf_dir), deadline_s=70)


@query("first_meaningful_day", _first_sql(86400))
def first_meaningful_day(spark, sf_dir):
    """WIN-1 with a one-day deadline."""
    return A.first_meaningful(S.snapshots(spark, sf_dir), deadline_s=86400)
