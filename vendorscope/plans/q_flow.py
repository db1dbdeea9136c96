"""The end-to-end run and the catalogue as data (JOIN-2, JOIN-3, FLT-7, PRJ-18, SNK-5, AGG-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.operators import flow as FL
from vendorscope.operators import questions as QN
from vendorscope.operators import vendors as V
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.plans.q_answers import _ANS_SQL, _BLOCK_SQL
from vendorscope.plans.q_enrich import _CP, _clean_sources_sql, _status_sql, prompt_sql
from vendorscope.plans.q_vendors import V_SQL, _question_sql
from vendorscope.sources import catalogue as C
from vendorscope.sources import tables as S

_MODELS, _OUTPUTS = S.category_models()


def _category_groups_sql() -> str:
    rows = ", ".join(f"({Q.lit(c)}, {i}, {Q.lit(g)}, {Q.lit(about)}, {Q.lit_list(fields)}, {Q.lit_list(C.sources_for(g))})"
                     for c, groups in _MODELS.items() for i, (g, about, fields) in enumerate(groups))
    return f"gc AS (SELECT * FROM (VALUES {rows}) t(of_category, group_ord, group_name, description, fields, source_list))"


def _model_sql(category: str) -> str:
    cases = " ".join(f"WHEN {Q.lit(c)} THEN {Q.lit(C.model_text(fields))}" for c, fields in _OUTPUTS.items())
    return f"CASE {category} {cases} ELSE 'None' END"


@query("category_groups", f"""WITH {V_SQL}, {_category_groups_sql()}
SELECT id, category, CAST(group_ord AS BIGINT) AS group_ord, group_name, {_question_sql('name', 'city', 'category')} AS question,
       nullif({_model_sql('category')}, 'None') AS model
FROM v JOIN gc ON of_category = category""")
def category_groups(spark, sf_dir):
    """JOIN-2 + JOIN-3 + FLT-7 on data: every vendor with the groups, questions and output model of its own category."""
    v = V.with_catalogue(S.vendors(spark, sf_dir), C.catalogue(spark, _MODELS, _OUTPUTS))
    vg = QN.build_questions(QN.catalogue_groups(v), F.col("category"))
    return vg.select("id", "category", "group_ord", "group_name", "question", "model")


_FLOW_SQL = f"""{_ANS_SQL}, {_category_groups_sql()}, {_CP},
fq AS (
  SELECT v.id, v.name, v.city, v.state, v.category, gc.group_name, CAST(gc.group_ord AS BIGINT) AS group_ord, ans.tables,
         nullif(CASE WHEN ans.success AND NOT ({S.LATE.replace('conv_id', 'ans.id')}) THEN ans.answer END, '') AS answer_text
  FROM v JOIN gc ON of_category = category LEFT JOIN ans ON ans.id = v.id AND ans.group_ord = gc.group_ord
), ft AS (
  SELECT id, name, city, state, category, count(*) AS n_groups, count(*) FILTER (WHERE answer_text IS NULL) AS n_failed,
         CAST(sum(CASE WHEN answer_text IS NULL THEN 0 ELSE len(tables) END) AS BIGINT) AS n_tables,
         coalesce(string_agg({_BLOCK_SQL}, chr(10) || chr(10) ORDER BY group_ord) FILTER (WHERE answer_text IS NOT NULL), '') AS combined_text
  FROM fq GROUP BY ALL
), fp AS (
  SELECT ft.*, {prompt_sql(_model_sql('category'))} AS prompt, cp.raw FROM ft LEFT JOIN cp ON cp.vendor_id = ft.id
), fs AS (SELECT *, {_status_sql('raw')} AS parse_status FROM fp)"""


@query("vendor_profile_flow", f"""WITH {_FLOW_SQL}
SELECT id, category, n_groups, n_failed, n_tables, combined_text, sha256(prompt) AS prompt_sha, parse_status,
       CASE WHEN parse_status = 'ok' THEN coalesce(json_extract_string(raw, '$.website'), '') ELSE '' END AS website,
       CASE WHEN parse_status = 'ok' THEN coalesce(json_extract_string(raw, '$.phone'), '') ELSE '' END AS phone,
       to_json(coalesce(CASE WHEN parse_status = 'ok' THEN {_clean_sources_sql('raw')} END, []::VARCHAR[])) AS sources
FROM fs""")
def vendor_profile_flow(spark, sf_dir):
    """The whole run: one profile per vendor from its category's groups, page snapshots, first usable answers, prompt and completion."""
    shots = S.page_snapshots(spark, sf_dir).withColumnRenamed("conv_id", "id").withColumn("group_ord", F.expr("turn div 2").cast("bigint"))
    out = FL.vendor_profiles(S.vendors(spark, sf_dir), shots, S.completions(spark, sf_dir).withColumnRenamed("vendor_id", "id"),
                             C.catalogue(spark, _MODELS, _OUTPUTS), deadline_s=70)
    return out.select("id", "category", "n_groups", "n_failed", "n_tables", "combined_text", "prompt_sha", "parse_status", "website", "phone",
                      F.to_json("sources").alias("sources"))


@query("flow_outcomes", f"""WITH {_FLOW_SQL}
SELECT v.id, CAST(gc.group_ord AS BIGINT) AS group_ord,
       CASE WHEN fq.answer_text IS NOT NULL THEN NULL WHEN ans.id IS NULL THEN 'no_input' WHEN ans.fails THEN 'error' ELSE 'no_response' END AS reason,
       CASE WHEN fq.answer_text IS NULL THEN ans.page END AS page_html, CASE WHEN fq.answer_text IS NOT NULL THEN ans.region END AS raw_html,
       ans.ts + to_seconds(CASE WHEN {S.LATE.replace('conv_id', 'ans.id')} THEN 80 ELSE 30 END) AS ts
FROM v JOIN gc ON of_category = category JOIN fq ON fq.id = v.id AND fq.group_ord = gc.group_ord
LEFT JOIN (SELECT * REPLACE (CASE WHEN NOT fails THEN page END AS page) FROM ans) ans ON ans.id = v.id AND ans.group_ord = gc.group_ord""")
def flow_outcomes(spark, sf_dir):
    """PRJ-18 + SNK-5 in the run: each question's outcome, with the page of a failed one and the region of an answered one."""
    shots = S.page_snapshots(spark, sf_dir).withColumnRenamed("conv_id", "id").withColumn("group_ord", F.expr("turn div 2").cast("bigint"))
    out = FL.attached_outcomes(S.vendors(spark, sf_dir), shots, C.catalogue(spark, _MODELS, _OUTPUTS), deadline_s=70)
    return out.select("id", "group_ord", "reason", "page_html", "raw_html", "ts")
