"""Enrichment queries: PRJ-13/14, JOIN-3/6, UDF-1, JSN-1..4, AGG-5.

Prompts are built per vendor from the combined answer text. Completions
are the orders-derived completion table (vendor_id = order key); a vendor
without a completion keeps its row.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.operators import answers as A
from vendorscope.operators import enrich as EN
from vendorscope.operators import questions as QN
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.plans.q_answers import _ANS_SQL, _BLOCK_SQL, attached
from vendorscope.sources import catalogue as C
from vendorscope.sources import io as IO
from vendorscope.sources import tables as S

_CP = """cp AS (
  SELECT o_orderkey AS vendor_id,
    CASE o_orderkey % 7 WHEN 0 THEN CASE o_orderkey % 14 WHEN 0 THEN 'not json'
        ELSE '{"phone":"9","sources":["Overview"]}' || chr(10) || chr(10) || 'Note: done' END WHEN 1 THEN '[1]'
      WHEN 2 THEN '{"phone":"","sources":"x"}' WHEN 3 THEN NULL
      ELSE '{"website":"http://o' || CAST(o_orderkey AS VARCHAR)
        || '.example","sources":["Overview"," JustDial ","Official Website","https://www.justdial.com/x"],"zz":1}' END AS raw
  FROM orders
)"""


def prompt_sql(model: str = Q.lit(C.output_model_text())) -> str:
    values = {"vendor_name": "coalesce(name, 'None')", "city": "coalesce(city, 'None')",
              "state": "coalesce(state, 'None')", "content": "coalesce(combined_text, 'None')",
              "output_format": model}
    return " || ".join(values[p[0]] if isinstance(p, tuple) else Q.lit(p) for p in EN.template_pieces())


_CT_SQL = f"""{_ANS_SQL}, ct AS (
  SELECT id, name, city, state,
         coalesce(string_agg({_BLOCK_SQL}, chr(10) || chr(10) ORDER BY group_ord)
                  FILTER (WHERE answer_text IS NOT NULL), '') AS combined_text
  FROM ja GROUP BY id, name, city, state
)"""

_PROMPTS_SQL = f"""{_CT_SQL}, pr AS (SELECT id, city, {prompt_sql()} AS prompt FROM ct), {_CP},
pc AS (SELECT pr.*, sha256(prompt) AS prompt_sha, cp.raw FROM pr LEFT JOIN cp ON pr.id = cp.vendor_id)"""


def prompts(spark, sf_dir):
    ct = A.combine_text(attached(spark, sf_dir), ["id", "name", "city", "state"])
    return EN.build_prompts(ct)


def prompts_with_completions(spark, sf_dir):
    cp = S.completions(spark, sf_dir).withColumnRenamed("vendor_id", "id")
    return EN.attach_completions(prompts(spark, sf_dir), cp, "id")


@query("build_prompt", f"""WITH {_PROMPTS_SQL}
SELECT id, sha256(prompt) AS prompt_sha, CAST(length(prompt) AS BIGINT) AS prompt_chars FROM pr""")
def build_prompt(spark, sf_dir):
    """PRJ-13: single-pass filled extraction prompt per vendor (hash and length)."""
    p = prompts(spark, sf_dir)
    return p.select("id", "prompt_sha", F.length("prompt").cast("bigint").alias("prompt_chars"))


@query("attach_completions", f"""WITH {_PROMPTS_SQL} SELECT id, prompt_sha, raw FROM pc""")
def attach_completions(spark, sf_dir):
    """JOIN-6: every vendor prompt with its completion (null when none)."""
    return prompts_with_completions(spark, sf_dir).select("id", "prompt_sha", "raw")


@query("text_lengths", f"""WITH {_PROMPTS_SQL}
SELECT id, CAST(length(prompt) AS BIGINT) AS prompt_chars, CAST(coalesce(length(raw), 0) AS BIGINT) AS result_chars
FROM pc""")
def text_lengths(spark, sf_dir):
    """PRJ-14: prompt and completion lengths per vendor."""
    return EN.text_lengths(prompts_with_completions(spark, sf_dir)).select("id", "prompt_chars", "result_chars")


@query("run_metrics", f"""WITH {_PROMPTS_SQL}
SELECT city, count(*) AS n_vendors, count(raw) AS n_completed, CAST(sum(length(prompt)) AS BIGINT) AS prompt_chars,
       CAST(sum(coalesce(length(raw), 0)) AS BIGINT) AS result_chars
FROM pc GROUP BY city""")
def run_metrics(spark, sf_dir):
    """AGG-5: vendors, completions and character volumes per city."""
    return EN.run_metrics(EN.text_lengths(prompts_with_completions(spark, sf_dir)), ["city"])


@query("run_metrics_observed", f"""WITH {_PROMPTS_SQL}
SELECT count(*) AS n_vendors, count(raw) AS n_completed, CAST(sum(length(prompt)) AS BIGINT) AS prompt_chars,
       CAST(sum(coalesce(length(raw), 0)) AS BIGINT) AS result_chars
FROM pc""")
def run_metrics_observed(spark, sf_dir):
    """AGG-5 in the main pass: the run's metrics, observed while its prompts and completions are written."""
    rows, seen = EN.observed(prompts_with_completions(spark, sf_dir))
    rows.write.parquet(IO.work_path(spark, "run"))
    return spark.createDataFrame([seen.get], "n_vendors long, n_completed long, prompt_chars long, result_chars long")


@query("model_lookup", f"""WITH v AS (
  SELECT c_custkey AS id, c_mktsegment AS category FROM customer
)
SELECT id, category, CAST(CASE {' '.join(f"WHEN category = {Q.lit(c)} THEN {len(m)}" for c, m in fixed.OUTPUT_MODELS.items())}
  ELSE 0 END AS BIGINT) AS n_model_fields FROM v""")
def model_lookup(spark, sf_dir):
    """JOIN-3: output model of each vendor's category (0 fields = no model, prompt gets None)."""
    sizes = F.create_map(*[x for c, m in fixed.OUTPUT_MODELS.items() for x in (F.lit(c), F.lit(len(m)))])
    v = S.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("category"))
    return v.select("id", "category", F.coalesce(F.element_at(sizes, F.col("category")), F.lit(0)).cast("bigint")
                    .alias("n_model_fields"))


def _status_sql(raw: str) -> str:
    return (f"CASE WHEN {raw} IS NULL THEN 'missing' WHEN NOT json_valid({raw}) THEN 'invalid' "
            f"WHEN json_type({raw}) <> 'OBJECT' THEN 'not_object' ELSE 'ok' END")


@query("json_status", f"WITH {_CP} SELECT vendor_id, {_status_sql('raw')} AS parse_status FROM cp")
def json_status(spark, sf_dir):
    """JSN-1: completion parse status (ok / invalid / not_object / missing)."""
    cp = S.completions(spark, sf_dir)
    return cp.select("vendor_id", EN.json_status(F.col("raw")).alias("parse_status"))


def _clean_sources_sql(raw: str) -> str:
    arr = f"CAST(json_extract({raw}, '$.sources') AS VARCHAR[])"
    bl = Q.lit_list(fixed.INVALID_SOURCES)
    keep = f"list_filter({arr}, lambda x: NOT list_contains({bl}, lower({Q.strip("coalesce(x, 'None')")})))"
    return f"CASE WHEN json_type(json_extract({raw}, '$.sources')) = 'ARRAY' THEN {keep} END"


@query("clean_sources", f"""WITH {_CP}
SELECT vendor_id, to_json({_clean_sources_sql('raw')}) AS sources_json
FROM cp WHERE {_status_sql('raw')} = 'ok'""")
def clean_sources(spark, sf_dir):
    """JSN-2: blacklisted sources dropped from list-valued ``sources`` (others untouched -> null)."""
    cp = EN.with_sources(S.completions(spark, sf_dir)).where(F.col("parse_status") == "ok")
    return cp.select("vendor_id", F.to_json("sources").alias("sources_json"))


def record_columns_sql() -> list[str]:
    """The output model's fields from ``raw`` where ``ok``."""
    cols = []
    for f, kind in C.output_fields():
        path = Q.lit(f"$.{f}")
        if f == "sources":
            cols.append(f"to_json(coalesce(CASE WHEN ok THEN {_clean_sources_sql('raw')} END, []::VARCHAR[])) AS {f}")
        elif kind == "string":
            cols.append(f"coalesce(CASE WHEN ok THEN json_extract_string(raw, {path}) END, '') AS {f}")
        else:
            cols.append(f"to_json(coalesce(CASE WHEN ok AND json_type(json_extract(raw, {path})) = 'ARRAY' "
                        f"THEN CAST(json_extract(raw, {path}) AS VARCHAR[]) END, []::VARCHAR[])) AS {f}")
    return cols


def _record_sql() -> str:
    cols = record_columns_sql()
    model = Q.lit_list([f for f, _ in C.output_fields()])
    return (f"WITH {_CP}, st AS (SELECT vendor_id, raw, {_status_sql('raw')} AS parse_status, "
            f"{_status_sql('raw')} = 'ok' AS ok FROM cp)\n"
            f"SELECT vendor_id, {', '.join(cols)}, "
            f"CASE WHEN ok THEN to_json(list_filter(json_keys(raw), lambda k: NOT list_contains({model}, k))) END "
            f"AS extra_keys, parse_status FROM st")


@query("profile_record", _record_sql())
def profile_record(spark, sf_dir):
    """JSN-4: 19-field typed record per completion ("" / [] defaults), extra keys, parse status."""
    rec = EN.profile_record(S.completions(spark, sf_dir))
    arrays = {f for f, k in C.output_fields() if k == "array"}
    cols = [F.to_json(F.col(f)).alias(f) if f in arrays else F.col(f) for f, _ in C.output_fields()]
    return rec.select("vendor_id", *cols, F.to_json("extra_keys").alias("extra_keys"), "parse_status")


@query("profile_json", f"""WITH {_CP}
SELECT vendor_id, replace(raw, '["Overview"," JustDial ","Official Website",',
                          CASE WHEN {_status_sql('raw')} = 'ok' THEN '["Official Website",'
                               ELSE '["Overview"," JustDial ","Official Website",' END) AS profile_json
FROM cp WHERE raw IS NOT NULL""")
def profile_json(spark, sf_dir):
    """JSN-3: every completion as saved: blacklisted sources cut, all else and all other text as it came."""
    rec = EN.profile_record(S.completions(spark, sf_dir)).where(F.col("raw").isNotNull())
    return rec.select("vendor_id", "profile_json")


def _stub_completion(prompts: pd.Series) -> pd.Series:
    """Deterministic stand-in for a model: the first URL in the prompt as the website."""
    urls = prompts.str.extract(f"({_STUB_URL})", expand=False)
    return urls.map(lambda u: '{"website":"%s","sources":[]}' % u if isinstance(u, str) else '{"sources":[]}')


_STUB_URL = r"""https?://[^\s"<>]+"""


@query("enrich_with", f"""WITH {_PROMPTS_SQL}, d AS (
  SELECT DISTINCT sha256(prompt) AS prompt_sha, nullif(regexp_extract(prompt, {Q.lit(_STUB_URL)}, 0), '') AS url FROM pr
)
SELECT pr.id, sha256(pr.prompt) AS prompt_sha,
       CASE WHEN d.url IS NULL THEN '{{"sources":[]}}' ELSE '{{"website":"' || d.url || '","sources":[]}}' END AS raw
FROM pr JOIN d ON d.prompt_sha = sha256(pr.prompt)""")
def enrich_with(spark, sf_dir):
    """UDF-1: user completion function over the distinct prompts (Arrow batches), joined back."""
    p = prompts(spark, sf_dir)
    done = EN.enrich_with(p, _stub_completion)
    return EN.attach_completions(p.select("id", "prompt_sha"), done, "prompt_sha")


def _failing_completion(prompts: pd.Series) -> pd.Series:
    """The stand-in, failing on prompts without any URL."""
    if not prompts.str.contains("://").all():
        raise ValueError("no source")
    return _stub_completion(prompts)


@query("enrich_resumed", f"""WITH {_PROMPTS_SQL}, d AS (
  SELECT DISTINCT sha256(prompt) AS prompt_sha, nullif(regexp_extract(prompt, {Q.lit(_STUB_URL)}, 0), '') AS url FROM pr
)
SELECT prompt_sha, CASE WHEN url IS NOT NULL THEN '{{"website":"' || url || '","sources":[]}}' END AS raw,
       CASE WHEN url IS NULL THEN 'ValueError: no source' END AS error FROM d""")
def enrich_resumed(spark, sf_dir):
    """UDF-1, resumable: a run over some vendors' prompts, then one over all that asks only the rest; failures recorded per prompt."""
    from vendorscope.session import cut_lineage
    p = cut_lineage(prompts(spark, sf_dir).select("id", "prompt"))
    store = IO.work_path(spark, "completions")
    EN.enrich_into(p.where(F.col("id") % 3 == 0), _failing_completion, store, waves=2)
    return EN.enrich_into(p, _failing_completion, store, waves=2)


def _model_rows_sql() -> str:
    rows = ", ".join(f"({i}, {Q.lit(f)}, {Q.lit(k)})" for i, (f, k) in enumerate(C.output_fields()))
    return f"m AS (SELECT * FROM (VALUES {rows}) t(pos, field, kind))"


def _catalogue_rows_sql() -> str:
    rows = ", ".join(f"({g}, {Q.lit(name)}, {j}, {Q.lit(f)})" for g, (name, _, fields) in enumerate(C.groups_for())
                     for j, f in enumerate(fields))
    return f"sf AS (SELECT * FROM (VALUES {rows}) t(group_ord, group_name, field_ord, field))"


@query("dim_search_fields", f"""WITH {_catalogue_rows_sql()}, n AS (SELECT count(*) AS n FROM customer)
SELECT CAST(group_ord AS BIGINT) AS group_ord, group_name, CAST(field_ord AS BIGINT) AS field_ord, field,
       n.n AS n_questions FROM sf, n""")
def dim_search_fields(spark, sf_dir):
    """SRC-4: the catalogue's (group, field) rows with the number of vendor questions asking for each."""
    vg = QN.vendor_groups(S.vendors(spark, sf_dir))
    ex = vg.select("group_ord", "group_name", F.posexplode("fields").alias("field_ord", "field"))
    return ex.groupBy("group_ord", "group_name", F.col("field_ord").cast("bigint").alias("field_ord"), "field") \
        .agg(F.count("*").alias("n_questions"))


def _key_counts(spark, sf_dir):
    cp = S.completions(spark, sf_dir).where(EN.json_status(F.col("raw")) == "ok")
    return cp.select(F.explode(F.array_distinct(F.json_object_keys("raw"))).alias("field")) \
        .groupBy("field").agg(F.count("*").alias("n_completions"))


@query("dim_output_model", f"""WITH {_CP}, {_model_rows_sql()}, ok AS (
  SELECT raw FROM cp WHERE {_status_sql('raw')} = 'ok'
), k AS (SELECT unnest(list_distinct(json_keys(raw))) AS field FROM ok)
SELECT CAST(m.pos AS BIGINT) AS pos, m.field, m.kind, count(k.field) AS n_present
FROM m LEFT JOIN k ON k.field = m.field GROUP BY m.pos, m.field, m.kind""")
def dim_output_model(spark, sf_dir):
    """SRC-5: the output model (position, field, string/array) with how many valid completions carry each field."""
    rows = [(i, f, k) for i, (f, k) in enumerate(C.output_fields())]
    model = spark.createDataFrame(rows, "pos long, field string, kind string")
    # The model is a fixed 19-row literal: broadcasting it is bounded.
    return _key_counts(spark, sf_dir).join(F.broadcast(model), "field", "right") \
        .select("pos", "field", "kind", F.coalesce("n_completions", F.lit(0)).alias("n_present"))


@query("field_drift", f"""WITH {_CP}, {_model_rows_sql()}, {_catalogue_rows_sql()}, ok AS (
  SELECT raw FROM cp WHERE {_status_sql('raw')} = 'ok'
), k AS (SELECT field, count(*) AS n FROM (SELECT unnest(list_distinct(json_keys(raw))) AS field FROM ok) GROUP BY field),
f AS (SELECT field FROM m UNION SELECT field FROM sf UNION SELECT field FROM k)
SELECT f.field, f.field IN (SELECT field FROM sf) AS searched, f.field IN (SELECT field FROM m) AS in_model,
       coalesce(k.n, 0) AS n_completions
FROM f LEFT JOIN k ON k.field = f.field""")
def field_drift(spark, sf_dir):
    """JOIN-8: searched fields vs output model vs keys the completions actually return (both ways)."""
    model = [f for f, _ in C.output_fields()]
    searched = [f for _, _, fields in C.groups_for() for f in fields]
    fixed_rows = spark.createDataFrame([(f,) for f in dict.fromkeys(model + searched)], "field string")
    keys = _key_counts(spark, sf_dir)
    allf = fixed_rows.join(keys, "field", "full")
    return allf.select("field", F.col("field").isin(searched).alias("searched"),
                       F.col("field").isin(model).alias("in_model"),
                       F.coalesce("n_completions", F.lit(0)).alias("n_completions"))
