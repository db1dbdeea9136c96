"""Vendor and question queries (SRC-1/2, PRJ-1..10, JOIN-1/2, FLT-7, WIN-3, AGG-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import text as T
from vendorscope.operators import questions as QN
from vendorscope.operators import vendors as V
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.sources import catalogue as C
from vendorscope.sources import io as IO
from vendorscope.sources import tables as S

# Oracle CTEs for the derived vendor inputs.
V_SQL = """v AS (
  SELECT c_custkey AS id, c_name AS name, n_name AS city, r_name AS state, c_mktsegment AS category
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

RV_SQL = """rv AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 10 = 0 THEN 'x' || CAST(c_custkey AS VARCHAR)
              WHEN c_custkey % 10 = 1 THEN ' ' || CAST(c_custkey AS VARCHAR) || ' '
              WHEN c_custkey % 10 = 2 THEN '00' || CAST(c_custkey AS VARCHAR)
              ELSE CAST(c_custkey AS VARCHAR) END AS id,
         CASE WHEN c_custkey % 50 = 0 THEN NULL
              WHEN c_custkey % 7 = 0 THEN '  ' || c_mktsegment || '  (events) '
              ELSE c_name END AS name,
         n_name AS city_name, 'IN' AS state_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


def _groups_sql(category: str = C.DEFAULT_CATEGORY) -> str:
    rows = []
    for i, (name, desc, fields) in enumerate(C.groups_for(category)):
        rows.append(f"({i}, {Q.lit(name)}, {Q.lit(desc)}, {Q.lit_list(fields)}, "
                    f"{Q.lit_list(C.sources_for(name))})")
    return ("g AS (SELECT * FROM (VALUES " + ", ".join(rows)
            + ") t(group_ord, group_name, description, fields, source_list))")


def _bullets_sql(fields: str) -> str:
    return (f"array_to_string(list_transform(list_filter({fields}, lambda f: {Q.strip('f')} <> ''), "
            f"lambda f: '- ' || {Q.strip('f')}), chr(10))")


def _sources_sql(lst: str) -> str:
    return f"array_to_string(list_transform({lst}, lambda s, i: CAST(i AS VARCHAR) || '. ' || s), chr(10))"


def _title_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(replace({x}, '_', ' ')), ' '), "
            f"lambda w: upper(substring(w, 1, 1)) || substring(w, 2)), ' ')")


def _question_sql(name: str, city: str, category: str = Q.lit(C.DEFAULT_CATEGORY)) -> str:
    values = {
        "vendor_name": f"coalesce({name}, 'None')",
        "category": _title_sql(category),
        "city": f"coalesce({city}, 'None')",
        "country": Q.lit(fixed.QUESTION_COUNTRY),
        "description": "coalesce(description, '')",
        "parameters": _bullets_sql("fields"),
        "sources": _sources_sql("source_list"),
    }
    parts = [values[p[0]] if isinstance(p, tuple) else Q.lit(p) for p in C.question_pieces()]
    return Q.single_line(" || ".join(parts))


def _rv(spark, sf_dir):
    return S.raw_vendors(spark, sf_dir)


def _norm(spark, sf_dir):
    return V.normalize_vendors(_rv(spark, sf_dir), ordinal="c_custkey")


@query("src_vendor_json", f"WITH {RV_SQL} SELECT id, name, city_name, state_name FROM rv")
def src_vendor_json(spark, sf_dir):
    """SRC-1 round trip: raw exports, each file one JSON array over several lines, read back all-string."""
    path = IO.work_path(spark, "raw_vendors")
    # As many vendors per export as one file holds; the number of exports grows with the vendors.
    rows = _rv(spark, sf_dir).withColumn("export", F.floor(F.col("c_custkey") / 2000))
    text = F.array_join(F.transform(F.collect_list(F.to_json(F.struct("id", "name", "city_name", "state_name"))),
                                    lambda x: F.concat(F.lit("  "), x)), ",\n")
    arrays = rows.groupBy("export").agg(F.concat(F.lit("[\n"), text, F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("export").text(path)
    return IO.read_raw_vendors(spark, path, multiline=True).select("id", "name", "city_name", "state_name")


@query("src_vendor", f"""WITH {RV_SQL}
SELECT CAST(c_custkey AS BIGINT) AS input_ord, id, name, city_name AS city, state_name AS state FROM rv""")
def src_vendor(spark, sf_dir):
    """SRC-2 round trip: normalised vendor list written as JSON lines and read back."""
    path = IO.work_path(spark, "vendors")
    out = _rv(spark, sf_dir).select(F.col("c_custkey").alias("input_ord"), "id", "name",
                                    F.col("city_name").alias("city"), F.col("state_name").alias("state"))
    IO.write_json(out, path)
    return spark.read.schema("input_ord bigint, id string, name string, city string, state string").json(path)


@query("vendor_normalize", f"""WITH {RV_SQL}
SELECT CAST(c_custkey AS BIGINT) AS input_ord, id AS id_raw, name, city_name AS city, state_name AS state FROM rv""")
def vendor_normalize(spark, sf_dir):
    """PRJ-1: rename/drop to (id_raw, name, city, state) with input order."""
    return _norm(spark, sf_dir).select("input_ord", "id_raw", "name", "city", "state")


@query("vendor_id_cast", f"""WITH {RV_SQL}
SELECT id AS id_raw, CASE WHEN regexp_matches(id, '^[0-9]+$') THEN TRY_CAST(id AS BIGINT) END AS id FROM rv""")
def vendor_id_cast(spark, sf_dir):
    """PRJ-2: integer id only when the raw id is all digits."""
    return _norm(spark, sf_dir).select("id_raw", "id")


@query("category_label", f"""WITH {V_SQL}
SELECT DISTINCT category, {_title_sql('category')} AS label FROM v""")
def category_label(spark, sf_dir):
    """PRJ-3: display label of every vendor category."""
    v = S.vendors(spark, sf_dir)
    return v.select("category").distinct().select("category", T.category_label(F.col("category")).alias("label"))


@query("slug", f"""WITH {RV_SQL} SELECT c_custkey, {Q.slug('name')} AS slug FROM rv""")
def slug(spark, sf_dir):
    """PRJ-4: output-file slug of every raw vendor name (null name -> null)."""
    return _rv(spark, sf_dir).select("c_custkey", T.slug(F.col("name")).alias("slug"))


@query("slug_capped", f"""
SELECT conv_id, turn, {Q.slug('text', 80, 'ai_mode')} AS slug FROM conversations WHERE role = 'user'""")
def slug_capped(spark, sf_dir):
    """PRJ-5 + LIM-1: capped slug of every question (artifact names), 'ai_mode' when empty."""
    c = S.read_table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return c.select("conv_id", "turn", T.slug(F.col("text"), cap=80, fallback="ai_mode").alias("slug"))


@query("single_line", f"SELECT conv_id, turn, {Q.single_line('text')} AS text_line FROM conversations")
def single_line(spark, sf_dir):
    """PRJ-7: every conversation turn collapsed to one line."""
    c = S.read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.single_line(F.col("text")).alias("text_line"))


@query("vendor_groups", f"""WITH {V_SQL}, {_groups_sql()}
SELECT id, CAST(group_ord AS BIGINT) AS group_ord, group_name FROM v, g""")
def vendor_groups(spark, sf_dir):
    """JOIN-1: every vendor x every search group of the category."""
    return QN.vendor_groups(S.vendors(spark, sf_dir)).select("id", "group_ord", "group_name")


@query("param_bullets", f"""WITH {V_SQL}, {_groups_sql()}
SELECT id, CAST(group_ord AS BIGINT) AS group_ord, {_bullets_sql('fields')} AS bullets FROM v, g""")
def param_bullets(spark, sf_dir):
    """PRJ-6: parameter bullet list of every (vendor, group)."""
    vg = QN.vendor_groups(S.vendors(spark, sf_dir))
    return vg.select("id", "group_ord", T.param_bullets(F.col("fields")).alias("bullets"))


@query("source_priority", f"""WITH {V_SQL}, {_groups_sql()}
SELECT id, CAST(group_ord AS BIGINT) AS group_ord, CAST(rank AS BIGINT) AS rank, source
FROM (SELECT id, group_ord, unnest(source_list) AS source, unnest(range(1, len(source_list) + 1)) AS rank
      FROM v, g)""")
def source_priority(spark, sf_dir):
    """PRJ-8: ranked search sources for every (vendor, group)."""
    vg = QN.vendor_groups(S.vendors(spark, sf_dir))
    ex = vg.select("id", "group_ord", F.posexplode("source_list").alias("pos", "source"))
    return ex.select("id", "group_ord", (F.col("pos") + 1).cast("bigint").alias("rank"), "source")


@query("build_question", f"""WITH {V_SQL}, {_groups_sql()}
SELECT id, CAST(group_ord AS BIGINT) AS group_ord, {_question_sql('name', 'city')} AS question FROM v, g""")
def build_question(spark, sf_dir):
    """PRJ-9: the one-line research question of every (vendor, group)."""
    vg = QN.vendor_groups(S.vendors(spark, sf_dir))
    return QN.build_questions(vg).select("id", "group_ord", "question")


@query("short_query", f"""WITH {V_SQL}
SELECT id, coalesce(name, 'None') || ' ' || coalesce(city, 'None') || ' ' || {Q.lit(fixed.SHORT_QUERY_SUFFIX)} AS query
FROM v""")
def short_query(spark, sf_dir):
    """PRJ-10: short search query per vendor."""
    v = S.vendors(spark, sf_dir)
    return v.select("id", T.short_query(F.col("name"), F.col("city")).alias("query"))


_LWW_SQL = f"""WITH {RV_SQL}, n AS (
  SELECT c_custkey AS input_ord, id AS id_raw, name, city_name AS city, {Q.slug('name')} AS slug FROM rv
)"""


@query("last_write_wins", f"""{_LWW_SQL}
SELECT city, slug, arg_max(input_ord, input_ord) AS input_ord, arg_max(id_raw, input_ord) AS id_raw,
       arg_max(name, input_ord) AS name
FROM n GROUP BY city, slug""")
def last_write_wins(spark, sf_dir):
    """WIN-3: one vendor per output path (city, slug); the later input wins."""
    n = V.with_slug(_norm(spark, sf_dir)).select("input_ord", "id_raw", "name", "city", "slug")
    return V.last_write_wins(n, ["city", "slug"], "input_ord")


@query("slug_collisions", f"""{_LWW_SQL}
SELECT city, slug, count(*) AS n_writes, max(input_ord) AS winner_ord FROM n GROUP BY city, slug HAVING count(*) > 1""")
def slug_collisions(spark, sf_dir):
    """WIN-3 report: output paths written by more than one vendor."""
    n = V.with_slug(_norm(spark, sf_dir))
    return V.collisions(n, ["city", "slug"], "input_ord")


@query("vendor_count", f"""WITH {RV_SQL}
SELECT count(*) AS n_vendors, count(name) AS n_named, count(DISTINCT city_name) AS n_cities FROM rv""")
def vendor_count(spark, sf_dir):
    """AGG-3: vendor counts of the raw export."""
    rv = _rv(spark, sf_dir)
    return rv.agg(F.count("*").alias("n_vendors"), F.count("name").alias("n_named"),
                  F.countDistinct("city_name").alias("n_cities"))


@query("unknown_category", f"""WITH {V_SQL}
SELECT category, count(*) AS n_vendors FROM v
WHERE category IS NULL OR category NOT IN ({', '.join(Q.lit(c) for c in fixed.SEARCH_MODELS)})
GROUP BY category""")
def unknown_category(spark, sf_dir):
    """FLT-7: vendor categories the catalogue does not know (the run would be rejected)."""
    return V.unknown_categories(S.vendors(spark, sf_dir))


@query("category_lookup", f"""WITH {V_SQL}
SELECT id, category,
  CASE {' '.join(f"WHEN category = {Q.lit(c)} THEN {len(g)}" for c, g in fixed.SEARCH_MODELS.items())} ELSE 0 END > 0
    AS known,
  CAST(CASE {' '.join(f"WHEN category = {Q.lit(c)} THEN {len(g)}" for c, g in fixed.SEARCH_MODELS.items())} ELSE 0 END
    AS BIGINT) AS n_groups
FROM v""")
def category_lookup(spark, sf_dir):
    """JOIN-2: each vendor's category resolved against the catalogue."""
    v = V.with_category(S.vendors(spark, sf_dir))
    return v.select("id", "category", "known", "n_groups")
