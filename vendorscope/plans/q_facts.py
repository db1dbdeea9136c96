"""Fact queries (EXT-1..10) on fact answers (one reply-format answer per line item,
vendor = part) and contact routing on whole document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions.text import WS
from vendorscope.operators import facts as FX
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.sources import catalogue as C
from vendorscope.sources import tables as S

_FA = """fa AS (
  SELECT l_partkey AS vendor_id, l_orderkey, l_linenumber,
    'Parameter: website Value: http://s' || CAST(l_suppkey AS VARCHAR) || '.example.com Source URL: ' || src
    || ' Parameter: rating Value: ' || CASE WHEN l_linenumber = 1 THEN 'Not Found'
         WHEN l_partkey % 2 = 0 THEN CAST(l_partkey % 5 AS VARCHAR) ELSE CAST(l_linenumber AS VARCHAR) END
    || CASE WHEN l_linenumber % 4 <> 0 THEN ' Source URL: none'
         ELSE ' Parameter: price_range Value: ' || CAST(l_suppkey AS VARCHAR) || ' Source URL: ' || src
           || ' Parameter: services_offered Value: s' || CAST(l_suppkey % 3 AS VARCHAR) || ', common ,t'
           || CAST(l_suppkey % 4 AS VARCHAR) || ' Source URL: ' || src
           || ' Parameter: address Value: ' || CAST(l_suppkey AS VARCHAR) || ' Main Road, Pune Source URL: ' || src
           || ' Parameter: review_count Value: ' || CAST(l_partkey % 900 AS VARCHAR) || ' Source URL: ' || src END AS answer
  FROM (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 'https://www.instagram.com/p'
          WHEN 1 THEN 'https://www.facebook.com/p'
          ELSE CASE WHEN l_suppkey % 2 = 0 THEN 'https://site.example.com/pricing' ELSE 'https://site.example.com' END
          END AS src FROM lineitem)
)"""

_KEYS = ["vendor_id", "l_orderkey", "l_linenumber"]


# The reply format and the source priorities, stated here for the oracle alone.
_REPLY = r"(?s)^(.*?)Value:(.*?)(?:Source URL:(.*))?$"
_WEBSITE, _RATING, _PRICE = ("website", "instagram", "facebook", "google_business", "phone", "email", "address"), \
    ("rating", "review_count", "trust_rating"), ("price_range",)
_PRIORITY = {  # parameters -> [(host or path condition on url, rank)]
    _WEBSITE: [("instagram", 3), ("facebook", 4), ("", 1)],
    _PRICE: [("instagram", 3), ("facebook", 4), ("/pricing", 2), ("", 1)],
    _RATING: [("instagram", 99), ("facebook", 3), ("", 2)],
    (): [("instagram", 3), ("facebook", 4), ("", 1)],
}


def _part(i: int) -> str:
    return f"nullif({Q.strip(f'regexp_extract(b, {Q.lit(_REPLY)}, {i})')}, '')"


def _rank_sql(param: str, url: str) -> str:
    def of(rules) -> str:
        whens = " ".join(f"WHEN contains({url}, {Q.lit(part)}) THEN {rank}" for part, rank in rules)
        return f"CASE WHEN {url} IS NULL OR NOT starts_with({url}, 'http') THEN 99 {whens} END"
    groups = " ".join(f"WHEN {param} IN ({', '.join(Q.lit(n) for n in names)}) THEN {of(rules)}" for names, rules in _PRIORITY.items() if names)
    return f"CAST(CASE {groups} ELSE {of(_PRIORITY[()])} END AS BIGINT)"


_FACTS_SQL = f"""{_FA}, fb0 AS (
  SELECT vendor_id, l_orderkey, l_linenumber, regexp_split_to_array(answer, 'Parameter:\\s*') AS pieces FROM fa
), fb AS (
  SELECT vendor_id, l_orderkey, l_linenumber, unnest(list_slice(pieces, 2, len(pieces))) AS b,
         unnest(range(len(pieces) - 1)) AS pos
  FROM fb0
), fx AS (
  SELECT vendor_id, l_orderkey, l_linenumber, CAST(pos AS BIGINT) AS pos,
         lower({Q.rx(_part(1), WS + '+', "'_'")}) AS parameter,
         CASE WHEN lower({_part(2)}) <> lower({Q.lit(fixed.NOT_FOUND)}) THEN {_part(2)} END AS value,
         {_part(3)} AS source_url
  FROM fb
)"""


def _facts(spark, sf_dir):
    return FX.facts(S.fact_answers(spark, sf_dir), "answer", _KEYS)


@query("facts", f"WITH {_FACTS_SQL} SELECT * FROM fx")
def facts(spark, sf_dir):
    """EXT-1 + EXT-2: reply-format answers parsed into (parameter, value, source URL) rows."""
    return _facts(spark, sf_dir)


@query("facts_known", f"""WITH {_FACTS_SQL}
SELECT parameter, count(*) AS n_facts, count(value) AS n_known FROM fx GROUP BY parameter""")
def facts_known(spark, sf_dir):
    """EXT-2: facts per parameter and how many carry a value (Not Found -> null)."""
    return _facts(spark, sf_dir).groupBy("parameter").agg(F.count("*").alias("n_facts"),
                                                          F.count("value").alias("n_known"))


_RANKED_SQL = f"""{_FACTS_SQL}, rk AS (
  SELECT *, {_rank_sql('parameter', 'source_url')} AS source_rank FROM fx WHERE value IS NOT NULL
)"""


@query("facts_by_priority", f"""WITH {_RANKED_SQL}
SELECT vendor_id, parameter, value, source_url, source_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY vendor_id, parameter
                               ORDER BY source_rank, l_orderkey, l_linenumber, pos, value) AS rn
  FROM rk) WHERE rn = 1""")
def facts_by_priority(spark, sf_dir):
    """EXT-3: per (vendor, parameter) the value from the highest-priority source."""
    return FX.resolve(_facts(spark, sf_dir), "vendor_id", ["l_orderkey", "l_linenumber", "pos"], "priority")


@query("facts_conflict_blank", f"""WITH {_FACTS_SQL}
SELECT vendor_id, parameter, CASE WHEN count(DISTINCT value) > 1 THEN '' ELSE min(value) END AS value
FROM fx WHERE value IS NOT NULL GROUP BY vendor_id, parameter""")
def facts_conflict_blank(spark, sf_dir):
    """EXT-4: per (vendor, parameter) the agreed value, "" when values conflict."""
    return FX.resolve(_facts(spark, sf_dir), "vendor_id", [], "blank")


_STRINGS = [f for f, k in C.output_fields() if k == "string"]
_LISTS = [f for f, k in C.output_fields() if k != "string"]


def _wide_sql() -> str:
    cols = []
    for f, kind in C.output_fields():
        if kind == "string":
            cols.append(f"coalesce(max(CASE WHEN parameter = {Q.lit(f)} THEN value END), '') AS {f}")
        else:
            cols.append(f"to_json(coalesce((SELECT list(item ORDER BY o) FROM un WHERE un.vendor_id = best.vendor_id "
                        f"AND un.parameter = {Q.lit(f)}), []::VARCHAR[])) AS {f}")
    return ", ".join(cols)


@query("profile_wide", f"""WITH {_RANKED_SQL}, best AS (
  SELECT vendor_id, parameter, value FROM (
    SELECT *, row_number() OVER (PARTITION BY vendor_id, parameter
                                 ORDER BY source_rank, l_orderkey, l_linenumber, pos, value) AS rn
    FROM rk) WHERE rn = 1
), it AS (
  SELECT vendor_id, parameter, trim(unnest(string_split(value, ','))) AS item, source_rank, l_orderkey, l_linenumber, pos,
         unnest(range(len(string_split(value, ',')))) AS place
  FROM rk WHERE parameter IN ({', '.join(Q.lit(f) for f in _LISTS)})
), un AS (
  SELECT vendor_id, parameter, item, min(row(source_rank, l_orderkey, l_linenumber, pos, place)) AS o
  FROM it WHERE item <> '' GROUP BY vendor_id, parameter, item
)
SELECT vendor_id, {_wide_sql()} FROM best
WHERE parameter IN ({', '.join(Q.lit(f) for f, _ in C.output_fields())}) GROUP BY vendor_id""")
def profile_wide(spark, sf_dir):
    """EXT-5/8/10: one 19-field record per vendor; list fields unite the items of all sources ("" / [] when absent)."""
    order = ["l_orderkey", "l_linenumber", "pos"]
    # The facts are read and ranked once, for the values and for the items of list fields.
    best = FX.resolve(_facts(spark, sf_dir), "vendor_id", order, "priority", items_of=FX.list_fields())
    wide = FX.profile_wide(best, "vendor_id")
    return wide.select("vendor_id", *[F.to_json(F.col(f)).alias(f) if f in _LISTS else F.col(f)
                                      for f, _ in C.output_fields()])


@query("rating_reviews", f"""WITH {_FACTS_SQL}
SELECT vendor_id, l_orderkey, l_linenumber,
  CASE WHEN parameter = 'rating' AND regexp_matches({Q.strip("coalesce(value, '')")}, '^[0-9]+([.][0-9]+)?$')
       THEN CAST({Q.strip('value')} AS DOUBLE) END AS rating_num,
  CASE WHEN parameter = 'review_count' AND regexp_matches({Q.strip("coalesce(value, '')")}, '^[0-9]+$')
       THEN TRY_CAST({Q.strip('value')} AS BIGINT) END AS review_count_num
FROM fx WHERE parameter IN ('rating', 'review_count')""")
def rating_reviews(spark, sf_dir):
    """EXT-9: numeric rating only when the stated value is a number; review counts when stated."""
    r = FX.rating_reviews(_facts(spark, sf_dir)).where(F.col("parameter").isin("rating", "review_count"))
    return r.select(*_KEYS, "rating_num", "review_count_num")


# The oracle's own patterns for what stands in the tables: sites end at white space; phones are international or plain.
_OWN_URL = "https?://[^ ]+"
_OWN_MAIL = "[a-z0-9]+(?:[.][a-z0-9]+)*@[a-z0-9]+(?:[.][a-z0-9]+)*[.][a-z]+"
_OWN_PHONE = "(?:^|[^0-9A-Za-z_+./-])([+][0-9] [(][0-9]{3}[)] [0-9]{3}-[0-9]{4}|[0-9]{10,11})(?:$|[^0-9A-Za-z_])"


@query("extract_urls", f"""WITH {_FA}, u AS (
  SELECT vendor_id, l_orderkey, l_linenumber, unnest(list_filter(string_split(answer, ' '), lambda w: starts_with(w, 'http'))) AS url,
         unnest(range(len(list_filter(string_split(answer, ' '), lambda w: starts_with(w, 'http'))))) AS pos,
         unnest(list_filter(list_transform(string_split(answer, ' '), lambda w, i: CASE WHEN starts_with(w, 'http') THEN
           CASE WHEN string_split(answer, ' ')[i - 2] = 'Source' AND string_split(answer, ' ')[i - 1] = 'URL:' THEN 'Source URL' ELSE '' END
           END), lambda x: x IS NOT NULL)) AS label
  FROM fa
)
SELECT vendor_id, l_orderkey, l_linenumber, CAST(pos AS BIGINT) AS pos, nullif(label, '') AS label, url FROM u""")
def extract_urls(spark, sf_dir):
    """EXT-6: every http/https URL in every fact answer, with position and label."""
    return FX.extract_urls(S.fact_answers(spark, sf_dir), "answer", _KEYS)


def _contacts_sql() -> str:
    """Contacts stated with the fixture's lines: (kind, value) lists by document id."""
    lists = ["[" + ", ".join(f"{{'kind': {Q.lit(k)}, 'value': {Q.lit(v)}}}" for k, v in found) + "]::STRUCT(kind VARCHAR, value VARCHAR)[]"
             for _, found in S.CONTACT_CASES]
    return f"CASE doc_id % {len(lists)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(lists)) + " END"


def _own_sql(kinds: str, pattern: str, group: int) -> str:
    return (f"list_concat(list_transform(regexp_extract_all(text, {Q.lit(pattern)}, {group}), lambda v: {{'kind': {Q.lit(kinds)}, 'value': v}}), "
            f"list_filter(stated, lambda c: c.kind = {Q.lit(kinds)}))")


@query("route_contacts", f"""WITH d AS (SELECT doc_id, text, {_contacts_sql()} AS stated FROM documents), c AS (
  SELECT doc_id, list_concat(list_concat(
    list_concat(list_transform(regexp_extract_all(text, {Q.lit(_OWN_URL)}, 0), lambda v: {{'kind': 'website', 'value': v}}),
                list_filter(stated, lambda c: c.kind NOT IN ('email', 'phone'))),
    {_own_sql('email', _OWN_MAIL, 0)}), {_own_sql('phone', _OWN_PHONE, 1)}) AS cs
  FROM d
)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, x.kind AS kind, x.value AS value FROM (
  SELECT doc_id, unnest(cs) AS x, unnest(range(len(cs))) AS pos FROM c)""")
def route_contacts(spark, sf_dir):
    """EXT-7: contact points (website / instagram / facebook URLs, emails, phones) in every document, each with a line of stated ones."""
    return FX.route_contacts(S.contact_texts(spark, sf_dir), "text", ["doc_id"])
