"""Table queries on table pages (HTML tables of each part): HTM-11..13, HTM-16/17, FLT-4, AGG-4."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorscope.operators import tables as TB
from vendorscope.plans import sqlfrag as Q
from vendorscope.plans.catalog import query
from vendorscope.sources import tables as S

def _filled_sql(text: str) -> str:
    """A fixture's text with {brand} and {type} filled in, as SQL."""
    for name in ("brand", "type"):
        text = f"' || p_{name} || '".join(text.split("{" + name + "}"))
    return f"'{text}'"


def _case_sql(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


_TB = f"tb AS (SELECT p_partkey AS page_id, {_case_sql('p_partkey', [_filled_sql(html) for html, _ in S.TABLE_CASES])} AS html FROM part)"


def _expected_sql(tables: list) -> str:
    """What a fixture's tables read as, stated with the fixture."""
    return "[" + ", ".join("[" + ", ".join("[" + ", ".join(_filled_sql(c) for c in row) + "]" for row in t) + "]" for t in tables) + "]"


# The oracle's own patterns, for pages whose tables are closed throughout.
_TABLE_RX = r"(?is)<table\b[^>]*>(.*?)</table\s*>"
_ROW_RX = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
_CELL_RX = r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]\s*>"


def _cell_sql(c: str) -> str:
    return Q.clean_cell(f"array_to_string({Q.lines(c)}, ' ')")


def tables_sql(html: str) -> str:
    """Tables of an HTML column as a list of non-empty row lists (empty rows and tables dropped)."""
    return (f"list_filter(list_transform(regexp_extract_all({Q.denoise(html)}, {Q.lit(_TABLE_RX)}, 1), "
            f"lambda t: list_filter(list_transform(regexp_extract_all(t, {Q.lit(_ROW_RX)}, 1), "
            f"lambda r: list_transform(regexp_extract_all(r, {Q.lit(_CELL_RX)}, 1), "
            f"lambda c: {_cell_sql('c')})), lambda row: len(list_filter(row, lambda x: x <> '')) > 0)), "
            f"lambda t: len(t) > 0)")


def header_rule_sql(tabs: str) -> str:
    """First header cell starting with "feature" (any case) becomes "Feature"."""
    return (f"list_transform({tabs}, lambda t: CASE WHEN starts_with(lower(t[1][1]), 'feature') "
            f"THEN list_concat([list_concat(['Feature'], list_slice(t[1], 2, len(t[1])))], list_slice(t, 2, len(t))) "
            f"ELSE t END)")


def markdown_sql(t: str) -> str:
    """Markdown text of one parsed table (rows padded to the widest)."""
    w = f"list_max(list_transform({t}, lambda r: len(r)))"
    line = (lambda r: f"'| ' || array_to_string(list_concat({r}, list_transform(range({w} - len({r})), "
                      f"lambda i: '')), ' | ') || ' |'")
    sep = f"'| ' || array_to_string(list_transform(range({w}), lambda i: '---'), ' | ') || ' |'"
    return (f"array_to_string(list_concat([{line(f'{t}[1]')}, {sep}], "
            f"list_transform(list_slice({t}, 2, len({t})), lambda r: {line('r')})), chr(10))")


_PARSED = f"""ph AS (
  SELECT p_partkey AS page_id, {_case_sql('p_partkey', [_expected_sql(tables) for _, tables in S.TABLE_CASES])} AS tabs FROM part
), t1 AS (
  SELECT page_id, unnest(tabs) AS t, unnest(range(len(tabs))) AS table_idx FROM ph
)"""


@query("html_tables", f"""WITH {_PARSED}, r1 AS (
  SELECT page_id, table_idx, unnest(t) AS r, unnest(range(len(t))) AS row_idx FROM t1
)
SELECT page_id, CAST(table_idx AS BIGINT) AS table_idx, CAST(row_idx AS BIGINT) AS row_idx,
       CAST(col_idx AS BIGINT) AS col_idx, cell
FROM (SELECT page_id, table_idx, row_idx, unnest(r) AS cell, unnest(range(len(r))) AS col_idx FROM r1)""")
def html_tables(spark, sf_dir):
    """HTM-11 + FLT-4 + HTM-12: every table cell of every page (empty rows dropped, header rule)."""
    return TB.table_cells(S.table_pages(spark, sf_dir))


_MD = f"""{_PARSED}, w1 AS (
  SELECT page_id, table_idx, t, list_max(list_transform(t, lambda r: len(r))) AS w FROM t1
), md AS (
  SELECT page_id, CAST(table_idx + 1 AS BIGINT) AS table_no, CAST(w AS BIGINT) AS n_cols,
    array_to_string(list_concat(
      ['| ' || array_to_string(list_concat(t[1], list_transform(range(w - len(t[1])), lambda i: '')), ' | ') || ' |',
       '| ' || array_to_string(list_transform(range(w), lambda i: '---'), ' | ') || ' |'],
      list_transform(list_slice(t, 2, len(t)),
        lambda r: '| ' || array_to_string(list_concat(r, list_transform(range(w - len(r)), lambda i: '')), ' | ') || ' |')
    ), chr(10)) AS markdown
  FROM w1
)"""


@query("table_markdown", f"WITH {_MD} SELECT page_id, table_no, n_cols, markdown FROM md")
def table_markdown(spark, sf_dir):
    """HTM-13 + AGG-4 + HTM-17: each table padded to its widest row, rendered as Markdown, numbered from 1."""
    return TB.tables_markdown(S.table_pages(spark, sf_dir))


@query("table_header", f"""WITH {_PARSED}
SELECT page_id, CAST(table_idx AS BIGINT) AS table_idx, array_to_string(t[1], '|') AS header FROM t1""")
def table_header(spark, sf_dir):
    """HTM-12: header row of every table after the Feature rule."""
    t = TB.page_tables(S.table_pages(spark, sf_dir))
    return t.select("page_id", F.col("table_idx").cast("bigint").alias("table_idx"),
                    F.array_join(F.element_at("table", 1), "|").alias("header"))


@query("table_index", f"""WITH {_PARSED}
SELECT page_id, CAST(table_idx + 1 AS BIGINT) AS table_no, CAST(len(t) AS BIGINT) AS n_rows FROM t1""")
def table_index(spark, sf_dir):
    """HTM-17: tables numbered from 1 in document order, with their row counts."""
    t = TB.page_tables(S.table_pages(spark, sf_dir))
    return t.select("page_id", (F.col("table_idx") + 1).cast("bigint").alias("table_no"), F.size("table").cast("bigint").alias("n_rows"))


def _cells_sql(line: str) -> str:
    return f"list_transform(string_split({Q.rx(line, '^[|]+|[|]+$')}, '|'), lambda c: {Q.strip('c')})"


@query("markdown_rows", f"""WITH {_MD}, ml AS (
  SELECT page_id, table_no, list_filter(list_transform(string_split(markdown, chr(10)), lambda x: {Q.strip('x')}),
                                        lambda x: x <> '') AS l FROM md
), mh AS (
  SELECT page_id, table_no, {_cells_sql('l[1]')} AS h, list_transform(list_slice(l, 3, len(l)), lambda x: {_cells_sql('x')}) AS rows
  FROM ml WHERE len(l) >= 2
), mr AS (
  SELECT page_id, table_no, h, unnest(rows) AS r, unnest(range(len(rows))) AS row_idx FROM mh
)
SELECT page_id, table_no, CAST(row_idx AS BIGINT) AS row_idx, CAST(col_idx AS BIGINT) AS col_idx,
       h[col_idx + 1] AS header, cell
FROM (SELECT page_id, table_no, row_idx, h, unnest(r) AS cell, unnest(range(len(r))) AS col_idx FROM mr)""")
def markdown_rows(spark, sf_dir):
    """HTM-16: rendered Markdown tables parsed back into (row, column, header, cell) rows."""
    md = TB.tables_markdown(S.table_pages(spark, sf_dir))
    return TB.markdown_rows(md)


@query("clean_cell", f"""WITH {_TB}, c AS (
  SELECT page_id, unnest(regexp_extract_all(html, {Q.lit(_CELL_RX)}, 1)) AS raw,
         unnest(range(len(regexp_extract_all(html, {Q.lit(_CELL_RX)}, 1)))) AS pos FROM tb
)
SELECT page_id, CAST(pos AS BIGINT) AS pos, {Q.clean_cell('raw')} AS cell FROM c""")
def clean_cell(spark, sf_dir):
    """PRJ-16: every raw cell text collapsed, with trailing "IBM/Quora/TechTarget +N" junk dropped."""
    from vendorscope.functions.text import clean_cell as cc
    t = S.table_pages(spark, sf_dir).select("page_id", F.posexplode(
        F.regexp_extract_all(F.col("html"), F.lit(_CELL_RX), 1)).alias("pos", "raw"))
    return t.select("page_id", F.col("pos").cast("bigint").alias("pos"), cc(F.col("raw")).alias("cell"))
