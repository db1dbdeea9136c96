"""HTML tables -> cell rows and Markdown (HTM-11..13, HTM-16/17, FLT-4, AGG-4).

A page's tables are read from its element tree, inside its row, as
``array<array<array<string>>>`` (table -> row -> cell): the rows of a table are the ``tr`` elements
in its slice of the numbered elements, the cells of a row the ``th`` and ``td`` in the row's slice, a cell's text
its slice of the texts. Filtering, padding to the widest row and Markdown rendering never shuffle. The long cell form is an
explode of that array when a consumer wants rows.

A row or cell of a table inside a table counts in both, as a search among descendants finds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorscope.functions import dom as D
from vendorscope.functions import text as T

# What the tables need of an element.
FIELDS = ("i", "tag", "noise", "r0", "r1", "d0", "d1", "t0", "t1")


def cell_text(texts: Column) -> Column:
    """Text nodes of a cell, stripped, joined by one space, then PRJ-16 cleaning."""
    parts = F.transform(F.filter(texts, lambda t: ~t["noise"]), lambda t: T.strip_ws(t["text"]))
    return T.clean_cell(F.array_join(F.filter(parts, lambda x: x != ""), " "))


def parse_tables(dom: Column, region: Column | None = None) -> Column:
    """HTM-11 + FLT-4 + HTM-12 on a page's tree: tables (of ``region`` only, if given) as arrays of non-empty rows of cell texts.

    Tables left without rows are dropped; the first cell of the header row
    becomes ``Feature`` when it starts with "feature" (any case).
    """
    texts = dom["texts"]
    of = lambda *tags: F.filter(dom["nodes"], lambda n: n["tag"].isin(*tags) & ~n["noise"])
    every_row, every_cell = of("tr"), of("td", "th")
    # Numbered among all rows and cells of the page, those within an element are a slice: nothing is searched per table.
    cells = lambda r: F.transform(F.slice(every_cell, r["d0"] + 1, r["d1"] - r["d0"]), lambda c: cell_text(D.texts_of(texts, c)))
    rows = lambda t: F.filter(F.transform(F.slice(every_row, t["r0"] + 1, t["r1"] - t["r0"]), cells),
                              lambda row: F.exists(row, lambda c: c != ""))
    here = lambda t: F.lit(True) if region is None else F.coalesce(D.contains(region, t), F.lit(False))
    found = F.transform(F.filter(of("table"), lambda t: (t["r1"] > t["r0"]) & here(t)), rows)
    return F.transform(F.filter(found, lambda t: F.size(t) > 0), _header_rule)


def _header_rule(t: Column) -> Column:
    head = F.element_at(t, 1)
    first = F.element_at(head, 1)
    fixed_head = F.when(F.lower(first).startswith("feature"),
                        F.concat(F.array(F.lit("Feature")), F.slice(head, 2, F.size(head) - 1))).otherwise(head)
    return F.concat(F.array(fixed_head), F.slice(t, 2, F.size(t) - 1))


def markdown(t: Column) -> Column:
    """HTM-13 + AGG-4: pad rows to the widest with "" and render as a Markdown table."""
    w = F.array_max(F.transform(t, lambda r: F.size(r)))

    def line(r):
        padded = F.concat(r, F.array_repeat(F.lit(""), w - F.size(r)))
        return F.concat(F.lit("| "), F.array_join(padded, " | "), F.lit(" |"))

    sep = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), w), " | "), F.lit(" |"))
    body = F.transform(F.slice(t, 2, F.size(t) - 1), line)
    return F.array_join(F.concat(F.array(line(F.element_at(t, 1)), sep), body), "\n")


def page_tables(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, table_idx (0-based), table (rows of cells): one row per table of every page."""
    d = D.with_dom(df.select(key, html), html, FIELDS)
    return d.select(key, F.posexplode(parse_tables(F.col("dom"))).alias("table_idx", "table"))


def table_cells(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Long form D8: key, table_idx, row_idx, col_idx, cell (0-based positions)."""
    r = page_tables(df, key, html).select(key, "table_idx", F.posexplode("table").alias("row_idx", "_r"))
    c = r.select(key, "table_idx", "row_idx", F.posexplode("_r").alias("col_idx", "cell"))
    return c.select(key, *[F.col(x).cast("bigint").alias(x) for x in ("table_idx", "row_idx", "col_idx")], "cell")


def tables_markdown(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One Markdown string per table: key, table_no (1-based, HTM-17), n_cols, markdown."""
    t = page_tables(df, key, html)
    return t.select(key, (F.col("table_idx") + 1).cast("bigint").alias("table_no"),
                    F.array_max(F.transform("table", lambda r: F.size(r))).cast("bigint").alias("n_cols"),
                    markdown(F.col("table")).alias("markdown"))


def markdown_rows(df: DataFrame, key: str = "page_id", table_no: str = "table_no",
                  md: str = "markdown") -> DataFrame:
    """HTM-16: Markdown table -> (row_idx, col_idx, header, cell) rows.

    Blank lines dropped; at least two lines needed; line 1 is the header,
    line 2 (separator) skipped; cells split on pipes and stripped.
    """
    lines = F.filter(F.transform(F.split(F.col(md), T.LINE_BREAK), lambda x: T.strip_ws(x)), lambda x: x != "")

    def cells(line):
        inner = F.regexp_replace(line, r"^\|+|\|+$", "")
        return F.transform(F.split(inner, r"\|"), lambda c: T.strip_ws(c))

    staged = df.select(key, table_no, lines.alias("_l")).where(F.size("_l") >= 2)
    staged = staged.select(key, table_no, cells(F.element_at("_l", 1)).alias("_h"),
                           F.transform(F.slice("_l", 3, F.greatest(F.size("_l") - 2, F.lit(0))), cells).alias("_rows"))
    r = staged.select(key, table_no, "_h", F.posexplode("_rows").alias("row_idx", "_r"))
    c = r.select(key, table_no, "row_idx", "_h", F.posexplode("_r").alias("col_idx", "cell"))
    return c.select(key, table_no, F.col("row_idx").cast("bigint").alias("row_idx"),
                    F.col("col_idx").cast("bigint").alias("col_idx"),
                    F.try_element_at(F.col("_h"), (F.col("col_idx") + 1).cast("int")).alias("header"), "cell")
