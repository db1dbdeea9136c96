"""Page operators: HTML -> lines -> answer paragraph, usability and status.

All narrow: one page row in, one row out (``line_rows`` explodes within the
partition). Nothing here shuffles, so these scale with the number of
partitions of the page scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import dom as D
from vendorscope.functions import html as H
from vendorscope.functions import text as T


def page_to_answer(df: DataFrame, html: str = "html", question: str | None = None,
                   keep: tuple[str, ...] = ("page_id",), tables: bool = False) -> DataFrame:
    """HTM-8 + PRJ-15/17 + FLT-1 for every page.

    ``question`` names the column holding the question text; without one the
    page title is used. Output: keep..., n_lines, full_text, answer_only,
    tables (Markdown per table, HTM-11..13; only if asked for, as they are a parse of
    their own), answer (sanitised, falling back to the full text), meaningful.
    """
    from vendorscope.operators.tables import FIELDS, markdown, parse_tables
    asked = [F.col(question).alias("_question")] if question else []
    if tables:  # the tree gives the tables, and the lines with them
        read = fence(df.select(*keep, *asked, D.page_dom(F.col(html), *FIELDS).alias("_dom")))
        text = F.array_join(F.transform(F.filter("_dom.texts", lambda t: ~t["noise"]), lambda t: t["text"]), "\n")
        named = F.get(F.filter("_dom.nodes", lambda n: n["tag"] == "title"), 0)
        title = F.array_join(F.transform(D.texts_of(F.col("_dom.texts"), named), lambda t: t["text"]), " ")
        extra = [F.transform(parse_tables(F.col("_dom")), markdown).alias("tables")]
    else:
        read = fence(df.select(*keep, *asked, D.page_text(F.col(html)).alias("_page")))
        text, title, extra = F.col("_page.text"), F.col("_page.title"), []
    q = F.col("_question") if question else T.single_line(F.coalesce(title, F.lit("")))
    staged = read.select(*keep, H.text_lines(text).alias("_lines"), q.alias("_q"), *extra)
    return answered(staged, [*keep, "n_lines", "full_text", "answer_only", *(["tables"] if tables else []), "answer", "meaningful"])


def answered(staged: DataFrame, out: list[str]) -> DataFrame:
    """HTM-7 + PRJ-15/17 + FLT-1 on rows with ``_lines`` and the question ``_q``: the columns ``out`` of these and the row's own."""
    staged = H.with_answer_slice(staged, "_lines", "_q")
    own = [c for c in staged.columns if c not in ("_lines", "_q", "n_lines", "full_text", "answer_only", "answer", "meaningful")]
    staged = staged.select(*own, F.size("_lines").cast("bigint").alias("n_lines"), H.full_text(F.col("_lines")).alias("full_text"),
                           "answer_only")
    # answer_only is already single-line: when no removal applies, sanitising it is the identity.
    ao = F.col("answer_only")
    final = F.when((ao != "") & ~T.sanitize_may_change(ao), ao).otherwise(
        T.sanitize_answer(F.coalesce(F.nullif(ao, F.lit("")), F.col("full_text"))))
    staged = staged.withColumn("answer", final).withColumn("meaningful", T.is_meaningful(F.col("answer"), collapsed=True))
    return fence(staged.select(*out))


def fence(df: DataFrame) -> DataFrame:
    """Optimizer fence: re-emit each row through a one-element generator.

    Staged text columns reference earlier stages several times; a filter or
    join condition on them would otherwise be pushed below the projections by
    alias substitution, re-inlining (and re-evaluating) the whole HTML chain
    once per reference. Predicates on generator output stay above it, so each
    page is parsed exactly once.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def line_rows(df: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """HTM-4: one row per clean line with its 0-based position."""
    return df.select(key, F.posexplode(H.html_lines(F.col(html))).alias("pos", "line")) \
        .withColumn("pos", F.col("pos").cast("bigint"))


def region_min_len(df: DataFrame, html: str = "html", min_chars: int = fixed.REGION_MIN_CHARS) -> DataFrame:
    """FLT-2: keep regions whose stripped HTML is longer than ``min_chars``."""
    return df.where(F.length(T.strip_ws(F.col(html))) > min_chars)


def region_kinds(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """FLT-2 for both candidates in one pass: a row per page and kind (``region``: the whole page, ``body``) above its size floor."""
    body = F.regexp_extract(F.col(html), r"(?is)<body\b[^>]*>(.*)</body", 1)
    kinds = F.array_compact(F.array(F.when(F.length(T.strip_ws(F.col(html))) > fixed.REGION_MIN_CHARS, "region"),
                                    F.when(F.length(T.strip_ws(body)) > fixed.BODY_MIN_CHARS, "body")))
    return df.select(key, F.explode(kinds).alias("kind"))


# A div whose id is the block form's id (quoted or not).
BLOCK_FORM_RX = rf"""<div\b[^>]*\bid\s*=\s*["']?{fixed.BLOCK_FORM_ID}["'\s>/]"""


def is_blocked(html, text) -> "F.Column":
    """FLT-5: captcha form present or the block sentence in the page text."""
    form = F.col(html).rlike(BLOCK_FORM_RX)
    return form | F.coalesce(F.col(text), F.lit("")).contains(fixed.BLOCK_TEXT)
