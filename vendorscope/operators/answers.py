"""Answer operators: attach answers to questions, per-vendor fan-in, first
usable snapshot, result envelopes and quarantine.

Shuffles: the answer join (on the question key; AQE picks broadcast or
sort-merge and splits skewed keys), the per-vendor fan-in (group size is
bounded by the catalogue's group count) and the per-question first-snapshot
aggregate (``min_by`` is partial-aggregated, so a hot question does not
land whole in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import dom as D
from vendorscope.functions import html as H
from vendorscope.functions import text as T
from vendorscope.operators import pages as P
from vendorscope.operators import tables as TB
from vendorscope.operators import tokens as TK


def region_answers(pages: DataFrame, keep: list[str], html: str = "html", question: str = "question") -> DataFrame:
    """HTM-5 + HTM-8 + PRJ-15/17 + FLT-1: region, lines, answer and tables of each page, from one reading of its markup.

    Output: keep..., selector_rank, region_html, tables (Markdown), answer, meaningful.
    """
    wanted = [c for c in dict.fromkeys([*keep, html, question])]
    d = TK.with_region(pages.select(*wanted), html, fields=TB.FIELDS)
    dom, region = F.col("dom"), F.col("region")
    text = F.array_join(F.transform(F.filter(D.texts_of(dom["texts"], region), lambda t: ~t["noise"]), lambda t: t["text"]), "\n")
    tables = F.when(region.isNotNull(), F.transform(TB.parse_tables(dom, region), TB.markdown))
    staged = d.select(*keep, "selector_rank", "region_html", H.text_lines(F.coalesce(text, F.lit(""))).alias("_lines"),
                      F.col(question).alias("_q"), F.coalesce(tables, F.array().cast("array<string>")).alias("tables"))
    return P.answered(staged, [*keep, "selector_rank", "region_html", "tables", "answer", "meaningful"])


# What is known of a fetched page, beside its keys.
OUTCOME = ("success", "answer", "tables", "raw_html", "page_html", "ts", "error")


def page_outcomes(pages: DataFrame, keep: list[str], html: str = "html", question: str = "question", asked: str | None = None,
                  deadline_s: int = fixed.ANSWER_DEADLINE_S) -> DataFrame:
    """PRJ-18: one outcome per fetched page (html, question, ts, error): keep... and the ``OUTCOME`` columns.

    With ``asked``, the column of the time of the question, a page seen after the deadline is no success. ``raw_html`` is a usable
    answer's region; ``page_html`` the whole page of any other, for quarantine.
    """
    own = [asked] if asked else []
    a = region_answers(pages, list(dict.fromkeys([*keep, html, "ts", "error", *own])), html, question)
    ok = F.col("meaningful") & F.col("selector_rank").isNotNull()
    if asked:
        ok = ok & (F.col("ts") <= F.col(asked) + F.expr(f"INTERVAL {int(deadline_s)} SECONDS"))
    return a.select(*keep, ok.alias("success"), F.when(ok, F.col("answer")).alias("answer"),
                    F.when(ok, F.col("tables")).otherwise(F.array().cast("array<string>")).alias("tables"),
                    F.when(ok, F.col("region_html")).alias("raw_html"), F.when(~ok, F.col(html)).alias("page_html"), "ts", "error")


def first_outcomes(outcomes: DataFrame, key: list[str]) -> DataFrame:
    """WIN-1 on outcomes: per question the first success, else the last failure seen.

    Both picks aggregate partially before the shuffle; of outcomes at the same time the one of the smallest (largest) hash counts.
    """
    parts = F.struct(*[F.col(c) for c in OUTCOME])
    order = F.struct("ts", F.xxhash64("answer", "page_html", "error"))
    first = F.min_by(parts, F.when(F.col("success"), order))
    last = F.max_by(parts, F.when(~F.col("success"), order))
    both = outcomes.groupBy(*key).agg(first.alias("_first"), last.alias("_last"))
    return both.select(*key, F.inline(F.array(F.coalesce("_first", "_last"))))


def attach_answers(questions: DataFrame, answers: DataFrame, on: list[str]) -> DataFrame:
    """JOIN-4 + PRJ-11: left join; ``answer_text`` is the answer when usable, else null, with ``failed`` and ``reason``.

    ``answers`` carries ``on`` keys, ``answer`` and ``success``, and may carry the other ``OUTCOME`` columns, which stay. A question
    without a row or with an unusable answer keeps its vendor. Reasons: ``no_input`` (nothing was fetched), ``error`` (fetching failed),
    ``no_response``.
    """
    has = [c for c in OUTCOME if c in answers.columns and c not in ("answer", "success")]
    a = answers.select(*on, F.col("answer").alias("_answer"), F.col("success").alias("_success"), *has, F.lit(True).alias("_fetched"))
    j = questions.join(a, on, "left")
    text = F.nullif(F.when(F.col("_success"), F.col("_answer")), F.lit(""))
    error = F.col("error").isNotNull() if "error" in has else F.lit(False)
    reason = (F.when(text.isNotNull(), F.lit(None).cast("string"))
              .when(F.col("_fetched").isNull(), F.lit("no_input")).when(error, F.lit("error"))
              .otherwise(F.lit("no_response")))
    return (j.withColumn("answer_text", text).withColumn("failed", text.isNull())
            .withColumn("reason", reason).drop("_answer", "_success", "_fetched"))


def failed_groups(df: DataFrame, key: str) -> DataFrame:
    """AGG-2: failed search groups per vendor."""
    return df.groupBy(key).agg(F.count_if(F.col("failed")).cast("bigint").alias("n_failed"),
                               F.count("*").alias("n_groups"))


def combine_text(df: DataFrame, key: str | list[str], order: str = "group_ord", group_name: str = "group_name",
                 text: str = "answer_text", also: tuple = ()) -> DataFrame:
    """AGG-1 + PRJ-12: per vendor, usable group blocks in group order, blank line between; ``also``: further aggregates.

    Failed groups are skipped; a vendor whose groups all failed gets ``""``.
    Group count per vendor is bounded by the catalogue, so the collected list is too.
    """
    block = F.when(F.col(text).isNotNull(),
                   F.struct(F.col(order).alias("o"), T.section_block(F.col(group_name), F.col(text)).alias("b")))
    keys = [key] if isinstance(key, str) else list(key)
    agg = df.groupBy(*keys).agg(F.array_sort(F.collect_list(block)).alias("_blocks"), *also)
    joined = F.array_join(F.transform("_blocks", lambda s: s["b"]), "\n\n")
    return agg.select(*keys, F.coalesce(joined, F.lit("")).alias("combined_text"), *agg.columns[len(keys) + 1:])


def first_meaningful(snapshots: DataFrame, key: str = "question_id", ts: str = "ts",
                     asked: str = "asked_ts", answer: str = "answer", tiebreak: str = "event_id",
                     deadline_s: int = fixed.ANSWER_DEADLINE_S) -> DataFrame:
    """WIN-1: first usable snapshot per question within the deadline, else ``no_response``.

    Output: key, status, ts, tiebreak, answer (null on failure).
    """
    limit = F.col(asked) + F.expr(f"INTERVAL {int(deadline_s)} SECONDS")
    usable = T.is_meaningful(F.col(answer)) & (F.col(ts) <= limit)
    # One partial-aggregated pass: rows that are not usable get a null ordering,
    # which min_by skips; a question with no usable row keeps a null result.
    order = F.when(usable, F.struct(F.col(ts), F.col(tiebreak)))
    pick = F.struct(F.col(ts).alias("ts"), F.col(tiebreak).alias("tb"), F.col(answer).alias("answer"))
    out = snapshots.groupBy(key).agg(F.min_by(pick, order).alias("_w"))
    status = F.when(F.col("_w").isNull(), F.lit("no_response")).otherwise(F.lit("success"))
    return out.select(key, status.alias("status"), F.col("_w.ts").alias(ts), F.col("_w.tb").alias(tiebreak),
                      F.col("_w.answer").alias(answer))


def envelope(df: DataFrame, question: str = "question") -> DataFrame:
    """PRJ-18: attached answers as results of one shape: the row's other columns, then question, answer, tables, raw_html, success,
    timestamp, error, format.

    What a failure lacks is null (tables: empty); its error is its own, or the text of its reason. ``SET-1`` unions envelopes
    of different runs.
    """
    made = ("question", "answer", "tables", "raw_html", "success", "timestamp", "error", "format")
    used = ("answer_text", "failed", "reason", "page_html", "ts")
    ok = ~F.col("failed")
    have = lambda c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind)
    said = (F.when(F.col("reason") == "no_input", F.lit(fixed.NO_INPUT_TEXT)).when(F.col("reason") == "error", have("error", "string"))
            .otherwise(F.lit(fixed.FAILURE_TEXT)))
    return df.select(
        *[c for c in df.columns if c not in made and c not in used], F.col(question).alias("question"), F.when(ok, F.col("answer_text")).alias("answer"),
        F.coalesce(F.when(ok, have("tables", "array<string>")), F.array().cast("array<string>")).alias("tables"),
        F.when(ok, have("raw_html", "string")).alias("raw_html"), ok.alias("success"),
        F.when(ok, have("ts", "timestamp_ntz")).alias("timestamp"), F.when(~ok, said).alias("error"), F.when(ok, F.lit("text")).alias("format"))


def union_results(dfs: list[DataFrame]) -> DataFrame:
    """SET-1: bag union by column name; shapes may differ (missing columns -> null)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
