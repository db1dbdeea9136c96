"""The whole run as one plan: vendors to profiles.

vendor -> groups of its category -> questions -> page snapshots -> region, answer, tables -> first usable answer -> combined text ->
prompt -> completion -> cleaned record. Every input is read once. Shuffles: the first usable answer per question (aggregated
on the map side), answers to questions, texts per vendor, completions to vendors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.operators import answers as A
from vendorscope.operators import enrich as EN
from vendorscope.operators import questions as QN
from vendorscope.operators import vendors as V


def attached_outcomes(vendors: DataFrame, snapshots: DataFrame, catalogue: DataFrame, key: str = "id",
                      deadline_s: int = fixed.ANSWER_DEADLINE_S) -> DataFrame:
    """Every question of every vendor with the outcome of its page, and the vendor's output ``model``.

    ``vendors``: key, name, city, state, category (one that the catalogue lacks fails the run); ``snapshots``: key, group_ord, question (as
    asked), asked_ts, ts, html, error.
    """
    asked = QN.build_questions(QN.catalogue_groups(V.with_catalogue(vendors, catalogue)), F.col("category"))
    asked = asked.select(key, "name", "city", "state", "category", "model", "group_ord", "group_name", "question")
    outcomes = A.page_outcomes(snapshots, [key, "group_ord"], asked="asked_ts", deadline_s=deadline_s)
    return A.attach_answers(asked, A.first_outcomes(outcomes, [key, "group_ord"]), [key, "group_ord"])


def vendor_profiles(vendors: DataFrame, snapshots: DataFrame, completions: DataFrame, catalogue: DataFrame, key: str = "id",
                    deadline_s: int = fixed.ANSWER_DEADLINE_S) -> DataFrame:
    """One row per vendor: its columns, combined_text, n_groups, n_failed, n_tables, prompt, prompt_sha, raw and the record of ``profile_record``.

    ``completions``: key, raw. A vendor without any answer, or without a completion, keeps its row (parse_status ``missing``).
    """
    groups = attached_outcomes(vendors, snapshots, catalogue, key, deadline_s)
    counts = (F.count("*").alias("n_groups"), F.count_if("failed").alias("n_failed"),
              F.sum(F.when(~F.col("failed"), F.size("tables")).otherwise(0)).cast("bigint").alias("n_tables"))
    texts = A.combine_text(groups, [key, "name", "city", "state", "category", "model"], also=counts)
    prompts = EN.build_prompts(texts, model=F.col("model"))
    return EN.profile_record(EN.attach_completions(prompts, completions, key))
