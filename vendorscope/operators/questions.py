"""Vendor x search-group fan-out and research-question text (JOIN-1, PRJ-6..10).

The fan-out is a ``posexplode`` of the category's fixed group array: a
narrow map with output linear in the vendors (no join, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import text as T
from vendorscope.sources import catalogue as C


def vendor_groups(vendors: DataFrame, category: str = C.DEFAULT_CATEGORY) -> DataFrame:
    """JOIN-1: one row per (vendor, search group), groups in catalogue order."""
    g = vendors.select("*", F.posexplode(C.group_array(category)).alias("group_ord", "_g"))
    return g.select(*vendors.columns, F.col("group_ord").cast("bigint").alias("group_ord"),
                    F.col("_g.group_name").alias("group_name"), F.col("_g.description").alias("description"),
                    F.col("_g.fields").alias("fields"), F.col("_g.sources").alias("sources"),
                    F.col("_g.source_list").alias("source_list"))


def catalogue_groups(vendors: DataFrame) -> DataFrame:
    """JOIN-1 on data: one row per (vendor, search group of its own category); ``vendors`` come from ``with_catalogue``."""
    kept = [c for c in vendors.columns if c != "groups"]
    g = vendors.select(*kept, F.posexplode("groups").alias("group_ord", "_g"))
    return g.select(*kept, F.col("group_ord").cast("bigint").alias("group_ord"), "_g.*")


def build_questions(vg: DataFrame, category: str | Column = C.DEFAULT_CATEGORY,
                    name: str = "name", city: str = "city") -> DataFrame:
    """PRJ-9: the self-contained research question for each (vendor, group), one line; ``category``: one for all, or a column."""
    values = {
        "vendor_name": T.py_str(F.col(name)),
        "category": T.category_label(category if isinstance(category, Column) else F.lit(category)),
        "city": T.py_str(F.col(city)),
        "country": F.lit(fixed.QUESTION_COUNTRY),
        "description": F.coalesce(F.col("description"), F.lit("")),
        "parameters": T.param_bullets(F.col("fields")),
        "sources": F.col("sources"),
    }
    parts = [values[p[0]] if isinstance(p, tuple) else F.lit(p) for p in C.question_pieces()]
    return vg.withColumn("question", T.single_line(F.concat(*parts)))


def questions_of(rows: DataFrame, category: str = C.DEFAULT_CATEGORY) -> DataFrame:
    """PRJ-9 on rows that ``vendor_groups`` made and that kept ``group_ord`` only: the group is taken from the catalogue again."""
    of = F.get(C.group_array(category), F.col("group_ord").cast("int"))
    named = rows.withColumns({c: of[c] for c in ("description", "fields", "sources")})
    return build_questions(named, category).drop("description", "fields", "sources")
