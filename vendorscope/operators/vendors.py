"""Vendor operators: normalise the raw export, keys, categories, output paths.

Narrow projections except ``last_write_wins`` / ``collisions`` (one
partial-aggregated shuffle on the output path) and the category checks
(broadcast of the fixed catalogue).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import text as T


def normalize_vendors(raw: DataFrame, ordinal: str) -> DataFrame:
    """PRJ-1/2: rename city_name/state_name, conditional integer id, surrogate key.

    ``ordinal`` names the column giving input order: it is part of the key, so it must not
    depend on how the input is split.
    """
    ord_col = F.col(ordinal).cast("bigint")
    out = raw.select(
        ord_col.alias("input_ord"),
        F.col("id").cast("string").alias("id_raw"),
        T.id_cast(F.col("id").cast("string")).alias("id"),
        F.col("name"), F.col("city_name").alias("city"), F.col("state_name").alias("state"))
    key = F.xxhash64("id_raw", "name", "city", "state", "input_ord")
    return out.withColumn("vendor_key", key)


def with_slug(df: DataFrame, name: str = "name", out: str = "slug") -> DataFrame:
    """PRJ-4: output file slug of the vendor name."""
    return df.withColumn(out, T.slug(F.col(name)))


def last_write_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """WIN-3: one row per output path, the latest by ``order``.

    Rows equal in ``order`` are told apart by their other columns, and a null order comes
    first, so the result is one and the same in every run. The maximum aggregates partially on the map side: a path
    shared by a third of all rows still moves one row per partition through the shuffle.
    """
    cols = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in cols])
    winner = df.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("o"), packed.alias("r"))).alias("_w"))
    return winner.select(*keys, *[F.col("_w.r")[c].alias(c) for c in cols])


def collisions(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """WIN-3 report: output paths written more than once, with the write count and winner."""
    return (df.groupBy(*keys)
            .agg(F.count("*").alias("n_writes"), F.max(order).alias("winner_ord"))
            .where(F.col("n_writes") > 1))


def unknown_categories(vendors: DataFrame, category: str = "category") -> DataFrame:
    """FLT-7 / JOIN-2 anti: categories absent from the catalogue, with vendor counts."""
    known = F.array(*[F.lit(c) for c in fixed.SEARCH_MODELS])
    return (vendors.where(~F.array_contains(known, F.col(category)) | F.col(category).isNull())
            .groupBy(category).agg(F.count("*").alias("n_vendors")))


def with_catalogue(vendors: DataFrame, catalogue: DataFrame, category: str = "category") -> DataFrame:
    """JOIN-2 + JOIN-3 + FLT-7: each vendor with the ``groups`` and the output ``model`` of its own category.

    A vendor of a category that the catalogue lacks fails the run: the guard stands in the plan, where the groups are read, so
    nothing is collected or scanned beforehand. The catalogue's size is checked where it is made (``sources.catalogue``).
    """
    c = catalogue.select(F.col("category").alias("_category"), F.col("groups").alias("_groups"), F.col("model").alias("model"))
    j = vendors.drop("groups", "model").join(F.broadcast(c), F.col(category) == F.col("_category"), "left")
    unknown = F.raise_error(F.concat(F.lit("Unknown category: "), F.coalesce(F.col(category), F.lit("None"))))
    groups = F.when(F.col("_category").isNotNull(), F.col("_groups")).otherwise(unknown.cast(catalogue.schema["groups"].dataType))
    return j.withColumn("groups", groups).drop("_category", "_groups")


def require_known_category(vendors: DataFrame, category: str = "category") -> DataFrame:
    """FLT-7: ``vendors``; reading one of a category that the catalogue lacks fails the run."""
    known = F.array_contains(F.array(*[F.lit(c) for c in fixed.SEARCH_MODELS]), F.col(category))
    unknown = F.raise_error(F.concat(F.lit("Unknown category: "), F.coalesce(F.col(category), F.lit("None"))))
    return vendors.withColumn(category, F.when(known, F.col(category)).otherwise(unknown.cast("string")))


def with_category(vendors: DataFrame, category: str = "category") -> DataFrame:
    """JOIN-2: attach the number of search groups of the vendor's category (0 = unknown)."""
    sizes = F.create_map(*[x for cat, groups in fixed.SEARCH_MODELS.items()
                           for x in (F.lit(cat), F.lit(len(groups)))])
    n = F.coalesce(F.element_at(sizes, F.col(category)), F.lit(0))
    return vendors.withColumn("known", n > 0).withColumn("n_groups", n.cast("bigint"))
