"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope.llm.common import dropped, saved


def _star(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over pairs (u, v), u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (columns u, v); root is the smallest node reachable.

    Both sides of a star step shuffle on the centre; a centre with very many
    edges is split by the adaptive skew join, and minima are combined before
    the shuffle. Each round is written to the work folder, so a lost
    executor repeats one round at most. It ends when a round changes no edge.
    """
    def marked(df: DataFrame) -> tuple[DataFrame, tuple]:
        out = saved(df, "edges")
        return out, out.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now, mark = marked(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                       .where("u <> v").distinct())
    for _ in range(max_rounds):
        (now, seen), old = marked(_star(now)), now
        dropped(old)
        if seen == mark:  # the same edges as before: every node points at its root
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
