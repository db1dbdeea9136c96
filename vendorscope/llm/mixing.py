"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source has the same expected number of copies, its source's target over
its size. Within a source the documents are put in order of size, then of a
hash of the id; the expected copies are summed along that order, one offset per source is
added, and a document is emitted once per integer that its stretch of the sum
crosses. The order by size spreads the draws over all sizes, so the words
taken come near the target.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendorscope.llm.common import n_words, packed, saved, unpacked

BLOCK = 4096       # documents of one source and size that are numbered together
SEED = "mix-1"


def _unit(text):
    """A number in [0, 2**32) from a text column: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=(1.0, 2.0, 3.0), most: float = 3.0, total: float = 1.0) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: shares by weight, none above ``most`` times its source's size.

    Sources are ordered by code point, null last, and take the weights in turn. The
    shares add up to ``total`` times all sizes. Water filling in closed form: in order of size over weight,
    a source is held at its limit as long as its fair part of what is left is
    above the limit; all later ones share the rest by weight. One row per source is numbered in one
    task: sources are counted, never documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    w = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    w = w.withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("limit") / F.col("weight"))
    every = Window.partitionBy(F.lit(0))
    w = (w.withColumn("all", F.sum("source_size").over(every) * F.lit(float(total)))
         .withColumn("held", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
         .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("level", (F.col("all") - F.col("held")) / (F.sum("weight").over(every) - F.col("gone"))))
    # The first source that is below its limit at its level fixes the level of all that follow.
    free = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", F.col("source").isNull(), "source", "level")))
    w = w.withColumn("free", free.over(every)["level"])
    return w.select("source", "source_size",
                    F.least("limit", F.coalesce(F.col("weight") * F.col("free"), F.col("limit"))).alias("target"))


def with_copies(docs: DataFrame, weights=(1.0, 2.0, 3.0), most: float = 3.0, total: float = 1.0,
                seed: str = SEED, columns: list[str] | None = None) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target`` and ``copies``; columns of these names are replaced.

    Null and wordless texts have size 0, null sources are one source (the last), null
    ids are numbered like any value. A source without words has target 0 and no copies. No document is
    emitted more than ``most`` times, rounded up. Runs agree: the order depends on size and id only;
    rows equal in both are interchangeable (same size, same id), so which of them is emitted
    more often is not defined. An empty table gives an empty one.

    A source may hold any share of the rows: documents are counted per (source, size,
    block of the hash) before anything is ordered, blocks hold about ``BLOCK`` rows,
    and only within a block are rows numbered. Sizes are counted once, and the rows written with them;
    ``columns`` names the columns of ``docs`` to return (default: all), so that texts needn't be.
    """
    own = [c for c in columns or docs.columns if c not in ("size", "source_size", "target", "copies")]
    quoted = [F.col("`" + c.replace("`", "``") + "`").alias(c) for c in own]
    # Null-safe text keys; a null source can't be mistaken for a text.
    key = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source")))
    number = _unit(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    base = saved(docs.select(F.struct(*quoted).alias("__own"), n_words(F.col("text")).alias("size"), key.alias("__key"), number.alias("__hash"),
                             F.col("source").alias("__source"), F.col("doc_id").alias("__id"),
                             F.monotonically_increasing_id().alias("__row")), "sized")
    light = base.select("__key", F.col("__source").alias("source"), "size", "__hash", "__id", "__row")
    groups = light.groupBy("__key", "size").agg(F.count("*").alias("n"), F.first("source").alias("source"))
    sizes = groups.groupBy("__key").agg(F.first("source").alias("source"),
                                        F.sum(F.col("n") * F.col("size")).alias("source_size"))
    aim = targets(sizes.select("source", "source_size"), weights, most, total)
    aim = aim.withColumn("__key", key).drop("source")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK))
    known = groups.select("__key", "size", blocks.alias("__blocks"))
    block = F.floor(F.col("__hash") * F.col("__blocks") / F.lit(2 ** 32)).cast("long")
    dealt = light.drop("source").join(known, ["__key", "size"]).withColumn("__block", block)
    counts = dealt.groupBy("__key", "size", "__block").agg(F.count("*").alias("n"))
    # One row per (source, size, block): far fewer than documents, in order within each source.
    before = Window.partitionBy("__key").orderBy("size", "__block").rowsBetween(Window.unboundedPreceding, -1)
    first = (counts.withColumn("__first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
             .join(known, ["__key", "size"]).join(aim, "__key"))
    numbered = dealt.drop("__blocks").join(first.drop("__blocks"), ["__key", "size", "__block"])
    rank = F.row_number().over(Window.partitionBy("__key", "size", "__block").orderBy("__hash", "__id")).cast("long")
    place = F.col("__first") + rank
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.concat(F.lit(seed + "/"), F.col("__key"))) / F.lit(float(2 ** 32))
    # No more than ``most``, where the sum's rounding falls on an integer.
    crossed = F.least(F.floor(place * rate + offset) - F.floor((place - 1) * rate + offset), F.lit(math.ceil(most)))
    taken = numbered.select("__row", "source_size", "target", crossed.cast("long").alias("copies"))
    # Rows are numbered without their texts, which are shuffled once, for this join.
    return base.join(taken, "__row").select(*[F.col("__own")[c].alias(c) for c in own], "size", "source_size", "target", "copies")


def repeated_rows(docs: DataFrame, weights=(1.0, 2.0, 3.0), most: float = 3.0, total: float = 1.0) -> DataFrame:
    """The mix: every document of ``docs`` as many times as it is taken, with its own columns, whatever their names and types.

    Nulls, empty texts, repeated rows and empty tables as in ``with_copies``.
    """
    mixed = with_copies(packed(docs, "doc_id", "text", "source"), weights, most, total).where("copies > 0")
    return unpacked(mixed.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs.columns)


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source,
         CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}' || coalesce(doc_id::VARCHAR, '-')), 1, 8))::BIGINT AS h
  FROM documents),
s AS (
  SELECT k, any_value(source) AS source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY any_value(source) ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM d GROUP BY k),
r AS (
  SELECT *, source_size * 3.0::DOUBLE AS lim, source_size * 3.0::DOUBLE / w AS ratio FROM s),
l AS (
  SELECT a.k, a.ratio,
         ((SELECT sum(source_size) FROM s)::DOUBLE
          - (SELECT coalesce(sum(b.lim), 0.0::DOUBLE) FROM r b WHERE b.ratio < a.ratio))
         / ((SELECT sum(w) FROM s) - (SELECT coalesce(sum(b.w), 0.0::DOUBLE) FROM r b WHERE b.ratio < a.ratio)) AS level
  FROM r a),
f AS (SELECT min_by(level, ratio) AS free FROM l WHERE ratio > level),
t AS (SELECT r.k, r.source_size, least(r.lim, coalesce(r.w * f.free, r.lim)) AS target FROM r, f),
n AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('{SEED}/' || d.k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u,
         row_number() OVER (PARTITION BY d.k ORDER BY d.size, d.h, d.doc_id) AS p
  FROM d JOIN t USING (k))
SELECT doc_id, size, source_size, target,
       size * least(floor(p * rate + u) - floor((p - 1) * rate + u), 3)::BIGINT AS taken
FROM n
"""
