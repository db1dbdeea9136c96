"""URL filter: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed by full digests.

A rule is a host, a path and a verdict. It fits its host and all subdomains where the url's path starts with the rule's path.
A url is expanded into every pair of a suffix of its host (cut at dots) and a prefix of its path (cut behind
slashes); a rule is keyed by its host and by its path up to the last slash, so of a url's expressions one equals the key of
each rule that fits. The first 32 bits of the expressions' SHA-256 are joined; the whole digests and the rest of the
rule's path are compared afterwards.

What is expanded is bounded by the rules, not by the urls: no more labels than the longest rule host has, and no more
folders than the deepest rule path, are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendorscope.llm.common import saved

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORT = 8                       # hexadecimal digits of a digest that are joined
BROADCAST_BYTES = 32 << 20      # rules up to this size are sent to every executor; larger sets are joined by a shuffle
VERDICTS = ("allow", "block")


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; "" without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; "" without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def _times(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _counted(most: Column, fn) -> Column:
    """``fn`` of 1, 2, ... ``most``; nothing for 0."""
    none = F.array().cast("array<string>")
    return F.when(most > 0, F.transform(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), fn)).otherwise(none)


def host_suffixes(host: Column, most: int) -> Column:
    """The last one, two, ... ``most`` labels of a host (empty suffixes only of an empty host)."""
    n = F.least(_times(host, ".") + 1, F.lit(most))
    parts = _counted(n, lambda j: F.call_function("substring_index", host, F.lit("."), -j))
    return F.filter(parts, lambda s: (s != "") | (host == ""))


def path_prefixes(path: Column, most: int) -> Column:
    """The empty prefix and those that end behind the first, second, ... ``most``-th slash of a path."""
    n = F.least(_times(path, "/"), F.lit(most))
    parts = _counted(n, lambda k: F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/")))
    return F.concat(F.array(F.lit("")), parts)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), folder), 256)


def rule_keys(rules: DataFrame) -> DataFrame:
    """``rules`` (host, path, verdict) as distinct rows with ``short``, ``digest`` and their rank ``order``.

    Null hosts and paths count as empty; hosts are put in lower case. Rules whose verdict is neither ``allow`` nor ``block``
    raise an error when they are read. A rule with an empty host fits only urls without a host.
    """
    known = F.when(F.col("verdict").isin(*VERDICTS), F.col("verdict")).otherwise(
        F.raise_error(F.concat(F.lit("unknown verdict: "), F.coalesce("verdict", F.lit("null")))))
    r = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("rule_host"),
                     F.coalesce("path", F.lit("")).alias("rule_path"), known.alias("rule_verdict")).distinct()
    folder = F.regexp_extract("rule_path", "(?s)^(.*/)?", 0)
    r = r.withColumn("digest", _digest(F.col("rule_host"), folder))
    return r.withColumn("short", F.substring("digest", 1, SHORT)).withColumn(
        "order", F.struct((F.length("rule_host") + F.length("rule_path")).alias("chars"), F.length("rule_host").alias("host"),
                          (F.col("rule_verdict") == "block").alias("block")))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that decides) and ``verdict``.

    Of the rules that fit, the one with the most characters decides, then the one with the longer host; of a rule that is
    listed with both verdicts, ``block``. Where none fits, or the url is null or has no ``://``, the rule is null and the verdict
    ``default``. Repeated rows are all kept; columns of ``pages`` named like one of the four are replaced, all others stay as
    they are, whatever their names and types. Without rules everything gets ``default``; an empty table gives an empty one.

    Rows are numbered once, in a written table, so both sides of the last join agree after an executor is lost. Expressions carry
    only that number; a hot host meets the rules without a shuffle while these fit a broadcast (their size is measured), and in a
    skew-split join beyond that. The last join is on the row number, of which each has one row.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in names]
    of = F.col("`" + url.replace("`", "``") + "`")
    rows = saved(pages.select(F.monotonically_increasing_id().alias("_row"), F.struct(*quoted).alias("_in"),
                              host_of(of).alias("_host"), path_of(of).alias("_path")), "urls")
    keyed = rule_keys(rules)
    size = keyed.agg(F.max(_times(F.col("rule_host"), ".") + 1).alias("labels"), F.max(_times(F.col("rule_path"), "/")).alias("folders"),
                     F.sum(F.octet_length("rule_host") + F.octet_length("rule_path") + 200).alias("bytes")).first()
    pairs = F.flatten(F.transform(host_suffixes(F.col("_host"), size.labels or 1), lambda h: F.transform(
        path_prefixes(F.col("_path"), size.folders or 0), lambda p: F.struct(h.alias("h"), p.alias("p")))))
    told = rows.select("_row", "_path", F.explode(pairs).alias("e"))
    told = told.select("_row", "_path", _digest(F.col("e.h"), F.col("e.p")).alias("full"))
    told = told.withColumn("short", F.substring("full", 1, SHORT))
    small = (size.bytes or 0) <= BROADCAST_BYTES
    hits = told.join(F.broadcast(keyed) if small else keyed, "short").where(
        (F.col("full") == F.col("digest")) & F.startswith("_path", F.col("rule_path")))
    best = hits.groupBy("_row").agg(F.max(F.struct("order", "rule_host", "rule_path", "rule_verdict")).alias("_best"))
    out = rows.join(best, "_row", "left")
    return out.select(*[F.col("_in")[c].alias(c) for c in names], F.col("_host").alias("host"), F.col("_path").alias("path"),
                      F.concat("_best.rule_host", "_best.rule_path").alias("rule"),
                      F.coalesce("_best.rule_verdict", F.lit(default)).alias("verdict"))
