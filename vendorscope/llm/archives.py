"""Pages to WARC archives with identical payloads stored once, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorscope.llm.warc import WarcSource
from vendorscope.sources.io import qualified


def page_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """One WARC record per row of ``pages`` (page_id, url, html).

    The payload is the HTML in UTF-8 (null: empty). Of records with equal payloads of at least
    ``least`` bytes that with the largest ``page_id`` is a response and the others
    revisit it; rows that repeat the largest id are all responses, and so are all if no row has an id.
    Smaller payloads are always responses. Payloads are equal if SHA-1 and length
    are. Null ids come before all others. Other columns are not read.

    Groups of equal payloads are reduced to one row each before they are shuffled, groups of one row
    aren't joined back, and the join splits hot digests.
    """
    base = pages.select("page_id", F.col("url").alias("target_uri"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    base = (base.withColumn("payload_length", F.octet_length("payload").cast("long"))
            .withColumn("sha1", F.sha1("payload")))
    large = F.col("payload_length") >= least
    groups = (base.where(large).groupBy("sha1", "payload_length")
              .agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1").drop("n"))
    joined = base.join(groups, ["sha1", "payload_length"], "left")
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    return joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit("2000-01-01T00:00:00Z").alias("date"), F.concat(F.lit("sha1:"), "sha1").alias("payload_digest"),
        F.when(again, urn(F.col("original"))).alias("refers_to"),
        F.lit(None).cast("long").alias("content_length"), "payload_length",
        F.when(~again, F.col("payload")).alias("payload"))


def write_archive(records: DataFrame, path: str) -> str:
    """Records as WARC archives in a folder that driver and executors share."""
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format("warc").mode("append").option("path", qualified(records.sparkSession, path)).save()
    return path


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives; the session must hand filters to Python data sources, so that is switched on."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("path", qualified(spark, path)).option("payload", str(payload).lower()).load()


def page_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per archived page: id, full payload's length and digest, record type, and the page it revisits.

    Responses are measured on the payload that was read. Revisits have length and digest
    in their header; the filter on the type keeps their blocks undecoded.
    """
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    full = (read_archive(spark, path).where("record_type = 'response'")
            .select(number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                    F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to")))
    short = (read_archive(spark, path, payload=False).where("record_type = 'revisit'")
             .select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
                     F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
                     number("refers_to").alias("refers_to")))
    return full.unionByName(short)
