"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vendorscope.llm.common import saved, table
from vendorscope.llm.langid import accepted
from vendorscope.llm.mixing import repeated_rows
from vendorscope.llm.packing import digests, pack
from vendorscope.llm.queries import tokenizer_path
from vendorscope.llm.simhash import first_of_each
from vendorscope.llm.substrings import without_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language that makes up half of them or more.

    Null, empty and letterless texts go; copies are judged alike; extra columns stay with their row; an empty table stays empty.
    """
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (4-word shingles, 4 bits): the smallest id, null ids last.

    Groups are of rows, so rows that share an id but not a text all stay, and copies without an id leave one. Null and empty texts are
    copies of each other. Extra columns stay with their row; an empty table stays empty.
    """
    return first_of_each(docs, words=4, max_bits=4)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that repeated 35-word windows cover.

    Null and short texts stay as they are; of repeated rows every copy loses what is repeated. Extra columns stay with their row.
    """
    return without_repeats(docs, window=35)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Null sources are one source, null and empty texts have size 0 and may be taken any number of times up to 3; repeated rows are documents
    of their own. Extra columns are repeated with their row.
    """
    return repeated_rows(docs, weights=(1.0, 2.0, 3.0), most=3.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences with the CRC-32 of their ids.

    Null and empty texts are the closing id alone; repeated rows are documents of their own; extra columns are not read.
    """
    pieces = pack(docs, tokenizer_path("word_bpe_49k.json"), length=2048, end=1)
    return digests(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("substrings", substrings),
          ("mixing", mixing), ("packing", packing)]

# Fingerprints (XXH64), trained models and tokenizers have no SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
