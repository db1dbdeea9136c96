"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorscope.sources.io import work_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared work folder and read back (cuts the lineage)."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by ``saved`` that no later step reads."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


OTHERS = "__others"


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def packed(docs: DataFrame, *named: str) -> DataFrame:
    """The ``named`` columns of ``docs`` (those it has) and one struct with all others, whatever their names and types."""
    own = [c for c in named if c in docs.columns]
    rest = [F.col("`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns if c not in own]
    # A struct has one field at least; a table that was packed before gets a second struct of a longer name.
    return docs.select(*own, F.struct(*rest, F.lit(True).alias(_free("_", docs.columns))).alias(_free(OTHERS, docs.columns)))


def unpacked(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """The original ``columns`` of a table made by ``packed``, then its columns ``more``."""
    box = max((c for c in df.columns if c.rstrip("_") == OTHERS), key=len)
    inside = df.schema[box].dataType.fieldNames()
    return df.select(*[F.col(box)[c].alias(c) if c in inside else F.col(c) for c in columns], *more)


def n_words(text):
    """Number of words (runs of anything but ASCII white space) as a column; null text: 0.

    White space becomes one blank, the ends are trimmed, and blanks are counted:
    two cheap scans instead of an array of all words.
    """
    flat = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    blanks = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.coalesce(F.when(flat == "", 0).otherwise(blanks + 1), F.lit(0)).cast("long")


def byte_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def rows(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a batch needs in memory stays small."""
    for b in batches:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size)
