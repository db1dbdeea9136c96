"""Readers and writers (SRC-1..3, SNK-1..5).

Outputs are partitioned by column (``category``, ``city``, ``reason``)
instead of one file per vendor; a rebalance on the partition columns keeps
files per folder few while splitting hot folders, and dynamic partition
overwrite replaces only the folders a run touches.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from vendorscope.session import checkpoint_dir
from vendorscope.sources.tables import TASKS_A_CORE, TEXT_TASKS

RAW_VENDOR_SCHEMA = Ty.StructType([
    Ty.StructField("id", Ty.StringType()),
    Ty.StructField("name", Ty.StringType()),
    Ty.StructField("city_name", Ty.StringType()),
    Ty.StructField("state_name", Ty.StringType()),
])


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/vendorscope-work/{name}-{uuid.uuid4().hex[:12]}"


def read_raw_vendors(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """SRC-1: raw vendor export; every field read as a string (numbers keep their text)."""
    return spark.read.schema(RAW_VENDOR_SCHEMA).option("multiLine", multiline).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """SNK-1/SNK-4: JSON lines, UTF-8, non-ASCII kept."""
    df.write.mode(mode).option("encoding", "UTF-8").option("ignoreNullFields", "false").json(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet",
                      mode: str = "overwrite") -> str:
    """SNK-2/SNK-3: one folder per partition value.

    The REBALANCE hint clusters rows by the partition columns (few files per
    folder) while AQE splits a folder holding a large share of the rows over
    several writers, so a hot city or reason does not land in one task.
    """
    (df.hint("rebalance", *by).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(fmt).save(path))
    return path


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-3: partitioned read; filters on partition columns prune folders."""
    return spark.read.format(fmt).load(path)


TEXT_COLUMNS = ["category", "city", "slug"]


# The signs that Spark escapes in the names of a table's folders, and its name for a missing value.
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def _named(column: str, value: str | None) -> str:
    return f"{column}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value) if value else _NO_NAME}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark reads it by, so tasks do not take a plain path for one of their own disk's."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(p).toString()


def write_text_files(texts: DataFrame, path: str, text: str = "combined_text") -> str:
    """SNK-2 as files: one text file per (category, city, slug), for tools that read single files; tables are for everything else.

    The files are ``category=<category>/city=<city>/slug=<slug>.txt``, each written by the task that holds its row; a folder per file, or a
    commit that moves files one by one, would take a multiple of the time. A task that runs again writes the same files.
    """
    fs, top = pafs.FileSystem.from_uri(qualified(texts.sparkSession, path))
    fs.create_dir(top, recursive=True)
    uri = qualified(texts.sparkSession, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = pafs.FileSystem.from_uri(uri)
        made: set[str] = set()
        for b in batches:
            for *names, value in zip(*(b.column(i) for i in range(4))):
                category, city, slug = (_named(c, n.as_py()) for c, n in zip(TEXT_COLUMNS, names))
                folder = f"{top.rstrip('/')}/{category}/{city}"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(f"{folder}/{slug}.txt") as out:
                    out.write((value.as_py() or "").encode() + b"\n")
        yield from ()

    rows = texts.select(*[F.col(c).cast("string").alias(c) for c in TEXT_COLUMNS], F.col(text).alias("value"))
    rows.mapInArrow(write, "done int").write.format("noop").mode("overwrite").save()
    return path


def _taken(name: str, is_folder: bool) -> bool:
    """Text files and folders, but for those that Spark's readers skip."""
    return (is_folder or name.endswith(".txt")) and not (name.startswith(".") or name.startswith("_") and "=" not in name)


def _children(fs: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """What stands right in ``folder``: its text files (path, False) and folders (path, True).

    On a disk, shared ones too, the names come one by one; other file systems give a folder's names at once.
    """
    if isinstance(fs, pafs.LocalFileSystem):
        with os.scandir(folder) as there:
            for x in there:
                if (x.is_dir() or x.is_file()) and _taken(x.name, x.is_dir()):
                    yield x.path, x.is_dir()
    else:
        for x in fs.get_file_info(pafs.FileSelector(folder)):
            is_folder = x.type == pafs.FileType.Directory
            if x.type != pafs.FileType.NotFound and _taken(x.base_name, is_folder):
                yield x.path, is_folder


def _files(fs: pafs.FileSystem, folder: str) -> Iterator[tuple[str, bool]]:
    """The text files anywhere below ``folder``."""
    for at, is_folder in _children(fs, folder):
        if is_folder:
            yield from _files(fs, at)
        else:
            yield at, False


def _places(spark: SparkSession, base: str) -> list[tuple[str, str, bool]] | None:
    """What the pattern ``base`` stands for: URI, path, and whether it is a folder; None if Python does not see it there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(base)
    found = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(p)
    if not found:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {base}.")
    uris = [x.getPath().toUri().toASCIIString() for x in found]
    try:
        seen = [fs.get_file_info(at) for fs, at in map(pafs.FileSystem.from_uri, uris)]
    except (pa.ArrowException, OSError):
        return None
    if any(x.type == pafs.FileType.NotFound for x in seen):
        return None
    return [(uri, x.path, x.type == pafs.FileType.Directory) for uri, x in zip(uris, seen)]


def _found_files(spark: SparkSession, base: str, levels: int) -> DataFrame:
    """The text files below ``base``, each read whole: content, path. Tasks list the folders; the driver holds no file's name.

    The first ``levels`` levels are listed one after the other and what they hold is dealt to all tasks, each of which lists what is below;
    then the names of the files are dealt. All of it is one RDD, the size of which the planner does not know: that of a shuffled table of
    names would stand for the texts, which are longer, and have them broadcast.
    """
    places = _places(spark, base)
    if places is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(base)
        return files.select("content", "path")
    uri = places[0][0]

    def listing(list_folder):
        def listed(found: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, bool]]:
            fs, _ = pafs.FileSystem.from_uri(uri)
            for at, is_folder in found:
                if is_folder:
                    yield from list_folder(fs, at)
                elif _taken(os.path.basename(at), False):
                    yield at, False
        return listed

    def read(found: Iterator[tuple[str, bool]]) -> Iterator[tuple[bytes, str]]:
        fs, _ = pafs.FileSystem.from_uri(uri)
        for at, _ in found:
            with fs.open_input_stream(at) as f:
                content = f.read()
            if content:
                yield content, at

    tasks = int(spark.conf.get(TEXT_TASKS, None) or TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    found = spark.sparkContext.parallelize([(at, is_folder) for _, at, is_folder in places], 1)
    for list_folder in [_children] * levels + [_files]:
        found = found.mapPartitions(listing(list_folder)).partitionBy(tasks, lambda at: zlib.crc32(at.encode()))
    return spark.createDataFrame(found.mapPartitions(read), "content binary, path string", verifySchema=False)


def read_text_files(spark: SparkSession, path: str, category: str | None = None, text: str = "combined_text") -> DataFrame:
    """SRC-3: saved text files, each read whole: category, city, slug, text, taken from ``<category>/<city>/<slug>.txt``.

    Also reads what ``write_text_files`` wrote (folders named ``category=..``). With ``category`` only its folder is listed and read.
    A final line break is not part of the text; a file without any byte counts as missing. Tasks list the folders when the frame is first
    run. Where Python cannot open the file system, Spark's reader lists them on the driver, which then holds the names of all files.
    """
    base = path.rstrip("/") + (f"/{{{category},category={category}}}" if category else "")
    files = _found_files(spark, base, levels=1 if category else 2)  # down to the cities
    files = files.select(F.decode("content", "UTF-8").alias("_text"), F.col("path").alias("_at"))
    name = r"/(?:category=)?([^/]+)/(?:city=)?([^/]+)/(?:slug=)?([^/]+?)(?:/part-[^/]*)?(?:\.txt)?$"

    def part(i: int, column: str) -> Column:
        """One of the three names; a table's folders escape theirs like URLs, where a plus sign stands for itself."""
        plain = F.regexp_extract("_at", name, i)
        escaped = F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
        return F.when(F.col("_at").contains(f"/{column}="), escaped).otherwise(plain)

    return files.select(*[part(i, c).alias(c) for i, c in enumerate(TEXT_COLUMNS, start=1)],
                        F.regexp_replace("_text", r"\n\z", "").alias(text))


def attach_texts(vendors: DataFrame, texts: DataFrame, text: str = "combined_text") -> DataFrame:
    """JOIN-5: ``vendors`` (category, city, slug, ...) with their saved text; reading a vendor without one fails the run, in the plan."""
    t = texts.select(*[F.col(c).alias(f"_{c}") for c in TEXT_COLUMNS], F.col(text).alias("_text"), F.lit(True).alias("_there"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in TEXT_COLUMNS]
    missing = F.raise_error(F.concat(F.lit("No saved text: "), F.concat_ws("/", *TEXT_COLUMNS))).cast("string")
    j = vendors.drop(text).join(t, on, "left")
    return j.select(*[c for c in vendors.columns if c != text], F.when(F.col("_there"), F.col("_text")).otherwise(missing).alias(text))


def quarantine(df: DataFrame, reason_col: str = "reason") -> DataFrame:
    """SNK-5 shape: failed rows with their capped slug and reason."""
    from vendorscope.functions.text import slug
    from vendorscope.operators.pages import fence
    # The slug names its text more than once: a question that is made in the same plan is made once, behind a fence.
    return fence(df).withColumn("slug", slug(F.col("question"), cap=80, fallback="ai_mode")) \
        .select("slug", "question", reason_col, *[c for c in df.columns if c not in ("question", reason_col)])
