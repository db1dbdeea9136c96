"""What larger tables need: narrow inputs are dealt, long texts made late, Python holds few rows at once, files without folders of their own."""

import os

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vendorscope.functions import dom as D
from vendorscope.functions import text as T
from vendorscope.operators import enrich as EN
from vendorscope.operators import facts as FX
from vendorscope.plans.catalog import all_queries
from vendorscope.sources import io as IO
from vendorscope.sources import tables as S


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_file_per_text_and_no_folder_of_its_own(spark, tmp_path):
    texts = spark.range(40).selectExpr("'C' AS category", "concat('t', id % 2) AS city", "concat('s', id) AS slug", "repeat('x', id) AS combined_text")
    path = IO.write_text_files(texts, str(tmp_path / "texts"))
    walked = list(os.walk(path))
    assert sum(len(files) for _, _, files in walked) == 40 and len(walked) == 4  # top, category, two cities
    assert sorted(tuple(r) for r in IO.read_text_files(spark, path).collect()) == sorted(tuple(r) for r in texts.collect())


def _texts(top, names, text="some text"):
    for n in names:
        (top / n).parent.mkdir(parents=True, exist_ok=True)
        (top / n).write_bytes(text if isinstance(text, bytes) else f"{text}\n".encode())
    return str(top)


def test_tasks_list_the_text_files(spark, tmp_path):
    path = _texts(tmp_path / "é 50%25 texts", [f"C/t{i % 3}/s{i}.txt" for i in range(40)])
    got = [IO.read_text_files(spark, path, "C"), IO.read_text_files(spark, path)]
    _texts(tmp_path / "é 50%25 texts", ["C/t9/late.txt"])  # nothing was listed yet
    assert [len({tuple(r) for r in df.collect()}) for df in got] == [41, 41] and not any(df.inputFiles() for df in got)


def test_short_names_do_not_make_long_texts_broadcast(spark, tmp_path):
    path = _texts(tmp_path / "texts", ["C/t/s.txt"])
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    try:
        joined = IO.attach_texts(S.vendors(spark, SF_SMALL).select("id", "category", "city", F.col("name").alias("slug")), IO.read_text_files(spark, path))
        plan = joined._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "SortMergeJoin" in plan  # the vendors' own joins broadcast nations and regions


def test_text_files_in_and_beside_the_wanted_folders(spark, tmp_path, monkeypatch):
    path = _texts(tmp_path / "texts", ["C/t/s.txt", "category=C/city=u%2Fv/slug=x.txt", "category=C/city=t/slug=y/part-0.txt"])
    _texts(tmp_path / "texts", ["C/t/.h.txt", "C/t/_h.txt", "C/_tmp/h.txt", "C/.tmp/h.txt", "C/t/other.csv", "D/t/not_utf8.txt"], b"\xff")
    _texts(tmp_path / "texts", ["C/t/empty.txt"], b"")
    os.symlink("nowhere", tmp_path / "texts" / "C" / "t" / "gone.txt")
    want = [("C", "t", "s"), ("C", "t", "y"), ("C", "u/v", "x")]
    assert sorted(tuple(r)[:3] for r in IO.read_text_files(spark, path, "C").collect()) == want
    there, disk = f"{path}/C", pafs.LocalFileSystem()
    assert {f"{there}/{at}" for at, _ in IO._files(pafs.SubTreeFileSystem(there, disk), "")} == {at for at, _ in IO._files(disk, there)}
    for name, n in (("s.txt", 1), ("_h.txt", 0), ("other.csv", 0)):
        assert [tuple(r)[:3] for r in IO.read_text_files(spark, f"{path}/C/t/{name}").collect()] == want[:n]
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        IO.read_text_files(spark, path, "E")
    monkeypatch.setattr(IO, "_places", lambda spark, base: None)  # as where only Spark can open the files
    os.unlink(tmp_path / "texts" / "C" / "t" / "gone.txt")
    assert sorted(tuple(r)[:3] for r in IO.read_text_files(spark, path, "C").collect()) == want


def test_licence_model_learns_from_every_document(spark):
    from vendorscope.llm import licenses as L

    # More lines than the sample of before held, all but a few of which say the same; only these few hold the words below.
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3000 == 7, F.lit(
        "released under the library")).otherwise(F.lit("nothing said")).alias("text"))
    seen = []
    keep = L.saved
    try:
        L.saved = lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1]
        L.train(docs)
    finally:
        L.saved = keep
    made = dict(seen)
    assert made["licence-lines"].agg(F.sum("n")).first()[0] == 9000
    assert made["licence-others"].agg(F.sum("n")).first()[0] == 3


def test_slug_of_other_letters_and_signs(spark):
    rows = [("Ünïcode & Co. 12", "n_code_co_12"), ("__a__😀b  ", "a_b"), ("-.-", ""), (None, None)]
    df = spark.createDataFrame(rows, "s string, slug string")
    assert [r[0] for r in df.select(T.slug(F.col("s")).alias("x")).collect()] == [r[1] for r in rows]
    assert "[^a-zA-Z0-9]" not in _plan(df.select(T.slug(F.col("s"))))


@pytest.mark.parametrize("name", ["answer_envelope", "quarantine_pages"])
def test_questions_are_made_behind_the_join(spark, name, monkeypatch):
    seen = []
    monkeypatch.setattr(IO, "write_partitioned", lambda df, path, by: seen.append(df))
    monkeypatch.setattr(IO, "read_partitioned", lambda spark, path: seen[0])
    plan = _plan(all_queries()[name].build(spark, SF_SMALL))
    assert "You are researching" in plan and "You are researching" not in plan[plan.index("Join LeftOuter"):]


@pytest.mark.parametrize("kept", [False, True])
def test_prompts_are_handed_over_in_small_parts(spark, tmp_path, kept):
    def fn(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: str(len(prompts)))

    prompts = spark.range(0, 1000, 1, 1).select(F.concat(F.lit("p"), "id").alias("prompt"))
    done = EN.enrich_into(prompts, fn, str(tmp_path / "store"), waves=1) if kept else EN.enrich_with(prompts, fn)
    sizes = [int(r.raw) for r in done.collect()]
    assert len(sizes) == 1000 and max(sizes) <= EN.CALL_ROWS


def test_few_pages_are_objects_at_once():
    pages = pa.array(["x" * 100_000] * 10 + [None, "y", "z" * 1_000_000, ""])
    runs = list(D._few(iter([pages, pa.array([], pa.string())])))
    assert [p for r in runs for p in r.to_pylist()] == pages.to_pylist()
    assert max(sum(len(p or "") for p in r.to_pylist()) for r in runs if len(r) > 1) <= D.READ_BYTES and len(runs) > 4


@pytest.mark.parametrize("source", [S.table_pages, S.fact_answers, S.vendors])
def test_narrow_inputs_are_dealt_on_a_cluster(spark, source):
    tasks = spark.conf.get(S.TEXT_TASKS)
    spark.conf.unset(S.TEXT_TASKS)
    try:
        df = source(spark, SF_SMALL)
        assert df.rdd.getNumPartitions() >= S.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set(S.TEXT_TASKS, tasks)


def test_facts_are_cut_at_the_first_marks(spark):
    text = ("intro Value: no Parameter: A b Value: x Value: y Source URL: u Source URL: w\nParameter: none here Source URL: q "
            "Parameter:Value: Parameter: c Value: Not Found Source URL:")
    got = FX.facts(spark.createDataFrame([(1, text)], "k int, t string"), "t", ["k"]).orderBy("pos").collect()
    assert [tuple(r)[2:] for r in got] == [("a_b", "x Value: y", "u Source URL: w"), (None, None, None), (None, None, None), ("c", None, None)]


def test_wide_profile_reads_the_facts_once(spark):
    plan = _plan(all_queries()["profile_wide"].build(spark, SF_SMALL))
    assert plan.count("l_linenumber") and plan.count("Relation [") == 1


def test_wide_profile_of_facts_without_a_key(spark):
    rows = [(None, 1, "services_offered", "a", "https://a.in"), (None, 2, "phone", "9", "https://a.in"), (1, 3, "phone", "8", None)]
    fx = spark.createDataFrame(rows, "v int, pos int, parameter string, value string, source_url string")
    best = FX.resolve(fx, "v", ["pos"], items_of=FX.list_fields())
    got = {r.v: r for r in FX.profile_wide(best, "v").collect()}
    assert got[None].phone == "" and got[None].services_offered == [] and got[1].phone == "8" and len(got) == 2
