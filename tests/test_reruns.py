"""Saved text files, resumable enrichment, observed metrics and the streaming plan."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vendorscope.operators import enrich as EN
from vendorscope.sources import io as IO

TEXT = "category string, city string, slug string, combined_text string"
ROWS = [("WEDDING_PLANNERS", "New Delhi", "a_b", "one\n\n    two"), ("WEDDING_PLANNERS", "Pune+", "007", ""), ("CATERERS", "Goa %41=x", "c", "é\n"),
        ("WEDDING_PLANNERS", "São Paulo", "d", "x" * 100000)]


def test_texts_written_as_files_read_back_equal(spark, tmp_path):
    path = IO.write_text_files(spark.createDataFrame(ROWS, TEXT), str(tmp_path / "texts"))
    assert sorted(tuple(r) for r in IO.read_text_files(spark, path).collect()) == sorted(ROWS)
    assert sorted(tuple(r) for r in IO.read_text_files(spark, path, "CATERERS").collect()) == [ROWS[2]]


def test_plain_files_of_another_tool(spark, tmp_path):
    for category, city, slug, text in ROWS:
        folder = tmp_path / "data" / category / city
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{slug}.txt").write_text(text if not text.endswith("\n") else text + "\n", encoding="utf-8")
    got = IO.read_text_files(spark, str(tmp_path / "data"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(r for r in ROWS if r[3])  # files without a byte are skipped
    one = IO.read_text_files(spark, str(tmp_path / "data"), "CATERERS")
    assert [r.city for r in one.collect()] == ["Goa %41=x"] and all("CATERERS" in f for f in one.inputFiles())


def test_missing_text_fails_the_run(spark):
    texts = spark.createDataFrame(ROWS[:2], TEXT)
    v = spark.createDataFrame([(1, *ROWS[0][:3]), (2, *ROWS[1][:3])], "id long, category string, city string, slug string")
    assert {r.id: r.combined_text for r in IO.attach_texts(v, texts).collect()} == {1: ROWS[0][3], 2: ""}
    more = v.unionByName(spark.createDataFrame([(3, "CATERERS", "Goa", "zz")], v.schema))
    with pytest.raises(Exception, match="No saved text: CATERERS/Goa/zz"):
        IO.attach_texts(more, texts).collect()


def test_second_run_asks_nothing_and_failures_are_rows(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def fn(prompts: pd.Series) -> pd.Series:
        import os
        import uuid
        os.makedirs(calls, exist_ok=True)
        with open(f"{calls}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(prompts))
        if (prompts == "bad").any():
            raise RuntimeError("model down")
        return prompts.map(lambda p: "{}" if p != "none" else None)

    def asked():
        import os
        return [p for n in (os.listdir(calls) if os.path.exists(calls) else []) for p in open(f"{calls}/{n}").read().split("\n")]

    store = str(tmp_path / "store")
    some = spark.createDataFrame([("a",), ("b",), ("a",)], "prompt string")
    every = spark.createDataFrame([("a",), ("b",), ("c",), ("bad",), ("none",), ("c",)], "prompt string")
    assert EN.enrich_into(some, fn, store, waves=3).count() == 2 and sorted(asked()) == ["a", "b"]
    got = {(r.raw, r.error) for r in EN.enrich_into(every, fn, store, waves=3).collect()}
    assert got == {("{}", None), (None, "RuntimeError: model down"), (None, None)}
    n = len(asked())
    again = EN.enrich_into(every, fn, store, waves=3)
    assert again.count() == 5 and len(asked()) == n
    assert EN.enrich_into(some, fn, store).count() == 2 and len(asked()) == n
    up = EN.enrich_into(every, lambda p: p, store, retry_failed=True)
    assert up.where(F.col("error").isNotNull()).count() == 0 and up.count() == 5


def test_observed_metrics_equal_the_aggregate(spark, tmp_path):
    rows = spark.createDataFrame([("p1", "r"), ("p22", None), ("", "xyz")], "prompt string, raw string")
    out, seen = EN.observed(rows)
    out.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"n_vendors": 3, "n_completed": 2, "prompt_chars": 5, "result_chars": 4}
    out, seen = EN.observed(rows.limit(0))
    out.write.parquet(str(tmp_path / "none"))
    assert seen.get == {"n_vendors": 0, "n_completed": 0, "prompt_chars": 0, "result_chars": 0}


def test_deadline_stream_keeps_its_state_in_the_jvm(spark, tmp_path):
    from vendorscope.streaming.first_meaningful import stream_first_meaningful
    schema = "question_id long, event_id long, ts timestamp_ntz, asked_ts timestamp_ntz, answer string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "src"))
    stream = stream_first_meaningful(spark.readStream.schema(schema).parquet(str(tmp_path / "src")))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Pandas" not in plan and "min_by" in plan
