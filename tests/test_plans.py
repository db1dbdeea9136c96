"""Scale guards on the physical plans, and stream = batch."""

import re

import pytest

from tests.conftest import SF_SMALL
from vendorscope.plans.catalog import all_queries

PYTHON_ALLOWED = {"enrich_with", "enrich_resumed"}
PYTHON_NODES = ("BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
# The one Python step of page queries: the Arrow pass that reads a page's markup (functions/dom.py).
PAGE_PASSES = {"dom", "text", "tokens", "clean", "decode"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in all_queries() if not n.startswith("stream_")))
def test_no_cartesian_no_python(spark, name):
    plan = _plan(all_queries()[name].build(spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    if name not in PYTHON_ALLOWED:
        assert not any(n in plan for n in PYTHON_NODES), name
        assert set(re.findall(r"ArrowEvalPython \[(\w+)\(", plan)) <= PAGE_PASSES, name


def test_scan_is_pruned(spark):
    plan = _plan(all_queries()["src_pages"].build(spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in plan


def test_fact_scan_reads_four_columns(spark):
    df = all_queries()["facts_by_priority"].build(spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in text and "l_extendedprice" not in text


def test_page_plan_is_compact(spark):
    # Filters on derived answer columns must not re-inline the HTML chain.
    from pyspark.sql import functions as F
    df = all_queries()["page_to_answer"].build(spark, SF_SMALL).where(F.col("meaningful"))
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_stream_equals_batch(spark):
    q = all_queries()
    s = sorted(tuple(r) for r in q["stream_first_meaningful"].build(spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in q["first_meaningful"].build(spark, SF_SMALL).select(
        "question_id", "status", "ts", "event_id", "answer").collect())
    assert s == b


def test_vendor_stream_equals_batch(spark):
    q = all_queries()
    s = sorted(tuple(r) for r in q["stream_vendor_pipeline"].build(spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in q["build_prompt"].build(spark, SF_SMALL).collect())
    assert s == b


def test_late_snapshot_within_watermark(spark, tmp_path):
    """Out-of-order snapshots inside the watermark delay give the batch answer."""
    import datetime as dt
    import time
    from vendorscope.operators.answers import first_meaningful
    from vendorscope.streaming.first_meaningful import stream_first_meaningful
    t0 = dt.datetime(2024, 1, 1)
    good = "a" * 90
    schema = "question_id long, event_id long, ts timestamp_ntz, asked_ts timestamp_ntz, answer string"
    arrivals = [
        [(1, 3, t0 + dt.timedelta(seconds=50), t0, good), (1, 1, t0, t0, "loading")],
        [(1, 2, t0 + dt.timedelta(seconds=20), t0, good),          # earlier usable snapshot arrives later
         (2, 4, t0 + dt.timedelta(seconds=90), t0, good)],         # after its 70 s deadline
        [(-1, -1, t0 + dt.timedelta(days=30), t0 + dt.timedelta(days=30), "")],   # end of input
    ]
    src = str(tmp_path / "src")
    for rows in arrivals:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = (stream_first_meaningful(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.question_id: (r.status, r.event_id) for r in spark.read.parquet(out).collect() if r.question_id >= 0}
    allrows = spark.createDataFrame([r for a in arrivals[:2] for r in a], schema)
    batch = {r.question_id: (r.status, r.event_id) for r in first_meaningful(allrows).collect()}
    assert batch == {1: ("success", 2), 2: ("no_response", None)}
    assert got == batch


@pytest.mark.parametrize("name,fn", [("facts_by_priority", "partial_min_by"), ("first_meaningful", "partial_min_by"),
                                     ("last_write_wins", "partial_max("), ("facts_conflict_blank", "partial_min")])
def test_hot_keys_aggregate_map_side(spark, name, fn):
    """A key holding a large share of rows is combined before the shuffle (partial aggregation)."""
    plan = _plan(all_queries()[name].build(spark, SF_SMALL))
    assert fn in plan, name


def test_overview_pipeline_has_no_joins(spark):
    from pyspark.sql import functions as F
    from vendorscope.operators import tokens as TK
    from vendorscope.sources import tables as S
    # Pages straight from the scan (the overview fixture itself joins question and answer turns).
    pg = S.pages(spark, SF_SMALL).select("page_id", F.concat(F.lit("AI Overview "), "html").alias("html"))
    plan = _plan(TK.overview_blocks(pg))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and "ShuffledHashJoin" not in plan


def test_partitioned_write_rebalances(spark):
    from pyspark.sql import functions as F
    df = spark.range(10).withColumn("reason", F.lit("a"))
    plan = df.hint("rebalance", "reason")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_stream_emit_first_in_order(spark, tmp_path):
    """Early answers equal the batch result when snapshots arrive in event order."""
    import datetime as dt
    import time
    from vendorscope.operators.answers import first_meaningful
    from vendorscope.streaming.first_meaningful import stream_first_meaningful
    t0 = dt.datetime(2024, 1, 1)
    good = "b" * 90
    schema = "question_id long, event_id long, ts timestamp_ntz, asked_ts timestamp_ntz, answer string"
    arrivals = [
        [(1, 1, t0, t0, "loading"), (2, 5, t0, t0, "loading")],
        [(1, 2, t0 + dt.timedelta(seconds=20), t0, good)],
        [(1, 3, t0 + dt.timedelta(seconds=30), t0, good), (2, 6, t0 + dt.timedelta(seconds=80), t0, good)],
        [(-1, -1, t0 + dt.timedelta(days=30), t0 + dt.timedelta(days=30), "")],
    ]
    src = str(tmp_path / "src")
    for rows in arrivals:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = (stream_first_meaningful(stream, emit="first").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.question_id, r.status, r.event_id) for r in spark.read.parquet(out).collect() if r.question_id >= 0)
    allrows = spark.createDataFrame([r for a in arrivals[:3] for r in a], schema)
    batch = sorted((r.question_id, r.status, r.event_id) for r in first_meaningful(allrows).collect())
    assert batch == [(1, "success", 2), (2, "no_response", None)]
    assert got == batch
