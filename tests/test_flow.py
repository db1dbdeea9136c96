"""The end-to-end run on hand-written vendors and pages."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.operators import answers as A
from vendorscope.operators import flow as FL
from vendorscope.operators import questions as QN
from vendorscope.operators import vendors as V
from vendorscope.sources import catalogue as C

MODELS = {"CATERERS": [("menu", "Menus", ["cuisine", "price"])],
          "PHOTO_STUDIOS": [("contact", "Contacts", ["phone"]), ("work", "Portfolio", ["styles"])]}
OUTPUTS = {"CATERERS": [("cuisine", "array"), ("sources", "array")]}
T0 = dt.datetime(2024, 1, 1)
GOOD = "This vendor answers every question at length, with prices, places and names of people in full."


def page(question, answer, extra=""):
    return (f"<html><body><div id='nav'>menu</div><div id='main'><p>You said:</p><p>{question}</p><p>{answer}</p>{extra}</div>"
            "<footer>imprint</footer></body></html>")


def vendors(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, city string, state string, category string")


def shots(spark, rows):
    return spark.createDataFrame(rows, "id long, group_ord long, question string, asked_ts timestamp_ntz, ts timestamp_ntz, html string, error string")


def test_each_vendor_runs_its_own_category(spark):
    cat = C.catalogue(spark, MODELS, OUTPUTS)
    v = V.with_catalogue(vendors(spark, [(1, "A", "Pune", "MH", "CATERERS"), (2, "B", "Goa", "GA", "PHOTO_STUDIOS")]), cat)
    got = sorted((r.id, r.group_ord, r.group_name, r.fields) for r in QN.catalogue_groups(v).collect())
    assert got == [(1, 0, "menu", ["cuisine", "price"]), (2, 0, "contact", ["phone"]), (2, 1, "work", ["styles"])]
    q = {(r.id, r.group_ord): r.question for r in QN.build_questions(QN.catalogue_groups(v), F.col("category")).collect()}
    assert "Caterers" in q[1, 0] and "Photo Studios" in q[2, 1] and "- styles" in q[2, 1]


@pytest.mark.parametrize("category", ["FLORISTS", None])
def test_unknown_category_fails_the_run(spark, category):
    cat = C.catalogue(spark, MODELS, OUTPUTS)
    v = vendors(spark, [(1, "A", "Pune", "MH", "CATERERS"), (2, "B", "Goa", "GA", category)])
    plan = FL.vendor_profiles(v, shots(spark, []), spark.createDataFrame([], "id long, raw string"), cat)  # nothing runs here
    with pytest.raises(Exception, match=f"Unknown category: {category}"):
        plan.collect()


def test_catalogue_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_CATEGORIES", 1)
    with pytest.raises(ValueError):
        C.catalogue(spark, MODELS, OUTPUTS)


def test_run(spark):
    table = "<table><tr><th>Features</th><th>v</th></tr><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>"
    at = lambda s: T0 + dt.timedelta(seconds=s)
    late = page("q3", GOOD + " late")
    rows = [(1, 0, "q1", T0, at(40), page("q1", GOOD + " second"), None), (1, 0, "q1", T0, at(10), page("q1", GOOD + " first", table), None),
            (1, 0, "q1", T0, at(2), page("q1", "loading"), None),
            (2, 0, "q2", T0, at(5), None, "connection reset"), (2, 1, "q3", T0, at(5), page("q3", "short"), None), (2, 1, "q3", T0, at(75), late, None)]
    cat = C.catalogue(spark, MODELS, OUTPUTS)
    v = vendors(spark, [(1, "A", "Pune", "MH", "CATERERS"), (2, "B", "Goa", "GA", "PHOTO_STUDIOS"), (3, "C", None, None, "CATERERS")])
    done = spark.createDataFrame([(1, '{"website":"w","sources":["Overview","x"]}')], "id long, raw string")
    out = {(r.id, r.group_ord): r for r in FL.attached_outcomes(v, shots(spark, rows), cat).collect()}
    one = out[1, 0]
    assert one.answer_text == f"{GOOD} first Features v a in b" and one.reason is None and one.ts == at(10) and one.page_html is None
    assert one.tables == ["| Feature | v |  |\n| --- | --- | --- |\n| a in | in | b |\n| in |  |  |", "| in |\n| --- |"]
    assert one.raw_html.startswith("<p>You said:") and "imprint" not in one.raw_html
    assert (out[2, 0].reason, out[2, 0].error, out[2, 0].page_html) == ("error", "connection reset", None)
    assert (out[2, 1].reason, out[2, 1].page_html, out[2, 1].ts) == ("no_response", late, at(75))
    assert (out[3, 0].reason, out[3, 0].page_html) == ("no_input", None)
    env = {(r.id, r.group_ord): r for r in A.envelope(FL.attached_outcomes(v, shots(spark, rows), cat)).collect()}
    assert (env[1, 0].success, env[1, 0].error, env[1, 0].format, env[1, 0].timestamp, len(env[1, 0].tables)) == (True, None, "text", at(10), 2)
    assert [env[k].error for k in ((2, 0), (2, 1), (3, 0))] == ["connection reset", fixed.FAILURE_TEXT, fixed.NO_INPUT_TEXT]
    assert all(env[k].tables == [] and env[k].raw_html is None and env[k].answer is None for k in ((2, 0), (2, 1), (3, 0)))
    got = {r.id: r for r in FL.vendor_profiles(v, shots(spark, rows), done, cat).collect()}
    assert (got[1].n_groups, got[1].n_failed, got[1].n_tables, got[1].parse_status, got[1].website, got[1].sources) == (1, 0, 2, "ok", "w", ["x"])
    assert (got[2].n_groups, got[2].n_failed, got[2].combined_text, got[2].parse_status) == (2, 2, "", "missing")
    assert '"cuisine":[]' in got[1].prompt and '"cuisine"' not in got[2].prompt and "City:\nNone" in got[3].prompt


def test_every_input_is_read_once(spark):
    from tests.conftest import SF_SMALL
    from vendorscope.plans.catalog import all_queries
    plan = all_queries()["vendor_profile_flow"].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    reads = lambda t: plan.count(f"{t}.parquet")
    assert reads("customer") == 1 and reads("orders") == 1 and plan.count("ArrowEvalPython") == 1


def test_quarantined_pages_can_be_read_again(spark):
    from tests.conftest import SF_SMALL
    from vendorscope.plans.catalog import all_queries
    rows = all_queries()["quarantine_pages"].build(spark, SF_SMALL).collect()
    by = {k: [r for r in rows if r.reason == k] for k in ("no_input", "no_response", "error")}
    assert all(by.values()) and all(r.page_html.startswith("<html>") for r in by["no_response"])
    assert all(r.error and r.page_html is None and r.ts for r in by["error"])
