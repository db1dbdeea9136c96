"""Every registered query with an oracle matches DuckDB on the small tables."""

import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import check

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["page_id", "n_lines", "full_text", "answer_only", "tables_json", "answer", "meaningful"]


def test_every_query_has_docs():
    from vendorscope.plans.catalog import all_queries
    for name, q in all_queries().items():
        assert q.doc, name


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = check(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] == "ok", res


def test_every_survey_operator_has_a_query():
    import re
    from tools.coverage_report import claimed, survey_ids
    from vendorscope.plans.catalog import all_queries
    ids = set()
    for q in all_queries().values():
        ids |= claimed(q.doc)
    missing = [sid for sid, _ in survey_ids() if sid not in ids and re.sub(r"[a-z]$", "", sid) not in ids]
    assert not missing, missing
