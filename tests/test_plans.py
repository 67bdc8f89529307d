"""Plans of the registered queries: no joins over all pairs, narrow scans, no texts in shuffles of places."""

import os

import pytest

import __spark_entry__ as entry
from palimpsest.plans import catalogue, records

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", sorted(catalogue.Q | records.Q))
def test_every_query_runs_without_nested_loops(spark, name):
    df = entry.queries()[name](spark, DATA)
    text = plan(df)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    df.write.format("noop").mode("overwrite").save()


def test_scans_are_narrow(spark):
    q = entry.queries()
    assert "ReadSchema: struct<revision_timestamp:string>" in plan(q["latest_timestamp"](spark, DATA))
    text = plan(q["p6_found"](spark, DATA))
    assert "ReadSchema: struct<delivery_id:bigint,page_id:bigint>" in text
    assert "PushedFilters: [IsNotNull(found_in_bundle), IsNotNull(revision_id)]" in plan(q["unseen_revisions"](spark, DATA))


def test_only_an_absent_subpackage_is_left_out(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "palimpsest.llm", None)
    assert not {"p5_found", "p7_found"} & set(importlib.reload(entry).queries()) and "p1_found" in entry.queries()
    monkeypatch.undo()
    importlib.reload(entry)


def test_places_are_not_shuffled_twice(spark):
    """A running sum shuffles its rows by range once; what follows is a broadcast of one row a partition."""
    text = plan(entry.queries()["archive_offsets"](spark, DATA))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_sql_is_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
