"""Plans of the text queries: no joins over all pairs."""

import os

import pytest

import __spark_entry__ as entry
from palimpsest.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.Q))
def test_every_query_runs_without_nested_loops(spark, name):
    df = entry.queries()[name](spark, DATA)
    text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    df.write.format("noop").mode("overwrite").save()
