"""Every registered query against its SQL, and the shape of the plans."""

import os
import re

import duckdb
import pytest

from __spark_entry__ import entry
from retail_lens.functions.text import null_missing
from retail_lens.operators.dedupe import collapse_copies
from workload.expressions import delivery_texts, sales_texts, shared
from workload.inputs import Inputs
from workload.oracle import ORACLE
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan
    result = con.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(repr(tuple(row[n] for n in names)) for row in df.collect())
    want = sorted(repr(tuple(row)) for row in result.fetchall())
    assert got == want


def test_entry(spark):
    assert entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["filter_period", "filter_since", "region_yoy", "rep_attainment", "forecast_detail"])
def test_period_filters_reach_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert pushed and all("GreaterThanOrEqual(l_shipdate" in line for line in pushed)
    reads = [line for line in plan.splitlines() if "ReadSchema" in line and "l_shipdate" in line]
    assert all("l_tax" not in line and "l_returnflag" not in line for line in reads)


def _largest_method(spark, df):
    """Bytes of the largest method generated for a plan."""
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return max(int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.mark.parametrize("name", ["raw_sales", "raw_deliveries"])
def test_untidy_rows_are_built_and_collapsed_in_compiled_methods(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for broadcast in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
            raw = null_missing(getattr(Inputs(spark, "/root/testdata/sf0.001"), name)())
            assert _largest_method(spark, raw.distinct()) < 8000  # the JVM interprets larger ones
            assert _largest_method(spark, collapse_copies(raw)) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shared_parts_are_written_once():
    for texts in (sales_texts("spark"), delivery_texts("spark")):
        parts, columns = shared(texts)
        assert parts and all(sum(p in q for q in [*parts.values(), *columns.values()]) == 1 for p in parts.values())
        spelled = {}
        for column, text in columns.items():
            for part, spelling in sorted(parts.items(), reverse=True, key=lambda p: len(p[0])):
                text = text.replace(part, spelling)
            spelled[column] = text
        assert spelled == texts
