"""Physical-plan checks: the shapes the design relies on, for every batch query."""

import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from bursa.operators.latest import latest_snapshot, max_data_date
from bursa.sources import adapters as A
from tests.conftest import SF_SMALL

# queries that run a stream or write a table when called
EAGER = {"sideways_upsert"} | {k for k in E._QUERIES if k.startswith("stream_")}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E._QUERIES) - EAGER))
def test_no_cross_join_no_python(spark, name):
    plan = _plan(E._QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


@pytest.fixture(scope="module")
def stored(spark):
    d = tempfile.mkdtemp(prefix="bursa-stored-")
    A.materialize(spark, SF_SMALL, d, names=["stock_summary", "trades"])
    return d


def test_latest_snapshot_prunes_partitions_and_limits_before_shuffle(spark, stored):
    s = A.load(spark, stored, "stock_summary")
    plan = _plan(latest_snapshot(s, max_data_date(s)))
    assert "PartitionFilters: [isnotnull(data_date" in plan and "= Subquery subquery" in plan
    assert plan.count("WindowGroupLimit") >= 2  # partial (before the exchange) and final


def test_column_pruning_reaches_scan(spark, stored):
    s = A.load(spark, stored, "stock_summary")
    df = s.where(F.col("data_date") == "20240101").select("security_code", "close_price")
    plan = _plan(df)
    assert "ReadSchema: struct<security_code:string,close_price:decimal(12,2)>" in plan
    assert "PartitionFilters: [isnotnull(data_date" in plan


def test_previous_day_reads_only_last_day_partitions(spark, stored):
    from bursa.plans.rebound import previous_day
    s = A.load(spark, stored, "stock_summary")
    df = previous_day(s, max_data_date(s))
    plan = _plan(df)
    assert "array_contains(Subquery subquery" in plan  # runtime partition pruning of the full-row scan
    ref = latest_snapshot(s.where(F.col("data_date") < max_data_date(s)))
    assert df.count() == ref.count()
