"""Physical-plan properties that must hold for every registered query."""

import re

import pytest

from paths import SF01

from tidemark.plans import registry as E

QUERIES = E.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF", "CollectLimit", "GlobalLimit")


def _plan(spark, name):
    df = QUERIES[name](spark, SF01)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_python_or_limit(spark, name):
    plan = _plan(spark, name)
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, bad


@pytest.mark.parametrize("name", ["six_way_join", "composite_total", "overview", "wow_report",
                                  "cap_history", "feed_status"])
def test_composite_reads_only_staged_tables(spark, name):
    plan = _plan(spark, name)
    assert not re.search(r"testdata/sf[\d.]+/(orders|lineitem)\.parquet", plan)


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in _plan(spark, "filter_eq")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate,1997-01-01", _plan(spark, "filter_between"))


def test_scans_are_pruned(spark):
    plan = _plan(spark, "filter_in")  # reads staged segment table only
    assert "ReadSchema: struct<area:string,d:date,n:bigint>" in plan
    plan = _plan(spark, "multi_sum")
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_tax:double,l_shipdate:timestamp_ntz>" in plan


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dimension_join_strategies_agree(spark):
    """Small dimension -> broadcast, no pre-aggregate; over the threshold ->
    (key, day) pre-aggregate then sort-merge join. Same rows either way."""
    from tidemark.plans import feeds as fd
    from tidemark.plans.q_series import facility_rollup
    from tidemark.sources.tables import Tables
    t = Tables(spark, SF01)
    small = fd._segment_daily(t)
    small_fac = facility_rollup(t)
    plan_small = small._jdf.queryExecution().executedPlan().toString()
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        large = fd._segment_daily(Tables(spark, SF01))
        large_fac = facility_rollup(Tables(spark, SF01))
        assert _rows(large) == _rows(small)
        assert _rows(large_fac) == _rows(small_fac)
        plan_large = large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    assert "BroadcastHashJoin" in plan_small
    assert "SortMergeJoin" in plan_large and "BroadcastHashJoin" not in plan_large


def test_bucketed_layout_joins_without_exchange(spark):
    """Over the broadcast threshold, orders and customer bucketed by customer
    key give a pre-aggregate and sort-merge join with no exchange at all."""
    import tempfile
    from tidemark.plans import feeds as fd
    from tidemark.sources.layout import bucket_tables
    from tidemark.sources.tables import Tables
    out = tempfile.mkdtemp(prefix="tidemark-bucket-")
    bucket_tables(spark, SF01, out, "tm_bucketed_test", 8, tables=("orders", "customer"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        t = Tables(spark, SF01, catalog_db="tm_bucketed_test")
        df = fd._segment_daily(t)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = _rows(df)
    finally:
        spark.conf.set(key, old)
    join_side = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in join_side and "Bucketed: true" in join_side
    assert rows == _rows(fd._segment_daily(Tables(spark, SF01)))
