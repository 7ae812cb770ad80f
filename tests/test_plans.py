"""Physical-plan properties: push-down, pruning, no pair joins, no unbounded broadcast."""

import contextlib
import io
import os
import re

from shopflow import fixtures as fx
from shopflow.plans import gold, silver

from .conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _stored_clicks(spark, scratch):
    path = os.path.join(scratch, "shoe_clickstream")
    fx.clicks(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_recency_filters_reach_the_scan(spark, scratch):
    clicks = _stored_clicks(spark, scratch)
    week = gold.clicks_within_days(silver.click_history_v1(clicks, fx.AS_OF), fx.AS_OF, 7)
    plan = _plan(week)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    monitor = gold.recent_clicks(silver.click_history_v1(clicks, fx.AS_OF), "ts", fx.AS_OF, 15)
    assert "GreaterThanOrEqual(ts," in _plan(monitor)


def test_projection_is_pruned(spark, scratch):
    clicks = _stored_clicks(spark, scratch)
    week = gold.clicks_within_days(silver.click_history_v1(clicks, fx.AS_OF), fx.AS_OF, 7)
    scan = [line for line in _plan(week).splitlines() if line.strip().startswith("ReadSchema")][0]
    assert "page_url" not in scan and "ip" not in scan and "view_time" in scan


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_interval_plan_reads_each_input_once(spark):
    df = gold.interactions_before_buy(
        fx.orders(spark, SF_SMALL),
        silver.click_history_v2(fx.clicks(spark, SF_SMALL), fx.shoes(spark, SF_SMALL), fx.AS_OF),
    )
    plan = _executed(df)
    assert len(re.findall(r"FileScan parquet [^\n]*events.parquet", plan)) == 2
    assert len(re.findall(r"(?m)^[\s:+|*()0-9-]*Exchange ", plan)) <= 10
    # every window but the ones over per-bucket rows is partitioned by a time bucket
    assert len(re.findall(r"_bucket#\d+L?\], \[", plan)) >= 2


def test_no_registered_plan_has_a_nested_loop(spark):
    import __spark_entry__ as entry

    for name in sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline"):
        plan = entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_customers_are_not_hinted_for_broadcast(spark):
    tx = silver.transactions_v2(fx.orders(spark, SF_SMALL), fx.customers(spark, SF_SMALL), fx.shoes(spark, SF_SMALL))
    assert "broadcast" not in str(tx._jdf.queryExecution().logical()).lower()
