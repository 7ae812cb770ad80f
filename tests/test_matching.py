"""Matching along time against brute force: interval rows, next event, the row before, sessions."""

import random

import pytest
from pyspark.sql import functions as F

from shopflow import fixtures as fx
from shopflow.operators import matching
from shopflow.operators.matching import global_previous, interval_rows, next_event
from shopflow.plans.behaviour import click_sessions, interaction_rows
from shopflow.plans import gold, silver
from shopflow.schemas import BRONZE
from shopflow.plans.bronze import normalise_ts, parse
from shopflow.sources.replay import read_messages, write_messages

from . import helpers as h
from .conftest import SF_CHECK, SF_SMALL


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed, n, keys, columns):
    rnd = random.Random(seed)

    def t():
        return None if rnd.random() < 0.05 else h.at(hours=rnd.randrange(0, 6), seconds=rnd.choice([0, 0, 1, 30]))

    def key():
        return None if rnd.random() < 0.1 else rnd.choice(keys)

    return [(key(), *(t() for _ in range(columns)), i % 7) for i in range(n)]


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 3), (3, 1)])
def test_interval_rows(spark, monkeypatch, seed, block):
    monkeypatch.setattr(matching, "BLOCK", block)
    asked = random_rows(seed, 60, "ab", 2)
    asked += asked[:5]  # repeated intervals match again
    events = random_rows(seed + 10, 200, "abc", 1)
    got = interval_rows(spark.createDataFrame(asked, "k string, lo timestamp_ntz, hi timestamp_ntz, i int"),
                        spark.createDataFrame(events, "k string, t timestamp_ntz, e int"), ["k"], "lo", "hi", "t")
    assert got.columns == ["k", "lo", "hi", "i", "t", "e"]
    want = [(k, lo, hi, i, t, e) for k, lo, hi, i in asked for k2, t, e in events
            if None not in (k, lo, hi, t) and k == k2 and lo <= t <= hi]
    assert len(want) > 300 and rows_of(got) == sorted(want, key=str)


def test_interval_rows_of_one_hot_key_spread(spark):
    """Half of all rows are one pair; no join step deals them by that pair alone."""
    def hot(df, *names):  # derived from the column, so that it is a key like any other
        return df.withColumns({n: (F.length(n) * 0).cast("string") for n in names})

    orders = hot(fx.orders(spark, SF_CHECK), "customer_id", "product_id").dropna()
    clicks = hot(fx.clicks(spark, SF_CHECK), "user_id", "product_id").dropna()
    hist = silver.click_history_v2(clicks, h.shoes(spark, [("0", "A")]), "2024-01-31 00:00:00")
    found = interaction_rows(orders, hist)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line or "HashJoin" in line]
    assert joins and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert all("_rank" in line or "shoe_clickstream_ts" in line or "id#" in line for line in joins)
    # every click up to the last order lies in one interval, or two where it falls on an order's second
    last = orders.agg(F.max("ts")).first()[0]
    clicks = hist.filter(F.col("shoe_clickstream_ts") <= last).count()
    counted = gold.interactions_before_buy(orders, hist).agg(F.sum("interact_count_before_buy")).first()[0]
    assert found.count() == counted and clicks <= counted <= 3 * clicks


@pytest.mark.parametrize("seed", [1, 2])
def test_next_event(spark, seed):
    probes, events = random_rows(seed, 150, "ab", 1), random_rows(seed + 5, 40, "abc", 1)
    got = next_event(spark.createDataFrame(probes, "k string, t timestamp_ntz, i int"),
                     spark.createDataFrame(events, "k string, t timestamp_ntz, e int"), ["k"], "t", ["e"], "next")
    want = []
    for k, t, i in probes:
        after = [(t2, e) for k2, t2, e in events if k2 == k and t2 and t and t2 >= t]
        want.append((k, t, i, min(after) if after else None))
    assert sorted(((r.k, r.t, r.i, tuple(r.next) if r.next else None) for r in got.collect()), key=str) == sorted(
        want, key=str)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_global_previous_has_no_single_task(spark, partitions):
    rows = sorted(set(random_rows(4, 120, "abcd", 1)), key=str)
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i int")
    got = global_previous(df, ["t", "k", "i"], "t", "before", partitions)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()

    def nulls_first(r):
        return [(r[j] is not None, r[j]) for j in (1, 0, 2)]

    inorder = sorted(rows, key=nulls_first)
    want = [(*r, None if n == 0 else inorder[n - 1][1]) for n, r in enumerate(inorder)]
    assert rows_of(got) == sorted(want, key=str)
    assert global_previous(df.limit(0), ["t", "k", "i"], "t", "before").count() == 0


def test_strict_interactions(spark):
    orders = [(1, "1", "c1", h.at(10)), (2, "1", "c1", h.at(12)), (3, "1", "c2", h.at(9)), (4, "1", "c3", None),
              (5, "1", "c4", h.at(9))]
    clicks = [("1", "c1", 5, h.at(9)), ("1", "c1", 7, h.at(10)), ("1", "c1", 9, h.at(12)), ("1", "c2", 1, h.at(9)),
              ("1", "c3", 1, h.at(9)), ("1", "c4", None, h.at(8)), ("1", "c1", 4, None)]
    hist = silver.click_history_v2(h.clicks(spark, clicks), h.shoes(spark, [("1", "A")]), "2024-01-31 00:00:00")
    got = {r.order_id: tuple(r)[2:] for r in gold.interactions_before_buy(h.orders(spark, orders), hist, strict=True).collect()}
    # a click on the order's second is not before it; c2 has none before, c4 only one without view time
    assert got == {1: (1, 5), 2: (1, 7), 5: (1, None)}


def test_one_customer_of_the_rows(spark):
    hist = silver.click_history_v2(fx.clicks(spark, SF_SMALL), fx.shoes(spark, SF_SMALL), fx.AS_OF)
    for previous in ("customer", "anyone"):
        every = interaction_rows(fx.orders(spark, SF_SMALL), hist, previous)
        one = every.first().customer_id if every.first() else "1"
        assert rows_of(interaction_rows(fx.orders(spark, SF_SMALL), hist, previous, one)) == rows_of(
            every.filter(F.col("customer_id") == one))
    with pytest.raises(ValueError):
        interaction_rows(fx.orders(spark, SF_SMALL), hist, "nobody")


def test_sessions_of_a_stream_equal_the_batch(spark, scratch):
    write_messages(fx.wire(spark, SF_SMALL, "shoe_clickstream").repartition(3), f"{scratch}/src")
    rows = normalise_ts(parse(read_messages(spark, f"{scratch}/src", 1), "shoe_clickstream"), "shoe_clickstream", "UTC")
    rows = rows.withColumns({"arrive_dt": F.col("ts"), "ts": F.col("ts").cast("timestamp")}).withWatermark("ts", "3650 days")
    found = click_sessions(rows.select(*BRONZE["shoe_clickstream"].fieldNames()))
    found.writeStream.outputMode("complete").format("memory").queryName("sessions_now").trigger(
        availableNow=True).option("checkpointLocation", f"{scratch}/c").start().awaitTermination()
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) if c.startswith("session") else F.col(c) for c in found.columns]
    batch = click_sessions(fx.clicks(spark, SF_SMALL))
    assert rows_of(spark.table("sessions_now").select(*ntz)) == rows_of(batch) != []
