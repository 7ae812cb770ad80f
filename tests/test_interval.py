"""The interval query (orders x clicks in [previous order, order]).

Hand-made rows for each rule, then random inputs against the oracle SQL (DuckDB).
"""

import random

import pandas as pd
import pytest

from shopflow.operators.interval import interval_totals, previous_time
from shopflow.oracle import INTERACT_BEFORE_BUY
from shopflow.plans import gold, silver

from . import helpers as h

AS_OF = "2024-01-31 00:00:00"


def _result(spark, order_rows, click_rows, shoe_rows):
    o = h.orders(spark, order_rows)
    hist = silver.click_history_v2(h.clicks(spark, click_rows), h.shoes(spark, shoe_rows), AS_OF)
    got = gold.interactions_before_buy(o, hist).toPandas()
    return {(r.customer_id, r.order_id): (r.interact_count_before_buy, r.view_duration_before_buy)
            for r in got.itertuples()}, o, hist


def _brute(o, hist):
    want = h.run_sql(INTERACT_BEFORE_BUY, shoe_orders=o.toPandas(), click_history_v2=hist.toPandas())
    return {(r.customer_id, r.order_id): (r.interact_count_before_buy,
                                          None if pd.isna(r.view_duration_before_buy) else r.view_duration_before_buy)
            for r in want.itertuples()}


def _norm(d):
    return {k: (int(a), None if b is None or pd.isna(b) else int(b)) for k, (a, b) in d.items()}


def test_interval_rules(spark):
    orders = [
        (1, "1", "c1", h.at(10)),        # first order: lower end 1900-01-01
        (2, "1", "c1", h.at(12)),        # previous order at 10:00
        (3, "1", "c2", h.at(10)),        # only a later click -> present with 0 / 0
        (4, "1", "c3", h.at(10)),        # no click at all -> absent
        (5, "1", "c4", h.at(10)),        # two orders in one second:
        (6, "1", "c4", h.at(10)),        # ... order 6 follows order 5 (order_id tie-break)
        (7, "1", "c5", None),            # NULL time: nothing counted, still present
        (8, "9", "c6", h.at(11)),        # unknown product: absent (no shoe, no click)
        (9, "2", "c7", h.at(10)),        # previous order may be of another product
        (10, "1", "c7", h.at(12)),
    ]
    clicks = [
        ("1", "c1", 5, h.at(9)),
        ("1", "c1", 7, h.at(10)),        # exactly at order 1 -> counted for order 1 and order 2
        ("1", "c1", 11, h.at(12)),       # exactly at order 2
        ("1", "c1", 13, h.at(13)),       # after the last order
        ("1", "c1", 17, None),           # NULL time: never counted
        ("1", "c2", 3, h.at(11)),
        ("1", "c4", 2, h.at(9)),
        ("1", "c4", 4, h.at(10)),
        ("1", "c5", 6, h.at(10)),
        ("1", "c7", 8, h.at(9)),
        ("1", "c7", 9, h.at(11)),
    ]
    got, o, hist = _result(spark, orders, clicks, [("1", "A"), ("2", "B")])
    assert _norm(got) == {
        ("c1", 1): (2, 12),
        ("c1", 2): (2, 18),
        ("c2", 3): (0, 0),
        ("c4", 5): (2, 6),
        ("c4", 6): (1, 4),
        ("c5", 7): (0, 0),
        ("c7", 10): (1, 9),
    }
    assert _norm(got) == _norm(_brute(o, hist))


def test_null_view_time_rule(spark):
    # every joined row in the interval with a NULL view time -> NULL duration
    orders = [(1, "1", "c1", h.at(10)), (2, "1", "c2", h.at(10))]
    clicks = [("1", "c1", None, h.at(9)), ("1", "c2", None, h.at(9)), ("1", "c2", 5, h.at(11))]
    got, o, hist = _result(spark, orders, clicks, [("1", "A")])
    assert _norm(got) == {("c1", 1): (1, None), ("c2", 2): (1, 0)}
    assert _norm(got) == _norm(_brute(o, hist))


def test_duplicate_shoe_rows_multiply(spark):
    orders = [(1, "1", "c1", h.at(10))]
    clicks = [("1", "c1", 5, h.at(9))]
    got, o, hist = _result(spark, orders, clicks, [("1", "A"), ("1", "B")])
    assert _norm(got) == {("c1", 1): (2, 10)}
    assert _norm(got) == _norm(_brute(o, hist))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_oracle_sql(spark, seed):
    rnd = random.Random(seed)
    users, products = ["u1", "u2", "u3"], ["1", "2", "3"]

    def t():
        if rnd.random() < 0.05:
            return None
        # a few days, coarse seconds so that ties happen
        return h.at(hours=rnd.randrange(0, 96), seconds=rnd.choice([0, 0, 1, 30]))

    def some(values):
        return None if rnd.random() < 0.1 else rnd.choice(values)

    orders = [(i, some(products), some(users), t()) for i in range(60)]
    orders += [(i, rnd.choice(products), u, ts) for i, (_, _, u, ts) in zip(range(60, 70), orders[:10])]  # same second
    clicks = [(some(products), some(users), rnd.choice([None, 1, 5, 9]), t()) for _ in range(300)]
    got, o, hist = _result(spark, orders, clicks, [("1", "A"), ("2", "B"), ("2", "B")])
    assert _norm(got) == _norm(_brute(o, hist))


def test_previous_time_crosses_days(spark):
    df = spark.createDataFrame(
        [("c", 1, h.at(0)), ("c", 2, h.at(30)), ("c", 3, h.at(30)), ("c", 4, h.at(100)), ("d", 5, None)],
        "k string, id long, ts timestamp_ntz",
    )
    got = {r.id: r.prev_ts for r in previous_time(df, ["k"], "ts", ["id"]).collect()}
    assert got == {1: None, 2: h.at(0), 3: h.at(30), 4: h.at(30), 5: None}


def test_a_null_product_order_ends_the_interval(spark):
    orders = [(1, "1", "c", h.at(10)), (2, None, "c", h.at(11)), (3, "1", "c", h.at(12))]
    got, o, hist = _result(spark, orders, [("1", "c", 5, h.at(10.5)), ("1", "c", 7, h.at(11.5))], [("1", "A")])
    assert _norm(got) == {("c", 1): (0, 0), ("c", 3): (1, 7)}
    assert _norm(got) == _norm(_brute(o, hist))


def test_interval_totals(spark):
    ev = spark.createDataFrame(
        [("k", h.at(0), 1), ("k", h.at(0), 1), ("k", h.at(25), 1), ("k", h.at(49), 1), ("k", None, 1), ("j", h.at(0), 5),
         (None, h.at(1), 3)], "key string, t timestamp_ntz, n long")
    iv = spark.createDataFrame(
        [("k", 1, h.at(0), h.at(25)), ("k", 2, h.at(1), None), ("k", 3, h.at(1), h.at(60)), ("x", 4, h.at(0), h.at(9)),
         (None, 5, h.at(0), h.at(9))], "key string, id long, lo timestamp_ntz, hi timestamp_ntz")
    out = {r.id: (r.n, r["all"]) for r in interval_totals(iv, ev, ["key"], "lo", "hi", "t", ["n"], ["id"], "all").collect()}
    assert out == {1: (3, 5), 2: (0, 5), 3: (2, 5), 4: (0, 0), 5: (3, 3)}


def test_plan_has_no_pairwise_join(spark):
    """The interval plan joins only on equality of whole keys with the probe
    results, never clicks with orders of the same (customer, product)."""
    got, o, hist = _result(spark, [(1, "1", "c1", h.at(10))], [("1", "c1", 5, h.at(9))], [("1", "A")])
    df = gold.interactions_before_buy(o, hist)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_null_keys_form_their_own_group(spark):
    df = spark.createDataFrame(
        [(None, 7, h.at(0)), (None, 8, h.at(30)), ("c", 9, h.at(10))],
        "k string, id long, ts timestamp_ntz",
    )
    got = {r.id: r.prev_ts for r in previous_time(df, ["k"], "ts", ["id"]).collect()}
    assert got == {7: None, 8: h.at(0), 9: None}
