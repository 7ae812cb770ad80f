"""Outputs kept by deltas against the full queries, after each of ten change batches."""

import os
import random

from pyspark.sql import functions as F

from shopflow.plans import gold, silver
from shopflow.plans.deltas import Maintained

from . import helpers as h


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_after_each_change_batch_equal_to_the_full_query(spark, scratch):
    rnd = random.Random(6)
    kept = Maintained(spark, os.path.join(scratch, "kept"), fold_after=4)
    products, users = [str(i) for i in range(6)] + [None], [f"u{i}" for i in range(5)] + [None]
    state = {"orders": [], "clicks": [], "shoes": [], "customers": []}
    make = {
        "orders": lambda i: (i, rnd.choice(products), rnd.choice(users), h.at(i)),
        "clicks": lambda i: (rnd.choice(products), rnd.choice(users), rnd.choice([None, 0, 3, 8]), h.at(i)),
        "shoes": lambda i: (rnd.choice(products[:5]), rnd.choice("AB"), rnd.choice([50, 60])),
        "customers": lambda i: rnd.choice(users[:4]),
    }

    def shoes(rows):
        return h.shoes(spark, [r[:2] for r in rows]).limit(0).unionByName(spark.createDataFrame(
            [(i, b, f"shoe {i}", p, 4.0, h.T0) for i, b, p in rows], h.schemas.SHOES))

    frame = {"orders": lambda rows: h.orders(spark, rows), "clicks": lambda rows: h.clicks(spark, rows),
             "shoes": shoes, "customers": lambda rows: h.customers(spark, rows)}

    def signed(name, gone, come):
        return frame[name](gone).withColumn("_sign", F.lit(-1)).unionByName(
            frame[name](come).withColumn("_sign", F.lit(1)))

    for number in range(10):
        change = {}
        for name, sizes in (("orders", (2, 12)), ("clicks", (2, 20)), ("shoes", (1, 2)), ("customers", (1, 2))):
            if number and rnd.random() < 0.3:
                continue  # not every batch changes every table
            gone = rnd.sample(state[name], min(sizes[0], len(state[name])) if number else 0)
            come = [make[name](100 * number + i) for i in range(sizes[1] if number != 7 else 0)]
            for r in gone:
                state[name].remove(r)
            state[name] += come
            change[name] = signed(name, gone, come)
        if number == 4 and state["shoes"]:  # a price change of a shoe that has been sold and clicked
            old = state["shoes"].pop(0)
            state["shoes"].append((*old[:2], 99))
            price = signed("shoes", [old], [(*old[:2], 99)])
            change["shoes"] = change["shoes"].unionByName(price) if "shoes" in change else price
        assert kept.commit(number, **change)
        assert not kept.commit(number, **change)  # sent again
        full = {name: frame[name](rows) for name, rows in state.items()}
        history = silver.click_history_v1(full["clicks"], "2024-01-31 00:00:00")
        assert rows_of(kept.intent_history()) == rows_of(
            gold.intent_history(history, full["orders"], full["shoes"])), number
        assert rows_of(kept.top_sellers()) == rows_of(gold.top_sellers(full["orders"], full["shoes"])), number
        assert rows_of(kept.top_sellers_all_time()) == rows_of(
            gold.top_sellers_all_time(full["orders"], full["customers"], full["shoes"])), number
    slices = kept._state()[1]
    assert max(sum(s.startswith("orders/") for s in slices) for _ in [0]) <= 5  # folded on the way


def test_no_side_of_a_join_goes_through_the_driver(spark, scratch, monkeypatch):
    kept, plans, write = Maintained(spark, os.path.join(scratch, "kept")), [], Maintained._write

    def noted(self, rows, table):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, table)

    monkeypatch.setattr(Maintained, "_write", noted)
    for number in range(2):  # the second one meets what the first one left
        kept.commit(number, **{name: rows.withColumn("_sign", F.lit(1)) for name, rows in dict(
            orders=h.orders(spark, [(number, "1", "u", h.at(1)), (9, None, None, h.at(2))]),
            clicks=h.clicks(spark, [("1", "u", 3, h.at(1))]), shoes=h.shoes(spark, [("1", "AB"[number])]),
            customers=h.customers(spark, ["u"])).items()})
    plans.append(kept.intent_history()._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 9
    assert not [p for p in plans if "BroadcastExchange" in p]
    assert rows_of(kept.top_sellers()) == [("A", 4.0, 100, "1", 2), ("B", 4.0, 100, "1", 2)]
