"""Products that go together against brute force; a basket with every item; point-in-time features and likelihood."""

import datetime as dt
import random
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopflow.operators import cooccurrence
from shopflow.operators.cooccurrence import co_counts, top_partners
from shopflow.operators.matching import totals_before
from shopflow.plans import likelihood as lk
from shopflow.plans.recommend import recommended

from . import helpers as h


def brute(rows):
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    each = Counter(i for items in baskets.values() for i in items)
    both = Counter(p for items in baskets.values() for p in permutations(items, 2))
    return {(i, j, n, each[i], each[j]) for (i, j), n in both.items()}


@pytest.mark.parametrize("block,lists,pairs", [(1024, 64, 1 << 20), (4, 2, 1 << 20), (2, 1, 3)])
def test_co_counts(spark, monkeypatch, block, lists, pairs):
    monkeypatch.setattr(cooccurrence, "BLOCK_ITEMS", block)
    monkeypatch.setattr(cooccurrence, "LISTS_PER_TASK", lists)
    rnd = random.Random(block)
    rows = [(rnd.choice([None, *"abcdefgh"]), rnd.choice([None, *(f"i{n}" for n in range(12))])) for _ in range(90)]
    rows += [("all", f"i{n}") for n in range(12)]
    df = spark.createDataFrame(rows, "who string, what string")
    found = co_counts(df, "who", "what").collect()
    got = [(r.item, r.other, r.n_both, r.n_item, r.n_other) for r in found]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    assert co_counts(df.limit(0), "who", "what").count() == 0


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
def test_sums_hold_few_pairs(monkeypatch, held):
    monkeypatch.setattr(cooccurrence, "PAIRS_HELD", held)
    rnd = np.random.default_rng(held)
    lists = [[sorted(rnd.choice(20, rnd.integers(0, 6), replace=False).tolist()) for _ in range(30)] for _ in "ab"]
    batch = pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int64())) for x in lists], ["a", "b"])
    got = Counter()
    for out in cooccurrence._sums(iter([batch.slice(0, 11), batch.slice(11)])):
        for r in out.to_pylist():
            got[r["i"], r["j"]] += r["n_both"]
    assert got == Counter((i, j) for a, b in zip(*lists) for i in a for j in b if i < j)


def test_basket_with_every_item(spark, monkeypatch):
    monkeypatch.setattr(cooccurrence, "BLOCK_ITEMS", 8)
    monkeypatch.setattr(cooccurrence, "LISTS_PER_TASK", 4)
    df = spark.range(400).selectExpr("'all' AS who", "id AS what")
    out = co_counts(df, "who", "what")
    assert out.agg(F.count("*"), F.min("n_both"), F.max("n_both")).first()[:] == (400 * 399, 1, 1)


def test_basket_with_every_item_lies_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(cooccurrence, "LISTS_PER_TASK", 4)
    asked = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in asked}
    try:
        for k, v in asked.items():
            spark.conf.set(k, v)
        held = spark.range(400).selectExpr("'all' AS basket", "id AS item")
        items = held.selectExpr("item", "item % 50 AS block", "item AS number")
        pairs = cooccurrence._met(held, items).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    made = [r["count"] for r in pairs]
    assert sum(made) == 50 * 51 // 2 and len(made) >= 6 and max(made) < sum(made) / 3


def test_top_partners_break_ties_by_name(spark):
    rows = [("u", "a"), ("u", "b"), ("u", "c"), ("v", "a"), ("v", "c")]
    got = top_partners(co_counts(spark.createDataFrame(rows, "who string, what string"), "who", "what"), 1)
    assert {(r.item, r.other) for r in got.collect()} == {("a", "c"), ("b", "a"), ("c", "a")}


def test_recommended_leaves_out_what_is_bought(spark):
    clicks = h.clicks(spark, [(p, u, 1, h.at()) for u, ps in {"1": "abc", "2": "ab", "3": "bd"}.items() for p in ps])
    orders = h.orders(spark, [(1, "a", "9", h.at()), (2, "b", "9", h.at()), (3, "d", "8", h.at()), (4, None, "7", h.at())])
    got = {(r.user_id, r["rank"], r.product_id, r.score) for r in recommended(orders, clicks).collect()}
    assert got == {("9", 1, "c", 2), ("9", 2, "d", 1), ("8", 1, "b", 1)}


@pytest.mark.parametrize("bucket", [1, 3600, 10 ** 6])
def test_totals_before(spark, bucket):
    rnd = random.Random(bucket)

    def time():
        return None if rnd.random() < 0.1 else h.at(hours=rnd.randrange(4), seconds=rnd.choice([0, 0, 1]))

    asked = [(rnd.choice([None, "a", "b"]), time(), n) for n in range(50)]
    events = [(rnd.choice([None, "a", "b"]), time(), rnd.choice([None, 1, 5])) for _ in range(60)]
    got = totals_before(spark.createDataFrame(asked, "k string, ts timestamp_ntz, n int"),
                        spark.createDataFrame(events, "k string, ts timestamp_ntz, v int"), ["k"], "ts", ["v"], bucket)
    want = [(k, t, n, None if t is None else sum(v or 0 for j, s, v in events if j == k and s is not None and s < t))
            for k, t, n in asked]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def history(seed, days, users=60, products=12):
    """Users click; those who look long at a product often order it within three days."""
    rnd = random.Random(seed)
    clicks, orders = [], []
    for n in range(900):
        u, p = str(rnd.randrange(users)), str(rnd.randrange(products))
        t, seen = h.T0 + dt.timedelta(hours=rnd.randrange(24 * days)), rnd.choice([2, 3, 60, 90])
        clicks.append((p, u, seen, t))
        if seen > 10 and rnd.random() < 0.7:
            orders.append((n, p, u, t + dt.timedelta(hours=rnd.randrange(1, 72))))
    return clicks, orders


def test_later_rows_change_no_feature(spark):
    clicks, orders = history(1, 30)
    cut = h.T0 + dt.timedelta(days=15)
    end = h.T0 + dt.timedelta(days=40)
    early = lk.label_table(h.clicks(spark, [c for c in clicks if c[3] < cut]),
                           h.orders(spark, [o for o in orders if o[3] < cut]), end)
    full = lk.label_table(h.clicks(spark, clicks), h.orders(spark, orders), end)
    then = lk.label_table(h.clicks(spark, clicks), h.orders(spark, orders), cut)
    names = ["user_id", "product_id", "ts", "view_time", *lk.FEATURES]

    def of(df, *more):
        return Counter(tuple(r) for r in df.filter(F.col("ts") < F.lit(cut)).select(*names, *more).collect())

    assert sum(of(early).values()) > 300 and of(early) == of(full) == of(then)
    # rows after the end change neither features nor labels; unknown labels are those whose time is not over
    assert of(then, "label") == of(lk.label_table(h.clicks(spark, [c for c in clicks if c[3] < cut]),
                                                  h.orders(spark, [o for o in orders if o[3] < cut]), cut), "label")
    unknown = [r.ts for r in then.filter("label IS NULL").collect()]
    assert unknown and min(unknown) >= cut - dt.timedelta(hours=lk.HORIZON)


def test_likelihood_beats_a_constant(spark):
    clicks, orders = history(2, 60)
    split, end = h.T0 + dt.timedelta(days=40), h.T0 + dt.timedelta(days=90)
    examples = lk.label_table(h.clicks(spark, clicks), h.orders(spark, orders), end).cache()
    model = lk.fit_likelihood(examples, split)
    scored = lk.likelihood(model, examples).cache()
    assert scored.filter("likelihood < 0 OR likelihood > 1 OR likelihood IS NULL").count() == 0
    assert scored.columns == [*examples.columns, "likelihood"] and scored.count() == len(clicks)
    assert lk.area_under_curve(scored, split) > 0.75
    with pytest.raises(ValueError):
        lk.fit_likelihood(examples, h.T0)
