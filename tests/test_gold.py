"""Hand-made rows for the ranking, NULL-group, ratio and recency rules."""

import datetime as dt

from shopflow.operators.setops import duplicate_keys, missing_keys
from shopflow.plans import gold, silver

from . import helpers as h

AS_OF = dt.datetime(2024, 1, 31)


def test_top_sellers_null_group_and_inner_drop(spark):
    shoes = h.shoes(spark, [("1", "A"), ("2", "B")])
    orders = h.orders(spark, [(1, "1", "c1", h.at(1)), (2, "1", "c2", h.at(2)), (3, "9", "c1", h.at(3)),
                              (4, "8", "c3", h.at(4)), (5, None, "c1", h.at(5))])
    custs = h.customers(spark, ["c1", "c2", "c2"])  # c2 twice: its orders count twice, as in the join
    all_time = {r.shoes_id: r.total_sales for r in gold.top_sellers_all_time(orders, custs, shoes).collect()}
    assert all_time == {"1": 3, None: 3}
    tx = silver.transactions_v2(orders, custs, shoes)
    history = gold.customer_order_history(orders, custs, shoes)
    assert sum(r.bought_count for r in history.collect()) == tx.count()
    assert {r.shoes_id: r.total_sales for r in gold.top_sellers_from_transactions(tx).collect()} == all_time
    inner = {r.shoes_id: r.total_sales for r in gold.top_sellers(orders, shoes).collect()}
    assert inner == {"1": 2}


def test_interest_profile_ties_and_single_brand(spark):
    shoes = h.shoes(spark, [("1", "B"), ("2", "A"), ("3", "C")])
    clicks = h.clicks(spark, [("1", "u1", 5, h.at(1)), ("2", "u1", 5, h.at(2)), ("3", "u1", 5, h.at(3)),
                              ("1", "u2", 5, h.at(5)), ("1", "u2", 5, None)])
    orders = h.orders(spark, [(1, "1", "u1", h.at(9)), (2, "2", "u1", h.at(9)), (3, "3", "u1", h.at(9)),
                              (4, "3", "u1", h.at(9))])
    hist = silver.click_history_v1(clicks, AS_OF)
    intent = gold.intent_history(hist, orders, shoes)
    prof = {r.user_id: r for r in gold.interest_profile(hist, intent).collect()}
    # u1: C bought twice; A and B once each -> the smaller name wins the tie
    assert (prof["u1"].most_interest_brand, prof["u1"].second_interest_brand) == ("C", "A")
    assert prof["u1"].total_buy == 4 and prof["u1"].click_count == 3
    # u2: one brand only -> NULL second; a NULL-time click sorts first -> NULL hours
    assert prof["u2"].second_interest_brand is None
    assert prof["u2"].latest_interact_hour is None
    assert prof["u1"].latest_interact_hour == (AS_OF - h.at(1)).days * 24 + (AS_OF - h.at(1)).seconds // 3600


def test_customer_feature_zero_denominator_and_brand_average(spark):
    shoes = h.shoes(spark, [("1", "B"), ("2", "A")])
    clicks = h.clicks(spark, [("1", "u1", 10, h.at(1)), ("2", "u1", 4, h.at(1)), ("2", "u1", 16, h.at(2)),
                              ("1", "u2", 3, h.at(20))])
    orders = h.orders(spark, [(1, "1", "u1", h.at(5)), (2, "1", "u2", h.at(10))])
    hist = silver.click_history_v2(clicks, shoes, AS_OF)
    feats = {r.customer_id: r for r in gold.customer_feature(
        gold.interactions_before_buy(orders, hist), hist, h.customers(spark, ["u1"])).collect()}
    # u1: one click on product 1 before order 1 -> 10 / 1; brands by average view: A 10, B 10 -> tie -> A first
    assert feats["u1"].avg_view_duration_before_buy == 10.0
    assert (feats["u1"].most_interaction_brand, feats["u1"].second_interaction_brand) == ("A", "B")
    assert feats["u1"].first_name == "F"
    # u2: the only click is after the order -> 0 / 0 -> NULL; not a known customer -> NULL profile
    assert feats["u2"].avg_view_duration_before_buy is None and feats["u2"].first_name is None


def test_recency_filters(spark):
    clicks = h.clicks(spark, [
        ("1", "u", 1, dt.datetime(2024, 1, 24, 0, 0, 1)),   # 6 days 23:59:59 before -> in the week
        ("1", "u", 2, dt.datetime(2024, 1, 24, 0, 0, 0)),   # exactly 7 days -> out
        ("1", "u", 4, dt.datetime(2024, 2, 5)),             # after as_of -> kept (negative days)
        ("1", "u", 8, None),                                 # NULL -> dropped
        ("2", "u", 16, dt.datetime(2024, 1, 30, 23, 45)),    # exactly 15 minutes before -> in the monitor
        ("2", "u", 32, dt.datetime(2024, 1, 30, 23, 44, 59)),
    ])
    hist = silver.click_history_v1(clicks, AS_OF)
    week = {(r.user_id, r.product_id): r.view_time for r in gold.clicks_within_days(hist, AS_OF, 7).collect()}
    assert week == {("u", "1"): 5, ("u", "2"): 48}
    recent = sorted(r.view_time for r in gold.recent_clicks(hist, "ts", AS_OF, 15).collect())
    assert recent == [4, 16]
    days = {r.view_time: r.days_since_timestamp for r in hist.collect()}
    assert days[1] == 6 and days[2] == 7 and days[4] == -5 and days[8] is None


def test_checks(spark):
    shoes = h.shoes(spark, [("1", "A"), ("1", "B"), ("2", "C")])
    assert [(r.id, r["count"]) for r in duplicate_keys(shoes, "id").collect()] == [("1", 2)]
    a = h.orders(spark, [(1, "1", "c", h.at(1)), (2, "1", "c", h.at(1)), (2, "1", "c", h.at(2))])
    b = h.orders(spark, [(1, "1", "c", h.at(1))])
    assert [r.order_id for r in missing_keys(a, b, "order_id").collect()] == [2]


def test_transactions_columns(spark):
    shoes, custs = h.shoes(spark, [("1", "A")]), h.customers(spark, ["c"])
    orders = h.orders(spark, [(1, "1", "c", h.at(1)), (2, "5", "x", h.at(1))])
    v2 = silver.transactions_v2(orders, custs, shoes)
    assert v2.columns == ["order_id", "product_id", "customer_id", "shoe_orders_ts", "customers_id", "first_name",
                          "last_name", "email", "phone", "street_address", "state", "zip_code", "country",
                          "country_code", "shoes_id", "brand", "name", "sale_price", "rating", "orders_ts_month"]
    rows = {r.order_id: r for r in v2.collect()}
    assert rows[1].orders_ts_month == "202401" and rows[2].customers_id is None and rows[2].brand is None
    v1 = silver.transactions_v1(orders, custs, shoes)
    assert "orders_arrive_dt" in v1.columns and "shoes_arrive_dt" in v1.columns and "orders_ts" in v1.columns


def test_options_and_latest_by_key(spark):
    from shopflow.operators.dedup import latest_by_key

    shoes = h.shoes(spark, [("1", "B"), ("2", "A")])
    clicks = h.clicks(spark, [("1", "u1", 10, h.at(1)), ("2", "u1", 4, h.at(5)), ("2", "u1", 6, h.at(6))])
    hist1 = silver.click_history_v1(clicks, AS_OF)
    intent = gold.intent_history(hist1, h.orders(spark, []), shoes)
    first = gold.interest_profile(hist1, intent).collect()[0].latest_interact_hour
    last = gold.interest_profile(hist1, intent, which="last").collect()[0].latest_interact_hour
    assert first - last == 5
    hist2 = silver.click_history_v2(clicks, shoes, AS_OF)
    inter = gold.interactions_before_buy(h.orders(spark, [(1, "1", "u1", h.at(9))]), hist2)
    by_avg = gold.customer_feature(inter, hist2, h.customers(spark, ["u1"])).collect()[0]
    by_cnt = gold.customer_feature(inter, hist2, h.customers(spark, ["u1"]), rank_by="count").collect()[0]
    assert by_avg.most_interaction_brand == "B" and by_cnt.most_interaction_brand == "A"
    versions = spark.createDataFrame([("1", 100, 1), ("1", 120, 2), ("2", 50, 1)], "id string, price int, v int")
    assert sorted((r.id, r.price) for r in latest_by_key(versions, "id", ["v"]).collect()) == [("1", 120), ("2", 50)]


def test_build_tables(spark, scratch):
    from shopflow import fixtures as fx
    from shopflow.plans.tables import build_tables

    from .conftest import SF_SMALL

    spark.sql(f"CREATE DATABASE IF NOT EXISTS shopflow_b LOCATION '{scratch}/dbb'")
    out = build_tables(spark, fx.bronze_tables(spark, SF_SMALL), fx.AS_OF, database="shopflow_b")
    assert spark.table("shopflow_b.customer_feature").count() == out["customer_feature"].count() > 0
    other = spark.newSession()  # permanent views are seen by every session
    for name in ("top_sell_product", "top_sell_product_all_time", "customer_order_history"):
        assert other.table(f"shopflow_b.{name}").count() == out[name].count() > 0


def test_build_tables_again_with_newer_frames(spark, scratch):
    from shopflow.plans.tables import build_tables

    db = "shopflow_again"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/again'")
    bronze = {"shoes": h.shoes(spark, [("1", "B"), ("2", "A")]), "customers": h.customers(spark, ["u1"]),
              "shoe_clickstream": h.clicks(spark, [("1", "u1", 10, h.at(1))])}

    def sold(orders):
        build_tables(spark, {**bronze, "shoe_orders": orders}, AS_OF, database=db)
        return {r.shoes_id: r.total_sales for r in spark.newSession().table(f"{db}.top_sell_product").collect()}

    assert sold(h.orders(spark, [(1, "1", "u1", h.at(9))])) == {"1": 1}
    more = h.orders(spark, [(1, "1", "u1", h.at(9)), (2, "1", "u1", h.at(10)), (3, "2", "u1", h.at(11))])
    assert sold(more) == {"1": 2, "2": 1}
    # the catalog table itself is read where it is the given frame, so that the view follows it
    more.write.saveAsTable(f"{db}.shoe_orders")
    assert sold(spark.table(f"{db}.shoe_orders")) == {"1": 2, "2": 1}
    more.limit(1).write.mode("append").saveAsTable(f"{db}.shoe_orders")
    assert spark.newSession().table(f"{db}.top_sell_product").agg({"total_sales": "sum"}).first()[0] == 4
    # a table of that name with other rows is neither read nor overwritten
    assert sold(h.orders(spark, [(9, "2", "u1", h.at(9))])) == {"2": 1}
    assert spark.table(f"{db}.shoe_orders").count() == 4
