"""Gold layer: business outputs over the bronze and silver tables.

Scale notes (each function repeats the ones that matter to it):

* facts are aggregated to one row per key *before* they meet a dimension, so
  joins see aggregates, not raw events, and partial aggregation collapses hot
  keys map-side;
* dimension joins that only multiply counts join a per-key multiplicity
  (one narrow row per key) instead of the dimension itself;
* per-group rankings run over per-(group, item) aggregates, so a window
  partition is bounded by the catalogue, not by the traffic;
* the interval query uses running totals (``operators.interval``) instead of an
  orders x clicks join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.times import (
    EARLIEST,
    REFERENCE_ZONE,
    AsOf,
    as_of_column,
    ntz_literal,
    since,
    truncate_to_second,
    within_days,
)
from shopflow.operators.interval import interval_totals, previous_time
from shopflow.operators.joins import key_multiplicity
from shopflow.operators.ranking import top_n_columns

#: output columns (fixed values)
CUSTOMER_PROFILE = (
    "first_name", "last_name", "email", "phone", "street_address",
    "state", "zip_code", "country", "country_code",
)


def _count() -> F.Column:
    return F.count(F.lit(1))


# ---------------------------------------------------------------- intent (V1)

def intent_history(history: DataFrame, orders: DataFrame, shoes: DataFrame) -> DataFrame:
    """``cust_intent_history``: per (user, shoe, brand) the average and total
    view time and the clicks (clicks of unknown products dropped), plus the
    number of times the user bought the shoe (0 when never)."""
    s = shoes.select("id", "brand")
    per_pair = history.groupBy("user_id", "product_id").agg(
        F.sum("view_time").alias("_tv"), F.count("view_time").alias("_nv"), _count().alias("_n")
    )
    clicked = (
        per_pair.join(s, per_pair["product_id"] == s["id"])
        .groupBy("user_id", F.col("id").alias("shoes_id"), "brand")
        .agg(F.sum("_tv").alias("_tv"), F.sum("_nv").alias("_nv"), F.sum("_n").alias("_n"))
    )
    mult = key_multiplicity(shoes, "id")
    bought = (
        orders.groupBy("customer_id", "product_id").agg(_count().alias("_b"))
        .join(mult, F.col("product_id") == F.col("id"))
        .select("customer_id", F.col("product_id").alias("_pid"), (F.col("_b") * F.col("mult")).alias("_buy"))
    )
    joined = clicked.join(
        bought,
        (clicked["user_id"] == bought["customer_id"]) & (clicked["shoes_id"] == bought["_pid"]),
        "left",
    )
    return joined.select(
        "user_id",
        "shoes_id",
        "brand",
        F.try_divide(F.col("_tv").cast("double"), F.col("_nv")).alias("avg_view_time"),
        F.col("_tv").alias("total_view_time"),
        F.col("_n").alias("click_count"),
        F.when(F.col("_buy") > 0, F.col("_buy")).otherwise(F.lit(0)).alias("buy_count"),
    )


def interest_profile(history: DataFrame, intent: DataFrame, which: str = "first") -> DataFrame:
    """Customer interest profile: hours since the user's *earliest* click
    (the reference's ``ORDER BY ts`` ascending, kept; ``which="last"`` takes
    the most recent click instead), the two brands bought most (ties: brand
    name ascending), and click / view / buy totals.

    The pick of one click per user is an aggregate, not a window: hours since
    a click fall as the click gets later, so the earliest click has the
    largest value and a hot user is reduced map-side."""
    if which == "first":
        # ROW_NUMBER() ... ORDER BY ts ASC picks a NULL ts first (NULLS FIRST)
        hours = F.when(_count() > F.count("ts"), F.lit(None)).otherwise(F.max("hours_since_timestamp"))
    elif which == "last":
        # ... ORDER BY ts DESC puts NULL times last
        hours = F.min("hours_since_timestamp")
    else:
        raise ValueError(f"which must be 'first' or 'last', not {which!r}")
    first = history.groupBy("user_id").agg(hours.alias("latest_interact_hour"))
    # one aggregate per (user, brand) gives the ranking and, one step on, the totals
    per_brand = intent.groupBy("user_id", "brand").agg(
        *[F.sum(c).alias(c) for c in ("buy_count", "total_view_time", "click_count")])
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("buy_count").desc(), F.col("brand").asc()))
    per_user = per_brand.withColumn("_rank", rank).groupBy("user_id").agg(
        F.min(F.when(F.col("_rank") == 1, F.col("brand"))).alias("most_interest_brand"),
        F.min(F.when(F.col("_rank") == 2, F.col("brand"))).alias("second_interest_brand"),
        F.sum("total_view_time").alias("total_view_time"),
        F.sum("click_count").alias("click_count"),
        F.sum("buy_count").alias("total_buy"),
    )
    return first.join(per_user, "user_id").select(
        "user_id", "latest_interact_hour", "most_interest_brand", "second_interest_brand",
        "total_view_time", "click_count", "total_buy",
    )


# ---------------------------------------------------------------- top sellers

def top_sellers(orders: DataFrame, shoes: DataFrame) -> DataFrame:
    """``top_sell_product``: orders per shoe; orders of unknown shoes dropped."""
    per_product = orders.groupBy("product_id").agg(_count().alias("_n"))
    s = shoes
    return (
        per_product.join(s, per_product["product_id"] == s["id"])
        .groupBy(F.col("product_id").alias("shoes_id"), "brand", "sale_price", "rating")
        .agg(F.sum("_n").alias("total_sales"))
    )


def top_sellers_all_time(orders: DataFrame, customers: DataFrame, shoes: DataFrame) -> DataFrame:
    """``top_sell_product_all_time``: rows of ``orders_transction`` per shoe.

    Orders of unknown shoes form one NULL group.  Equal to grouping the
    ``transactions_v2`` rows, but the orders are counted per (customer, product)
    first and meet only the customers' key multiplicity, so the big side is
    aggregated before any shuffle and customer attributes never move.
    """
    per = orders.groupBy("customer_id", "product_id").agg(_count().alias("_n"))
    mult = key_multiplicity(customers, "id")
    weighted = per.join(mult, per["customer_id"] == mult["id"], "left").select(
        "product_id", (F.col("_n") * F.coalesce(F.col("mult"), F.lit(1))).alias("_w")
    )
    per_product = weighted.groupBy("product_id").agg(F.sum("_w").alias("_w"))
    s = shoes
    return (
        per_product.join(s, per_product["product_id"] == s["id"], "left")
        .groupBy(F.col("id").alias("shoes_id"), "brand", "name", "sale_price", "rating")
        .agg(F.sum("_w").alias("total_sales"))
    )


def top_sellers_from_transactions(transactions: DataFrame) -> DataFrame:
    """The same output as a plain view over ``transactions_v2``."""
    return transactions.groupBy("shoes_id", "brand", "name", "sale_price", "rating").agg(
        _count().alias("total_sales")
    )


def customer_order_history(orders: DataFrame, customers: DataFrame, shoes: DataFrame) -> DataFrame:
    """``customer_order_history``: rows of ``orders_transction`` per
    (order time, customer, product, brand, name).

    Orders are counted first; customers add only their key multiplicity."""
    per = orders.groupBy("ts", "customer_id", "product_id").agg(_count().alias("_n"))
    mult = key_multiplicity(customers, "id")
    weighted = per.join(mult, per["customer_id"] == mult["id"], "left").select(
        "ts", "customer_id", "product_id", (F.col("_n") * F.coalesce(F.col("mult"), F.lit(1))).alias("_w"))
    s = shoes.select("id", "brand", "name")
    return (
        weighted.join(s, weighted["product_id"] == s["id"], "left")
        .groupBy(F.col("ts").alias("shoe_orders_ts"), "customer_id", "product_id", "brand", "name")
        .agg(F.sum("_w").alias("bought_count"))
    )


# ---------------------------------------------------------------- recency

def clicks_within_days(history: DataFrame, as_of: AsOf = None, days: int = 7,
                       zone: str = REFERENCE_ZONE) -> DataFrame:
    """``click_within_week_view``: view time per (user, product) over clicks
    less than ``days`` whole days before ``as_of`` (later clicks included)."""
    recent = history.filter(within_days("ts", as_of_column(as_of, zone), days))
    return recent.groupBy("user_id", "product_id").agg(F.sum("view_time").alias("view_time"))


def recent_clicks(history: DataFrame, ts_col: str = "shoe_clickstream_ts", as_of: AsOf = None, minutes: int = 15,
                  zone: str = REFERENCE_ZONE) -> DataFrame:
    """``real_time_click_stream_15_minutes``: history rows with
    ``ts >= as_of - minutes`` (inclusive, no upper bound)."""
    return history.filter(since(ts_col, as_of_column(as_of, zone), minutes))


# ---------------------------------------------------------------- interval

def interactions_before_buy(orders: DataFrame, history: DataFrame, strict: bool = False) -> DataFrame:
    """``customer_interact_before_buy``.

    For every distinct order row (customer, order, product, ts): the clicks of
    the same customer on the same product with a time in [the customer's
    previous order of any product (1900-01-01 for the first), this order],
    both ends inclusive; summed per (customer, order).  Orders whose customer
    never clicked that product are absent; orders with only clicks outside the
    interval show 0.  ``history`` is the V2 click history (clicks joined to shoes).

    ``strict=True`` counts only clicks before the order's second, and leaves out orders
    without any, the notebook's commented filter ``order time > click time``.
    """
    # an order of an unknown (NULL) product still ends the interval of the next order
    placed = orders.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", "order_id", "product_id", "ts").distinct()
    intervals = previous_time(placed, ["customer_id"], "ts", ["order_id", "product_id"]).filter(
        F.col("product_id").isNotNull()).select(
        "customer_id", "order_id", "product_id",
        F.coalesce(truncate_to_second("prev_ts"), ntz_literal(EARLIEST)).alias("_lo"),
        truncate_to_second("ts").alias("_hi"),
    )
    clicks = history.filter(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("customer_id"),
        F.col("shoes_id").alias("product_id"),
        F.col("shoe_clickstream_ts").alias("_t"),
        F.lit(1).cast("long").alias("_n"),
        F.col("view_time").isNotNull().cast("long").alias("_nv"),
        F.coalesce(F.col("view_time"), F.lit(0)).cast("long").alias("_s"),
    )
    if strict:
        return _strictly_before(intervals, clicks)
    # _all: every joined click row of the pair, any time (NULL times too) --
    # it decides whether the order appears at all, and the NULL rule below
    per_order = interval_totals(intervals, clicks, ["customer_id", "product_id"], "_lo", "_hi", "_t",
                                ["_n", "_nv", "_s"], ["customer_id", "order_id"], "_all")
    # the reference sums view_time over in-interval rows and 0 elsewhere:
    # NULL only when every joined row is in the interval with a NULL view_time
    return per_order.filter(F.col("_all") > 0).select(
        "customer_id",
        "order_id",
        F.col("_n").alias("interact_count_before_buy"),
        F.when(F.col("_n") - F.col("_nv") == F.col("_all"), F.lit(None)).otherwise(F.col("_s"))
        .alias("view_duration_before_buy"),
    )


def _strictly_before(intervals: DataFrame, clicks: DataFrame) -> DataFrame:
    """Each order asks twice: for its interval, and for all time before it, which its joined rows fill."""
    end = F.col("_hi") - F.make_dt_interval(secs=F.lit(0.000001))
    asked = intervals.select("customer_id", "order_id", "product_id", F.inline(F.array(
        F.struct(F.lit(0).alias("_whole"), F.col("_lo"), end.alias("_hi")),
        F.struct(F.lit(1).alias("_whole"), ntz_literal(_dt.datetime.min).alias("_lo"), end.alias("_hi")))))
    totals = interval_totals(asked, clicks, ["customer_id", "product_id"], "_lo", "_hi", "_t", ["_n", "_nv", "_s"],
                             ["customer_id", "order_id", "_whole"], "_all")

    def of(measure: str, whole: int):
        return F.sum(F.when(F.col("_whole") == whole, F.col(measure)).otherwise(F.lit(0)))

    per_order = totals.groupBy("customer_id", "order_id").agg(
        of("_n", 0).alias("_n"), of("_nv", 0).alias("_nv"), of("_s", 0).alias("_s"), of("_n", 1).alias("_all"))
    return per_order.filter(F.col("_all") > 0).select(
        "customer_id", "order_id", F.col("_n").alias("interact_count_before_buy"),
        F.when(F.col("_n") - F.col("_nv") != F.col("_all"), F.col("_s")).alias("view_duration_before_buy"))


def customer_feature(interactions: DataFrame, history: DataFrame, customers: DataFrame,
                     rank_by: str = "average") -> DataFrame:
    """``customer_feature``: per customer the average view time per click
    before purchases (NULL when no such click), the two brands with the
    highest average view time per click (ties: brand ascending; ``rank_by=
    "count"`` ranks by number of clicks instead, as the column name suggests),
    and the customer's profile."""
    if rank_by not in ("average", "count"):
        raise ValueError(f"rank_by must be 'average' or 'count', not {rank_by!r}")
    before = interactions.groupBy("customer_id").agg(
        F.try_divide(F.sum("view_duration_before_buy"), F.sum("interact_count_before_buy")).alias(
            "avg_view_duration_before_buy"
        )
    )
    per_brand = history.groupBy("user_id", "brand").agg(
        (F.sum("view_time") / _count()).alias("average_view_duration"), _count().alias("view_count")
    )
    score = "average_view_duration" if rank_by == "average" else "view_count"
    top = top_n_columns(
        per_brand, "user_id", "brand",
        [F.col(score).desc(), F.col("brand").asc()],
        ["most_interaction_brand", "second_interaction_brand"],
    )
    c = customers.select(F.col("id").alias("_cid"), *CUSTOMER_PROFILE)
    joined = before.join(top, before["customer_id"] == top["user_id"], "left").join(
        c, F.col("customer_id") == F.col("_cid"), "left"
    )
    return joined.select(
        "customer_id", "avg_view_duration_before_buy", "user_id",
        "most_interaction_brand", "second_interaction_brand", *CUSTOMER_PROFILE,
    )
