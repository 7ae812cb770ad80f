"""Rows behind the interaction counts, sessions and conversions of clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.times import EARLIEST, ntz_literal, truncate_to_second
from shopflow.operators.interval import previous_time
from shopflow.operators.matching import global_previous, interval_rows, next_event


def interaction_rows(orders: DataFrame, history: DataFrame, previous: str = "customer",
                     customer_id: str | None = None) -> DataFrame:
    """The clicks that ``interactions_before_buy`` counts: one row per order row and click in its interval.

    The interval goes from the previous order to this one, both ends inclusive: the customer's own
    (``previous="customer"``) or, as in the notebook's debugging query, that of anybody (``"anyone"``: an unpartitioned LAG
    over the distinct customer, order and time).  ``customer_id`` keeps one customer, after the intervals are made.
    ``history`` is the V2 click history.
    """
    clicks = history.select(F.col("user_id").alias("customer_id"), F.col("shoes_id").alias("product_id"),
                            "shoe_clickstream_ts", "view_time")
    if previous == "customer":
        placed = orders.filter(F.col("customer_id").isNotNull()).select(
            "customer_id", "order_id", "product_id", "ts").distinct()
        timed = previous_time(placed, ["customer_id"], "ts", ["order_id", "product_id"], "prev_odr_ts")
    elif previous == "anyone":
        placed = orders.select("customer_id", "order_id", "ts").distinct()
        timed = global_previous(placed, ["ts", "customer_id", "order_id"], "ts", "prev_odr_ts")
        of = ["customer_id", "order_id", "ts"]
        sold = orders.select("product_id", *[F.col(c).alias(f"_{c}") for c in of]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in of]
        timed = timed.join(sold, same[0] & same[1] & same[2]).drop(*[f"_{c}" for c in of])
    else:
        raise ValueError(f"previous must be 'customer' or 'anyone', not {previous!r}")
    if customer_id is not None:
        timed = timed.filter(F.col("customer_id") == customer_id)
        clicks = clicks.filter(F.col("customer_id") == customer_id)
    intervals = timed.select(
        "customer_id", "order_id", "product_id", truncate_to_second("ts").alias("ts"),
        truncate_to_second("prev_odr_ts").alias("prev_odr_ts"),
        F.coalesce(truncate_to_second("prev_odr_ts"), ntz_literal(EARLIEST)).alias("_lo"))
    return interval_rows(intervals, clicks, ["customer_id", "product_id"], "_lo", "ts", "shoe_clickstream_ts").drop("_lo")


def click_sessions(clicks: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Per user, runs of clicks that follow each other within less than ``gap``: start, last click, clicks, view time.

    ``clicks`` may be a stream with a watermark on ``ts``.  Clicks without user or time are in no session.
    """
    known = clicks.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    found = known.groupBy("user_id", F.session_window("ts", gap).alias("session")).agg(
        F.max("ts").alias("session_last"), F.count(F.lit(1)).alias("clicks"),
        F.sum(F.coalesce("view_time", F.lit(0))).alias("view_time"))
    return found.select("user_id", F.col("session.start").alias("session_start"), "session_last", "clicks", "view_time")


def click_conversions(clicks: DataFrame, orders: DataFrame) -> DataFrame:
    """Every click of a known user on a known product with the user's next order of it, at or after the click."""
    known = F.col("user_id").isNotNull() & F.col("product_id").isNotNull()
    asked = clicks.filter(known).select("user_id", "product_id", "view_time", "ts")
    bought = orders.select(F.col("customer_id").alias("user_id"), "product_id", "ts", "order_id").filter(known)
    found = next_event(asked, bought, ["user_id", "product_id"], "ts", ["order_id"], "next")
    return found.select("user_id", "product_id", "view_time", "ts", F.col("next.order_id").alias("order_id"),
                        F.col("next.ts").alias("order_ts"))


def product_conversion(clicks: DataFrame, orders: DataFrame, within_hours: int = 168) -> DataFrame:
    """Per product: clicks, and clicks that an order of it by the same user followed within the hours."""
    found = click_conversions(clicks, orders)
    soon = F.col("order_ts") <= F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(within_hours))
    return found.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("clicks"), F.count(F.when(soon, 1)).alias("converted"))
