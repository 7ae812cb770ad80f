"""Silver layer: enriched history tables.

Inputs are bronze-shaped DataFrames (``shopflow.schemas``); ``as_of`` is the
reference time of the recency columns (``None`` = now, as a wall clock in ``zone``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.columns import prefixed_columns
from shopflow.functions.times import REFERENCE_ZONE, AsOf, as_of_column, month_key, recency_columns


def click_history_v1(clicks: DataFrame, as_of: AsOf = None,
                     zone: str = REFERENCE_ZONE) -> DataFrame:
    """First-generation ``cust_click_stream_history``: every click (orphan
    products kept) plus hours / days / months since the click."""
    ref = as_of_column(as_of, zone)
    return clicks.select(*clicks.columns, *recency_columns("ts", ref))


def click_history_v2(clicks: DataFrame, shoes: DataFrame, as_of: AsOf = None,
                     zone: str = REFERENCE_ZONE) -> DataFrame:
    """Second-generation ``cust_click_stream_history``: clicks joined to their
    shoe (inner), ``arrive_dt`` dropped, ``ts``/``id`` renamed with the table
    prefix, plus the recency columns."""
    ref = as_of_column(as_of, zone)
    cs = clicks.alias("cs")
    s = shoes.alias("s")
    cols = prefixed_columns("cs", clicks.columns, "shoe_clickstream", exclude=["arrive_dt"]) + prefixed_columns(
        "s", shoes.columns, "shoes", exclude=["arrive_dt"]
    )
    joined = cs.join(s, F.col("cs.product_id") == F.col("s.id"), "inner")
    return joined.select(*cols, *recency_columns(F.col("cs.ts"), ref))


def _star(orders: DataFrame, customers: DataFrame, shoes: DataFrame) -> DataFrame:
    """orders LEFT JOIN customers LEFT JOIN shoes (unmatched dimensions -> NULLs).

    Both dimensions go through Spark's size-based join choice: the shoe
    catalogue is small and gets broadcast; ``customers`` grows with the
    business and, once over the threshold, becomes a sort-merge join on
    customer id, with AQE splitting a hot customer's partition of the orders
    side.
    """
    so, cs, c = orders.alias("so"), customers.alias("cs"), shoes.alias("c")
    return so.join(cs, F.col("so.customer_id") == F.col("cs.id"), "left").join(
        c, F.col("so.product_id") == F.col("c.id"), "left"
    )


def transactions_v1(orders: DataFrame, customers: DataFrame, shoes: DataFrame) -> DataFrame:
    """First-generation ``transction_orders``: fixed prefixes, arrival stamps kept."""
    cols = (
        prefixed_columns("so", orders.columns, "orders")
        + prefixed_columns("cs", customers.columns, "customers")
        + prefixed_columns("c", shoes.columns, "shoes")
    )
    return _star(orders, customers, shoes).select(*cols, month_key("so.ts").alias("orders_ts_month"))


def transactions_v2(orders: DataFrame, customers: DataFrame, shoes: DataFrame) -> DataFrame:
    """Second-generation ``orders_transction``: table-name prefixes, no arrival stamps."""
    cols = (
        prefixed_columns("so", orders.columns, "shoe_orders", exclude=["arrive_dt"])
        + prefixed_columns("cs", customers.columns, "customers", exclude=["arrive_dt"])
        + prefixed_columns("c", shoes.columns, "shoes", exclude=["arrive_dt"])
    )
    return _star(orders, customers, shoes).select(*cols, month_key("so.ts").alias("orders_ts_month"))
