"""Materialise the silver and gold outputs as catalog tables and views.

The reference builds each output with ``CREATE OR REPLACE TABLE ... AS`` (or a
view) over the bronze tables; ``build_tables`` does the same from bronze
DataFrames: silver tables are written first and the gold outputs read them
back, so every gold query starts from stored rows (a lineage cut) rather than
re-running the silver joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.functions.times import REFERENCE_ZONE, AsOf, as_of_column
from shopflow.plans import gold, silver
from shopflow.sources.catalog import persistent_view, snapshot, view

# output names of our own
CLICK_HISTORY_V1 = "cust_click_stream_history_v1"
INTEREST_PROFILE = "customer_interest_profile"
# fixed values: output names users query today, in build order
CLICK_HISTORY = "cust_click_stream_history"
TRANSACTIONS_V1 = "transction_orders"
TRANSACTIONS = "orders_transction"
INTENT_HISTORY = "cust_intent_history"
INTERACT_BEFORE_BUY = "customer_interact_before_buy"
CUSTOMER_FEATURE = "customer_feature"
TOP_SELL = "top_sell_product"
TOP_SELL_ALL_TIME = "top_sell_product_all_time"
ORDER_HISTORY = "customer_order_history"
CLICK_WITHIN_WEEK = "click_within_week_view"
RECENT_CLICKS = "real_time_click_stream_15_minutes"


def build_tables(
    spark: SparkSession,
    bronze: dict[str, DataFrame],
    as_of: AsOf = None,
    database: str | None = None,
    fmt: str = "parquet",
    zone: str = REFERENCE_ZONE,
) -> dict[str, DataFrame]:
    """Write the silver tables and gold tables, register the gold views.

    ``bronze`` maps ``shoe_clickstream``, ``shoe_orders``, ``shoes`` and
    ``customers`` to DataFrames; orders and shoes are stored anew on every call, under names of our
    own, since a permanent view reads them, unless the frame is the catalog table of its name.  The sales and order views are
    permanent, the others, which hang on the reference time, are temporary.
    ``as_of=None`` is now, as a wall clock in ``zone``, the zone of the event
    times.  Returns name -> DataFrame (tables read back).
    """
    q = (lambda n: f"{database}.{n}") if database else (lambda n: n)
    if as_of is None:
        as_of = as_of_column(None, zone)
    clicks, orders = bronze["shoe_clickstream"], bronze["shoe_orders"]
    shoes, customers = bronze["shoes"], bronze["customers"]
    out: dict[str, DataFrame] = {}

    def table(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        out[name] = snapshot(df, q(name), fmt, partition_by=partition_by)
        return out[name]

    # silver
    h1 = table(CLICK_HISTORY_V1, silver.click_history_v1(clicks, as_of))
    h2 = table(CLICK_HISTORY, silver.click_history_v2(clicks, shoes, as_of))
    table(TRANSACTIONS_V1, silver.transactions_v1(orders, customers, shoes))
    table(TRANSACTIONS, silver.transactions_v2(orders, customers, shoes), partition_by=["orders_ts_month"])
    # gold tables
    intent = table(INTENT_HISTORY, gold.intent_history(h1, orders, shoes))
    inter = table(INTERACT_BEFORE_BUY, gold.interactions_before_buy(orders, h2))
    table(CUSTOMER_FEATURE, gold.customer_feature(inter, h2, customers))
    # gold views (re-planned on every read)
    temporary = {
        INTEREST_PROFILE: gold.interest_profile(h1, intent),
        CLICK_WITHIN_WEEK: gold.clicks_within_days(h1, as_of, 7),
        RECENT_CLICKS: gold.recent_clicks(h2, "shoe_clickstream_ts", as_of, 15),
    }
    for name, df in temporary.items():
        out[name] = view(df, name)
    stored = {name: q(name) for name in ("shoe_orders", "shoes")}
    for name, at in stored.items():
        if not (spark.catalog.tableExists(at) and bronze[name].sameSemantics(spark.table(at))):
            stored[name] = q(f"{TOP_SELL}_{name}")
            snapshot(bronze[name], stored[name], fmt)
    shoe = "shoes_id, brand, name, sale_price, rating"
    bought = "shoe_orders_ts, customer_id, product_id, brand, name"
    permanent = {
        TOP_SELL: f"""SELECT product_id AS shoes_id, brand, sale_price, rating, count(*) AS total_sales
                      FROM {stored["shoe_orders"]} JOIN {stored["shoes"]} ON product_id = id
                      GROUP BY product_id, brand, sale_price, rating""",
        TOP_SELL_ALL_TIME: f"SELECT {shoe}, count(*) AS total_sales FROM {q(TRANSACTIONS)} GROUP BY {shoe}",
        ORDER_HISTORY: f"SELECT {bought}, count(*) AS bought_count FROM {q(TRANSACTIONS)} GROUP BY {bought}",
    }
    for name, sql in permanent.items():
        out[name] = persistent_view(spark, q(name), sql)
    return out
