"""Driver test tables -> bronze-shaped tables (mapping documented in FIXTURES.md).

Whole tables are used; nothing is filtered by id.  Each user meets 16 products of
the whole ``part`` domain, which grows with the users.  Some products are unknown, some
NULL, some users NULL; some orders fall on one second; some shoes have two
prices; some order messages are sent again with another product.  Event times are UTC wall-clock
readings (``TIMESTAMP_NTZ``).
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.times import epoch_micros, ntz_literal, truncate_to_second
from shopflow.session import scratch_path

#: fixed values of the mapping: products per user and between users, and the values of
#: ``props.k`` that stand for an unknown product, a NULL product and a NULL user
PER_USER, STEP = 16, 13
UNKNOWN_PRODUCT, NULL_PRODUCT, NULL_USER = 97, 98, 99
#: every so many part keys a shoe has a second price; orders of every so many k share a second
TWO_PRICES, SAME_SECOND, SENT_AGAIN = 50, 7, 10
IP_HOSTS = 250
DIM_ARRIVAL = _dt.datetime(2024, 1, 1)
#: reference time of the recency queries
AS_OF = _dt.datetime(2024, 1, 31)
#: a second one, with events before and after it
AS_OF_INSIDE = _dt.datetime(2024, 1, 15)
#: what a stored copy of the orders held
STORED_UNTIL = _dt.datetime(2024, 1, 25)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _product() -> Column:
    own = (F.col("user_id") * STEP + _k() % PER_USER).cast("string")
    return F.when(_k() == UNKNOWN_PRODUCT, F.concat(F.lit("u"), F.col("user_id").cast("string"))).when(
        _k() != NULL_PRODUCT, own)


def _user() -> Column:
    return F.when(_k() != NULL_USER, F.col("user_id").cast("string"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shoe_clickstream`` from the view/click events."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("view", "click"))
    sec = truncate_to_second("ts")
    return ev.select(
        _product().alias("product_id"),
        _user().alias("user_id"),
        F.floor("value").cast("int").alias("view_time"),
        F.concat(F.lit("/product/"), _product()).alias("page_url"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % IP_HOSTS).cast("string")).alias("ip"),
        sec.alias("ts"),
        sec.alias("arrive_dt"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shoe_orders`` from the purchase events."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    sec = truncate_to_second("ts")
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    return ev.select(
        F.col("event_id").alias("order_id"),
        _product().alias("product_id"),
        _user().alias("customer_id"),
        F.when(_k() % SAME_SECOND == 0, day).otherwise(sec).alias("ts"),
        sec.alias("arrive_dt"),
    )


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of the orders up to ``STORED_UNTIL`` (written, then read back)."""
    path = scratch_path(spark, "stored")
    held = orders(spark, sf_dir).filter(F.col("arrive_dt") < ntz_literal(STORED_UNTIL))
    held.write.parquet(path)
    return spark.read.parquet(path)


def shoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shoes`` from ``part``."""
    part = table(spark, sf_dir, "part")
    price = F.floor("p_retailprice").cast("int")
    # a shoe whose price changed has a row for each price
    prices = F.when(F.col("p_partkey") % TWO_PRICES == 0, F.array(price, price + 5)).otherwise(F.array(price))
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
        F.explode(prices).alias("sale_price"),
        ((F.col("p_size") % 5) + 1).cast("double").alias("rating"),
        ntz_literal(DIM_ARRIVAL).alias("arrive_dt"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customers`` from ``customer`` + ``nation`` + ``region``."""
    # nation and region are small code lists: left to the size-based join choice
    geo = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"),
        F.col("n_regionkey") == F.col("r_regionkey"),
        "left",
    )
    c = table(spark, sf_dir, "customer").join(
        geo, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    cid = F.col("c_custkey").cast("string")
    none = F.lit(None).cast("string")
    return c.select(
        cid.alias("id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(cid, F.lit("@example.com")).alias("email"),
        none.alias("phone"),
        none.alias("street_address"),
        F.col("n_name").alias("state"),
        F.lpad(cid, 5, "0").alias("zip_code"),
        F.col("r_name").alias("country"),
        F.upper(F.substring("n_name", 1, 2)).alias("country_code"),
        ntz_literal(DIM_ARRIVAL).alias("arrive_dt"),
    )


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "shoe_clickstream": clicks(spark, sf_dir),
        "shoe_orders": orders(spark, sf_dir),
        "shoes": shoes(spark, sf_dir),
        "customers": customers(spark, sf_dir),
    }


# --------------------------------------------------------------------------
# wire form: the same rows as Kafka-like messages (key, value, topic, timestamp)
# --------------------------------------------------------------------------

def _epoch_millis(ntz: Column) -> Column:
    return F.floor(epoch_micros(ntz) / F.lit(1000)).cast("long")


def _key_bytes(n: Column) -> Column:
    """8-byte big-endian key of a non-negative BIGINT."""
    return F.unhex(F.lpad(F.hex(n), 16, "0"))


def _message(df: DataFrame, key: Column, topic: str, sent: Column) -> DataFrame:
    payload = F.struct(*[F.col(c) for c in df.columns if c not in ("_key", "_sent")])
    return df.select(
        key.alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.timestamp_micros(epoch_micros(sent)).alias("timestamp"),
    )


def wire(spark: SparkSession, sf_dir: str, table_name: str) -> DataFrame:
    """Messages as a Kafka source would deliver them for ``table_name``.

    Event tables carry ``ts`` as epoch milliseconds with the original
    sub-second digits; the message time is the event time.  Some orders are sent
    again an hour later with another product; the first message counts.
    """
    if table_name in ("shoe_clickstream", "shoe_orders"):
        types = ("view", "click") if table_name == "shoe_clickstream" else ("purchase",)
        ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin(*types))
        if table_name == "shoe_clickstream":
            body = ev.select(
                _product().alias("product_id"),
                _user().alias("user_id"),
                F.floor("value").cast("int").alias("view_time"),
                F.concat(F.lit("/product/"), _product()).alias("page_url"),
                F.concat(F.lit("10.0.0."), (F.col("user_id") % IP_HOSTS).cast("string")).alias("ip"),
                _epoch_millis(F.col("ts")).alias("ts"),
                F.col("event_id").alias("_key"),
                F.col("ts").alias("_sent"),
            )
        else:
            later = F.timestamp_add("HOUR", F.lit(1), F.col("ts"))
            first = F.struct(_product().alias("product_id"), F.col("ts"))
            again = F.struct(F.lit("again").alias("product_id"), later.alias("ts"))
            sent = F.when(_k() % SENT_AGAIN == 3, F.array(first, again)).otherwise(F.array(first))
            body = ev.select("event_id", _user().alias("customer_id"), F.inline(sent)).select(
                F.col("event_id").alias("order_id"),
                "product_id",
                "customer_id",
                _epoch_millis(F.col("ts")).alias("ts"),
                F.col("event_id").alias("_key"),
                F.col("ts").alias("_sent"),
            )
        return _message(body, _key_bytes(F.col("_key")), table_name, F.col("_sent"))
    dims = {"shoes": shoes, "shoes_test": shoes, "customers": customers}
    body = dims[table_name](spark, sf_dir).drop("arrive_dt")
    body = body.withColumn("_key", F.col("id").cast("bigint")).withColumn("_sent", ntz_literal(DIM_ARRIVAL))
    key = _key_bytes(F.col("_key"))
    if table_name == "customers":  # keys longer than a BIGINT
        key = F.concat(F.unhex(F.lit("01")), key)
    return _message(body, key, table_name, F.col("_sent"))
