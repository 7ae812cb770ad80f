"""Table schemas.

Bronze tables follow the reference DDL column for column.  Two deliberate
changes, both for correctness at scale:

* event times (``ts``, ``arrive_dt``) are ``TIMESTAMP_NTZ``: the stored value is
  a wall-clock reading in a configurable zone (see ``functions.times``), which
  is exactly what a timestamp without time zone models;
* ``order_id`` is ``BIGINT``: order ids of a large shop overflow 32 bits.

Wire schemas describe the JSON inside the Kafka ``value``.  ``ts`` is declared
``BIGINT`` (epoch milliseconds) instead of being read as a timestamp and cast
back, which the reference does.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


SHOES = _struct(
    ("id", StringType()),
    ("brand", StringType()),
    ("name", StringType()),
    ("sale_price", IntegerType()),
    ("rating", DoubleType()),
    ("arrive_dt", TimestampNTZType()),
)

CUSTOMERS = _struct(
    ("id", StringType()),
    ("first_name", StringType()),
    ("last_name", StringType()),
    ("email", StringType()),
    ("phone", StringType()),
    ("street_address", StringType()),
    ("state", StringType()),
    ("zip_code", StringType()),
    ("country", StringType()),
    ("country_code", StringType()),
    ("arrive_dt", TimestampNTZType()),
)

SHOE_CLICKSTREAM = _struct(
    ("product_id", StringType()),
    ("user_id", StringType()),
    ("view_time", IntegerType()),
    ("page_url", StringType()),
    ("ip", StringType()),
    ("ts", TimestampNTZType()),
    ("arrive_dt", TimestampNTZType()),
)

SHOE_ORDERS = _struct(
    ("order_id", LongType()),
    ("product_id", StringType()),
    ("customer_id", StringType()),
    ("ts", TimestampNTZType()),
    ("arrive_dt", TimestampNTZType()),
)

#: bronze table name -> schema (``shoes_test`` is the smoke-test twin of ``shoes``)
BRONZE = {
    "shoes": SHOES,
    "shoes_test": SHOES,
    "customers": CUSTOMERS,
    "shoe_clickstream": SHOE_CLICKSTREAM,
    "shoe_orders": SHOE_ORDERS,
}

#: bronze tables whose ``ts`` arrives as epoch milliseconds on the wire
EVENT_TABLES = ("shoe_clickstream", "shoe_orders")


def wire_schema(table: str) -> StructType:
    """JSON schema of one message for ``table``: payload columns only.

    ``arrive_dt`` is stamped on arrival and never read from the message;
    ``ts`` is epoch milliseconds (BIGINT) for the event tables.
    """
    fields = []
    for f in BRONZE[table].fields:
        if f.name == "arrive_dt":
            continue
        if f.name == "ts":
            fields.append(StructField("ts", LongType(), True))
        else:
            fields.append(StructField(f.name, f.dataType, True))
    return StructType(fields)


#: columns of a Kafka source row that the pipeline uses
KAFKA_ROW = _struct(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("timestamp", TimestampType()),
)
