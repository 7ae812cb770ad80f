"""Bronze layer: messages -> clean bronze rows.

``bronze(raw, table)`` works on a batch DataFrame of messages and on a
streaming one (Kafka or file replay) alike:

parse JSON -> normalise times -> (orders: one row per order id) ->
one row per distinct payload with the latest ``ts`` / ``arrive_dt``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.columns import payload_columns
from shopflow.functions.times import REFERENCE_ZONE, from_epoch_millis, now_in_zone
from shopflow.operators.dedup import first_by_key, latest_by_payload
from shopflow.schemas import BRONZE, EVENT_TABLES, wire_schema

#: zone of the arrival stamp per table, as in the reference: shifted for the
#: event tables and the smoke table, session clock (UTC) for the dimensions
ARRIVAL_ZONE = {
    "shoe_clickstream": REFERENCE_ZONE,
    "shoe_orders": REFERENCE_ZONE,
    "shoes_test": REFERENCE_ZONE,
    "shoes": "UTC",
    "customers": "UTC",
}


def parse(raw: DataFrame, table: str, drop_malformed: bool = False, schema=None) -> DataFrame:
    """``value`` bytes -> typed payload columns (+ ``_sent``, the message time).

    Malformed JSON and tombstones give an all-NULL payload (``from_json``
    PERMISSIVE), which the dedup step folds into one all-NULL row, as in the
    reference; ``drop_malformed=True`` removes them instead.  ``schema``
    overrides the built-in wire schema (e.g. ``catalog.wire_schema_of``).
    """
    schema = schema or wire_schema(table)
    sent = F.col("timestamp") if "timestamp" in raw.columns else F.lit(None).cast("timestamp")
    df = raw.select(
        F.from_json(F.col("value").cast("string"), schema).alias("_data"), sent.alias("_sent")
    ).select("_data.*", "_sent")
    if drop_malformed:
        df = df.filter(F.greatest(*[F.col(c).isNotNull() for c in schema.fieldNames()]))
    return df


def normalise_ts(parsed: DataFrame, table: str, zone: str = REFERENCE_ZONE) -> DataFrame:
    """Event ``ts``: epoch ms -> whole-second wall clock in ``zone``."""
    return parsed.withColumn("ts", from_epoch_millis("ts", zone)) if table in EVENT_TABLES else parsed


def stamp_arrival(df: DataFrame, table: str, arrival: str = "processing", arrival_zone: str | None = None) -> DataFrame:
    """``arrive_dt``: the processing time (``arrival="processing"``, fixed per
    micro-batch) or the message time (``arrival="message"``, reproducible),
    as a whole-second wall clock in ``arrival_zone``."""
    az = arrival_zone or ARRIVAL_ZONE[table]
    if arrival == "message":
        stamp = from_epoch_millis(F.unix_millis(F.col("_sent")), az)
    elif arrival == "processing":
        stamp = now_in_zone(az)
    else:
        raise ValueError(f"arrival must be 'processing' or 'message', not {arrival!r}")
    return df.withColumn("arrive_dt", stamp)


def bronze(raw: DataFrame, table: str, zone: str = REFERENCE_ZONE, arrival: str = "processing",
           arrival_zone: str | None = None, drop_malformed: bool = False, schema=None) -> DataFrame:
    """Bronze rows of ``table`` from Kafka-shaped messages (batch or stream)."""
    df = normalise_ts(parse(raw, table, drop_malformed, schema), table, zone)
    if table == "shoe_orders":
        # one row per order id; the stream keeps the first arrival, a batch the
        # earliest message (then the smallest payload) so re-runs agree
        df = first_by_key(df, ["order_id"], ["_sent", "ts", "product_id", "customer_id"])
    df = stamp_arrival(df, table, arrival, arrival_zone)
    df = df.drop("_sent")
    columns = BRONZE[table].fieldNames()
    latest = ["ts", "arrive_dt"] if table in EVENT_TABLES else ["arrive_dt"]
    out = latest_by_payload(df, payload_columns(columns), latest)
    return out.select(*columns)
