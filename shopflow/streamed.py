"""Outputs of the driver's tables that come through streams: the wire messages are replayed as files.

Each function writes the messages below the shared folder, runs the stream to the end of what is there
(``availableNow``) and returns what its sink holds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow import fixtures as fx
from shopflow.plans.bronze import normalise_ts, parse
from shopflow.schemas import BRONZE
from shopflow.session import scratch_path
from shopflow.sources.catalog import create_bronze_tables, wire_schema_of
from shopflow.sources.keyindex import lookup_clustered, write_clustered
from shopflow.sources.replay import read_messages, write_messages
from shopflow.streaming.ingest import ingest
from shopflow.streaming.live import read_recent_clicks, watch_recent_clicks
from shopflow.streaming.once import read_once, write_once
from shopflow.streaming.reconcile import watch_missing
from shopflow.streaming.sinks import read_current, read_updates


def _replay(spark: SparkSession, sf_dir: str, table: str, at: str, files_per_batch: int | None = None) -> DataFrame:
    write_messages(fx.wire(spark, sf_dir, table), f"{at}/messages")
    return read_messages(spark, f"{at}/messages", files_per_batch)


def live_recent_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15-minute monitor's view at the time of the newest click."""
    at = scratch_path(spark, "live")
    rows = normalise_ts(parse(_replay(spark, sf_dir, "shoe_clickstream", at, 2), "shoe_clickstream"), "shoe_clickstream", "UTC")
    clicks = rows.withColumn("arrive_dt", F.col("ts")).select(*BRONZE["shoe_clickstream"].fieldNames())
    watch_recent_clicks(clicks, fx.shoes(spark, sf_dir), f"{at}/view", f"{at}/checkpoint",
                        trigger="availableNow").awaitTermination()
    newest = fx.clicks(spark, sf_dir).agg(F.max("ts")).first()[0]
    return read_recent_clicks(spark, f"{at}/view", newest)


def missing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that came on the stream and are not in the stored copy."""
    at = scratch_path(spark, "missing")
    rows = parse(_replay(spark, sf_dir, "shoe_orders", at, 2), "shoe_orders")
    watch_missing(rows, lambda s: fx.stored_orders(s, sf_dir), "order_id", f"{at}/open", f"{at}/checkpoint",
                  trigger="availableNow").awaitTermination()
    return read_current(spark, f"{at}/open")


def orders_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order by its first message, appended once."""
    at = scratch_path(spark, "once")
    rows = normalise_ts(parse(_replay(spark, sf_dir, "shoe_orders", at), "shoe_orders"), "shoe_orders").drop("_sent")
    write_once(rows, "order_id", f"{at}/orders", f"{at}/checkpoint", ["ts"]).awaitTermination()
    return read_once(spark, f"{at}/orders")


def complete_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The DDL's table filled by a complete-mode stream that parses with the table's own schema; without its arrival stamp."""
    at = scratch_path(spark, "complete")
    database = f"shopflow_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{at}/database'")
    create_bronze_tables(spark, database)
    sink = f"{database}.{table}"
    ingest(spark, _replay(spark, sf_dir, table if table != "shoes_test" else "shoes", at, 4), table, sink_table=sink,
           checkpoint=f"{at}/checkpoint", schema=wire_schema_of(spark, sink)).awaitTermination()
    return spark.table(sink).drop("arrive_dt")


def updated_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze clicks by an update-mode stream, without the arrival stamp."""
    at = scratch_path(spark, "update")
    ingest(spark, _replay(spark, sf_dir, "shoe_clickstream", at, 2), "shoe_clickstream", f"{at}/clicks",
           checkpoint=f"{at}/checkpoint", mode="update").awaitTermination()
    return read_updates(spark, f"{at}/clicks").drop("arrive_dt")


def appended_shoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze shoes by an append-mode stream, without the arrival stamp."""
    at = scratch_path(spark, "append")
    ingest(spark, _replay(spark, sf_dir, "shoes", at), "shoes", f"{at}/shoes", checkpoint=f"{at}/checkpoint",
           mode="append").awaitTermination()
    return spark.read.parquet(f"{at}/shoes").drop("arrive_dt")


def clustered_lookup(spark: SparkSession, sf_dir: str, order_id: int, files: int = 16) -> DataFrame:
    """One order from a table of orders clustered by id."""
    at = scratch_path(spark, "clustered")
    write_clustered(fx.orders(spark, sf_dir), at, "order_id", files)
    return lookup_clustered(spark, at, "order_id", order_id)
