"""Streaming bronze ingest.

``ingest(spark, messages, table, path)`` starts one query: parse -> normalise
-> (orders: dedup on ``order_id``) -> aggregate per payload -> sink.  The same
``shopflow.plans.bronze.bronze`` function is used as in batch, so a stream and
a batch over the same messages give the same rows (up to the arrival stamp).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.functions.columns import payload_columns
from shopflow.functions.times import REFERENCE_ZONE
from shopflow.plans.bronze import normalise_ts, parse, stamp_arrival
from shopflow.plans.bronze import bronze as bronze_rows
from shopflow.schemas import BRONZE, EVENT_TABLES
from shopflow.session import stream_checkpoint
from shopflow.streaming.sinks import write_append, write_complete, write_update


def bronze_stream(messages: DataFrame, table: str, zone: str = REFERENCE_ZONE, mode: str = "complete",
                  watermark: str | None = None, drop_malformed: bool = False, schema=None) -> DataFrame:
    """Streaming bronze rows of ``table``.

    ``complete`` / ``update``: unbounded state, every payload ever seen, each
    with its latest times.
    ``append``: every payload (for orders: every order id) once, as first seen.  Without
    ``watermark`` nothing is forgotten and nothing is lost.  With one, state is
    bounded, and rows that arrive later than it behind the newest event time are
    DROPPED, new ones too.
    """
    if mode in ("complete", "update"):
        return bronze_rows(messages, table, zone=zone, arrival="processing", drop_malformed=drop_malformed,
                           schema=schema)
    if mode != "append":
        raise ValueError(f"mode must be 'complete', 'update' or 'append', not {mode!r}")
    df = normalise_ts(parse(messages, table, drop_malformed, schema), table, zone)
    df = stamp_arrival(df, table, "processing").drop("_sent")
    columns = BRONZE[table].fieldNames()
    # an order's payload contains its id: one step on the id covers both
    key = ["order_id"] if table == "shoe_orders" else payload_columns(columns)
    if watermark is None:
        return df.dropDuplicates(key).select(*columns)
    event_col = "ts" if table in EVENT_TABLES else "arrive_dt"
    # watermarks need a TIMESTAMP column; the NTZ reading is only used for ordering
    timed = df.withColumn("_event_time", F.col(event_col).cast("timestamp")).withWatermark("_event_time", watermark)
    return timed.dropDuplicatesWithinWatermark(key).select(*columns)


def ingest(spark: SparkSession, messages: DataFrame, table: str, path: str | None = None,
           checkpoint: str | None = None, trigger: str | None = "availableNow", mode: str = "complete",
           zone: str = REFERENCE_ZONE, watermark: str | None = None, query_name: str | None = None,
           sink_table: str | None = None, fmt: str = "parquet", drop_malformed: bool = False,
           schema=None) -> StreamingQuery:
    """Start the ingest query of ``table`` writing to ``path`` or to the
    catalog table ``sink_table`` (``update`` mode: to ``path`` only).

    ``schema`` parses the JSON with other columns than the built-in ones, e.g. the sink's own
    (``catalog.wire_schema_of``).  ``checkpoint`` defaults to a folder of the table, mode
    and sink below ``<spark.checkpoint.dir>/streams``; a restart on the same checkpoint
    resumes without re-adding processed input.
    """
    sink = hashlib.sha256((sink_table or path or "").encode()).hexdigest()[:12]
    ckpt = checkpoint or stream_checkpoint(spark, f"{table}-{mode}-{sink}")
    rows = bronze_stream(messages, table, zone=zone, mode=mode, watermark=watermark,
                         drop_malformed=drop_malformed, schema=schema)
    if mode == "complete":
        return write_complete(rows, path, ckpt, trigger, fmt, query_name, sink_table)
    if mode == "update":
        if path is None or sink_table:
            raise ValueError("update mode writes to a path")
        return write_update(rows, path, ckpt, trigger, fmt, query_name)
    return write_append(rows, path, ckpt, trigger, fmt, query_name, sink_table)


def stop_all(spark: SparkSession) -> int:
    """Stop every active stream of the session and wait for each to end."""
    stopped = 0
    for q in spark.streams.active:
        q.stop()
        q.awaitTermination()
        stopped += 1
    return stopped
