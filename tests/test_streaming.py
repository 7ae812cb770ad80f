"""Streaming ingest: file replay source, availableNow, complete sink, restart."""

import os

from shopflow import fixtures as fx
from shopflow.plans.bronze import bronze
from shopflow.sources.versions import pointer
from shopflow.sources.replay import read_messages, write_messages
from shopflow.streaming.ingest import ingest, stop_all
from shopflow.streaming.sinks import read_current, read_updates, trigger_kwargs, write_memory

from .conftest import SF_SMALL


def _cmp_cols(df):
    return df.drop("arrive_dt")


def test_stream_equals_batch_and_restart_adds_nothing(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    wire = fx.wire(spark, SF_SMALL, "shoe_clickstream")
    write_messages(wire, src)
    q = ingest(spark, read_messages(spark, src), "shoe_clickstream", out, checkpoint=ckpt)
    q.awaitTermination()
    first = read_current(spark, out)
    batch = bronze(wire, "shoe_clickstream", arrival="message")
    assert _cmp_cols(first).exceptAll(_cmp_cols(batch)).count() == 0
    assert _cmp_cols(batch).exceptAll(_cmp_cols(first)).count() == 0
    n = first.count()
    # restart on the same checkpoint with no new input: same table
    q = ingest(spark, read_messages(spark, src), "shoe_clickstream", out, checkpoint=ckpt)
    q.awaitTermination()
    assert read_current(spark, out).count() == n
    # a replayed slice (duplicates only) changes nothing either
    write_messages(wire.limit(50), src)
    q = ingest(spark, read_messages(spark, src), "shoe_clickstream", out, checkpoint=ckpt)
    q.awaitTermination()
    assert read_current(spark, out).count() == n


def test_orders_stream_dedups_and_append_mode(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    wire = fx.wire(spark, SF_SMALL, "shoe_orders")
    write_messages(wire, src)
    write_messages(wire, src)  # every order delivered twice
    q = ingest(spark, read_messages(spark, src, max_files_per_trigger=1), "shoe_orders", out, checkpoint=ckpt)
    q.awaitTermination()
    got = read_current(spark, out)
    n = wire.select("key").distinct().count()
    assert got.count() == got.select("order_id").distinct().count() == n
    out2, ckpt2 = os.path.join(scratch, "out2"), os.path.join(scratch, "ckpt2")
    q = ingest(spark, read_messages(spark, src), "shoe_orders", out2, checkpoint=ckpt2, mode="append")
    q.awaitTermination()
    assert spark.read.parquet(out2).select("order_id").distinct().count() == n


def test_memory_preview_and_stop_all(spark, scratch):
    src = os.path.join(scratch, "src")
    write_messages(fx.wire(spark, SF_SMALL, "shoes"), src)
    rows = bronze(read_messages(spark, src), "shoes")
    q = write_memory(rows, "shoes_preview")
    q.processAllAvailable()
    assert spark.table("shoes_preview").count() > 0
    assert stop_all(spark) >= 1
    assert not spark.streams.active


def test_streaming_temp_view(spark, scratch):
    from shopflow.sources.catalog import view

    src = os.path.join(scratch, "src")
    write_messages(fx.wire(spark, SF_SMALL, "shoes"), src)
    v = view(bronze(read_messages(spark, src), "shoes"), "shoes_stream_view")
    assert v.isStreaming and spark.table("shoes_stream_view").isStreaming


def test_new_slice_after_restart_updates_latest_time(spark, scratch):
    import datetime as dt
    import json

    from shopflow.schemas import KAFKA_ROW

    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    sent = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

    def msgs(rows):
        return spark.createDataFrame(
            [(b"k", json.dumps(r).encode(), "t", sent) for r in rows], KAFKA_ROW)

    base = {"product_id": "1", "user_id": "u", "view_time": 5, "page_url": "/p", "ip": "1.1.1.1"}
    write_messages(msgs([dict(base, ts=1681560000123)]), src)
    ingest(spark, read_messages(spark, src), "shoe_clickstream", out, checkpoint=ckpt).awaitTermination()
    first = read_current(spark, out).collect()
    assert [(r.view_time, r.ts) for r in first] == [(5, dt.datetime(2023, 4, 15, 19, 0))]  # Bangkok wall clock
    # a later copy of the same payload and a new payload arrive after a restart
    write_messages(msgs([dict(base, ts=1681563600999), dict(base, view_time=7, ts=1681560000000)]), src)
    ingest(spark, read_messages(spark, src), "shoe_clickstream", out, checkpoint=ckpt).awaitTermination()
    rows = sorted((r.view_time, r.ts) for r in read_current(spark, out).collect())
    assert rows == [(5, dt.datetime(2023, 4, 15, 20, 0)), (7, dt.datetime(2023, 4, 15, 19, 0))]


def test_continuous_trigger_picks_up_new_files(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    wire = fx.wire(spark, SF_SMALL, "shoes")
    write_messages(wire.filter("key < unhex('0000000000000064')"), src)  # first slice: ids < 100
    q = ingest(spark, read_messages(spark, src), "shoes", out, checkpoint=ckpt, trigger="1 second")
    try:
        q.processAllAvailable()
        first = read_current(spark, out).count()
        write_messages(wire.filter("key >= unhex('0000000000000064')"), src)
        q.processAllAvailable()
        assert first == 102 and read_current(spark, out).count() == wire.count()
    finally:
        q.stop()


def test_ingest_into_catalog_tables(spark, scratch):
    src = os.path.join(scratch, "src")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shopflow_s LOCATION '{scratch}/dbs'")
    wire = fx.wire(spark, SF_SMALL, "shoe_orders")
    write_messages(wire, src)
    ingest(spark, read_messages(spark, src), "shoe_orders", sink_table="shopflow_s.shoe_orders",
           checkpoint=os.path.join(scratch, "c1")).awaitTermination()
    ingest(spark, read_messages(spark, src), "shoe_orders", sink_table="shopflow_s.shoe_orders_realtime",
           checkpoint=os.path.join(scratch, "c2"), mode="append").awaitTermination()
    n = wire.select("key").distinct().count()
    assert spark.table("shopflow_s.shoe_orders").count() == n
    assert spark.table("shopflow_s.shoe_orders_realtime").count() == n


def _order_messages(spark, rows):
    import datetime as dt
    import json

    from shopflow.schemas import KAFKA_ROW

    sent = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return spark.createDataFrame([(b"k", json.dumps(dict(order_id=i, product_id="1", customer_id="c", ts=ts)).encode(),
                                   "t", sent) for i, ts in rows], KAFKA_ROW)


def test_append_keeps_late_orders_and_default_checkpoints_are_apart(spark, scratch):
    src = os.path.join(scratch, "src")
    t, hour = 1681560000000, 3_600_000
    for rows in ([(1, t)], [(2, t - 2 * hour), (1, t)], [(3, t + 1000)]):
        write_messages(_order_messages(spark, rows), src)
    outs = {m: os.path.join(scratch, m) for m in ("complete", "append", "update")}
    for mode, out in outs.items():  # default checkpoints
        ingest(spark, read_messages(spark, src, max_files_per_trigger=1), "shoe_orders", out,
               mode=mode).awaitTermination()
    for rows in (read_current(spark, outs["complete"]), spark.read.parquet(outs["append"]),
                 read_updates(spark, outs["update"])):
        assert sorted(r.order_id for r in rows.collect()) == [1, 2, 3]


def test_a_reader_never_fails_during_a_rewrite(spark, scratch):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    for i in range(4):
        write_messages(_order_messages(spark, [(i, 1681560000000)]).coalesce(1), src)
    q = ingest(spark, read_messages(spark, src, max_files_per_trigger=1), "shoe_orders", out)
    seen = []
    while q.isActive:
        if pointer(spark, out):
            seen.append(read_current(spark, out).count())
    q.awaitTermination()
    assert seen == sorted(seen) and read_current(spark, out).count() == 4


def test_unknown_triggers_raise():
    import pytest

    assert trigger_kwargs("once") == {"availableNow": True} and trigger_kwargs("5 seconds") == {
        "processingTime": "5 seconds"}
    for bad in ("continuous", "soon", "5"):
        with pytest.raises(ValueError):
            trigger_kwargs(bad)
