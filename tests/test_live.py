"""Streams against their sinks: live monitor, reconciliation, orders once; tables replaced under readers."""

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from shopflow import fixtures as fx
from shopflow.plans import gold, silver
from shopflow.plans.bronze import bronze, normalise_ts, parse
from shopflow.schemas import BRONZE, KAFKA_ROW
from shopflow.sources import versions
from shopflow.sources.catalog import create_bronze_tables, persistent_view, snapshot
from shopflow.sources.keyindex import files_of, lookup_clustered, write_clustered
from shopflow.sources.replay import read_messages, write_messages
from shopflow.streaming.ingest import ingest
from shopflow.streaming.live import read_recent_clicks, watch_recent_clicks
from shopflow.streaming.once import read_once, slices, write_once
from shopflow.streaming.reconcile import refresh_missing, watch_missing
from shopflow.streaming.sinks import fold_updates, read_current, read_updates, run_of

from . import helpers as h
from .conftest import SF_SMALL

T = 1681560000000


def messages(spark, rows):
    sent = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return spark.createDataFrame([(b"k", json.dumps(r).encode(), "t", sent) for r in rows], KAFKA_ROW).coalesce(1)


def order_rows(*ids, ts=T):
    return [dict(order_id=i, product_id="1", customer_id="c", ts=ts + (i or 0) * 1000) for i in ids]


def multiset(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


# ---------------------------------------------------------------- live monitor

def test_live_monitor_equals_the_batch_monitor_after_each_batch(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    shoes = h.shoes(spark, [("1", "A"), ("2", "B"), ("2", "C")])
    minute, said, newest, sizes = 60_000, [], 0, []
    batches = [
        [(0, "1"), (5, "2"), (5, "2"), (5, "9"), (None, "1")],
        [(14, "1"), (-20, "1"), (2, "2")],     # late ones: long gone, and still recent
        [(15, "1")],                           # minute 0 is exactly 15 minutes old: stays
        [(15.5, "2"), (16.5, "9")],            # the newest click is of an unknown product
        [(40, "1"), (26, "2")],
        [(40 + 10 * i, "1") for i in range(1, 30)],
        [(400, "2")],
    ]
    q = None
    for i, batch in enumerate(batches):
        rows = [dict(product_id=p, user_id=f"u{j % 2}", view_time=j, page_url="/", ip="", ts=None if m is None else
                     T + int(m * minute)) for j, (m, p) in enumerate(batch)]
        write_messages(messages(spark, rows), src)
        said += rows
        newest = max([newest, *(r["ts"] for r in rows if r["ts"])])
        stream = normalise_ts(parse(read_messages(spark, src), "shoe_clickstream"), "shoe_clickstream", "UTC")
        clicks = stream.withColumn("arrive_dt", F.col("ts")).select(*BRONZE["shoe_clickstream"].fieldNames())
        q = watch_recent_clicks(clicks, shoes, out, ckpt, trigger="availableNow")
        q.awaitTermination()
        sizes.append(sum(s["numRowsTotal"] for p in q.recentProgress[-1:] for s in p["stateOperators"]))
        as_of = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=newest)
        batch_clicks = normalise_ts(parse(messages(spark, said), "shoe_clickstream"), "shoe_clickstream", "UTC")
        batch_clicks = batch_clicks.withColumn("arrive_dt", F.col("ts")).select(*clicks.columns)
        want = gold.recent_clicks(silver.click_history_v2(batch_clicks, shoes, as_of), as_of=as_of)
        assert multiset(read_recent_clicks(spark, out, as_of)) == multiset(want), i
    assert sizes[-1] <= 8, sizes  # 40 clicks later only the last ones and their timers are held


@pytest.mark.parametrize("store", [None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"])
def test_live_monitor_in_a_session_with_another_state_store(spark, scratch, store):
    conf = "spark.sql.streaming.stateStore.providerClass"
    plain = spark.newSession()
    plain.conf.unset(conf)
    if store:
        plain.conf.set(conf, store)
    before = plain.conf.get(conf)
    rows = [dict(product_id=p, user_id="u", view_time=1, page_url="/", ip="", ts=T + m * 60_000)
            for p, m in (("1", 0), ("1", 20), ("2", 30), ("9", 31))]
    write_messages(messages(plain, rows), f"{scratch}/src")
    stream = normalise_ts(parse(read_messages(plain, f"{scratch}/src"), "shoe_clickstream"), "shoe_clickstream", "UTC")
    clicks = stream.withColumn("arrive_dt", F.col("ts")).select(*BRONZE["shoe_clickstream"].fieldNames())
    shoes = h.shoes(plain, [("1", "A"), ("2", "B")])
    for _ in range(2):  # a restart finds its state again
        watch_recent_clicks(clicks, shoes, f"{scratch}/out", f"{scratch}/ckpt", trigger="availableNow").awaitTermination()
        found = read_recent_clicks(plain, f"{scratch}/out").collect()
        assert sorted((r.shoes_id, r.brand) for r in found) == [("1", "A"), ("2", "B")]
        assert plain.conf.get(conf) == before


# ---------------------------------------------------------------- reconciliation

def test_missing_orders_after_each_batch(spark, scratch):
    src, sink, out = (os.path.join(scratch, d) for d in ("src", "sink", "out"))
    seen, stored = set(), set()
    parts = [([1, 2, None], [1]), ([3, 4, 3], [2]), ([5], [4, None]), ([6, 1], [6])]
    for i, (came, landed) in enumerate(parts):
        write_messages(messages(spark, order_rows(*came)), src)
        # the sink is behind the stream, and its current version changes under the check
        stored |= set(landed)
        versions.replace_folder(h.orders(spark, [(o, "1", "c", h.at(1)) for o in stored]), sink)
        seen |= set(came)
        rows = parse(read_messages(spark, src), "shoe_orders")
        watch_missing(rows, lambda s: read_current(s, sink), "order_id", out, os.path.join(scratch, "ckpt"),
                      trigger="availableNow").awaitTermination()
        assert {r.order_id for r in read_current(spark, out).collect()} == seen - stored, i
    versions.replace_folder(h.orders(spark, [(o, "1", "c", h.at(1)) for o in seen]), sink)
    assert refresh_missing(spark, lambda s: read_current(s, sink), "order_id", out).count() == 0


# ---------------------------------------------------------------- every order once

def test_a_day_late_repeat_goes_and_a_day_late_new_order_stays(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    day = 86_400_000

    def run(rows, today):
        write_messages(messages(spark, rows), src)
        orders = normalise_ts(parse(read_messages(spark, src), "shoe_orders"), "shoe_orders").drop("_sent")
        q = write_once(orders, "order_id", out, ckpt, ["ts"], today=lambda: today)
        q.awaitTermination()
        assert not q.lastProgress["stateOperators"]  # nothing is held between batches
        found = read_once(spark, out).collect()
        assert all(r.product_id == "1" for r in found)
        return sorted((r.order_id for r in found), key=lambda i: (i is not None, i))

    repeats = [dict(r, product_id="again", ts=r["ts"] + 1) for r in order_rows(7, 8, None)]
    assert run(order_rows(*range(1, 41), None) + repeats, "2024-01-01") == [None, *range(1, 41)]
    assert run(order_rows(41, 42), "2024-01-01") == [None, *range(1, 43)]
    late = [dict(r, product_id="again", ts=r["ts"] + day) for r in order_rows(3, 41, None)]
    new = order_rows(50, 0, ts=T - day)  # older than all that came before
    assert run(late + new, "2024-01-02") == [None, 0, *range(1, 43), 50]
    assert run(late, "2024-01-03") == [None, 0, *range(1, 43), 50]
    assert run(order_rows(51), "2024-01-04") == [None, 0, *range(1, 43), 50, 51]
    # days past are one slice each, with the rows of all their batches
    assert [s.partition("/")[0] for s in slices(spark, out)] == [f"day=2024-01-0{i}" for i in (1, 2, 3, 4)]
    # batch by batch again, as after crashes before the commits: folded or not, nothing is doubled or lost
    before = multiset(read_once(spark, out))
    for last in ("4", "3"):
        for name in (last, f".{last}.crc"):
            if os.path.exists(f"{ckpt}/commits/{name}"):
                os.rename(f"{ckpt}/commits/{name}", f"{scratch}/lost{name}")
    orders = normalise_ts(parse(read_messages(spark, src), "shoe_orders"), "shoe_orders").drop("_sent")
    write_once(orders, "order_id", out, ckpt, ["ts"], today=lambda: "2024-01-04").awaitTermination()
    assert multiset(read_once(spark, out)) == before


def test_stored_keys_by_list_and_by_join(spark, scratch, monkeypatch):
    from shopflow.streaming import once

    for name, own in (("day=1/a", (1, 5, 9, None)), ("day=1/b", (200, 300)), ("day=2/c", (5, 6))):
        once._write(h.orders(spark, [(i, "1", "c", h.at(1)) for i in own]), "order_id", f"{scratch}/{name}")
    for wanted, found in (((5, 6, None, 9, 12), ["5", "6", "9", "None"]), ((250,), []), ((7, 400), []), ((None,), ["None"])):
        ids = spark.createDataFrame([(i,) for i in wanted], "order_id long")
        for limit in (1000, 0):
            monkeypatch.setattr(once, "IN_LIST", limit)
            got = once.stored_keys(spark, scratch, ["day=1/a", "day=1/b", "day=2/c"], "order_id", ids).collect()
            assert sorted(str(r.order_id) for r in got) == found


# ---------------------------------------------------------------- tables replaced under readers

def test_ddl_then_complete_ingest_for_all_tables_then_ddl_again(spark, scratch):
    db = "shopflow_ddl"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/ddl'")
    create_bronze_tables(spark, db)
    for table in BRONZE:
        wire = fx.wire(spark, SF_SMALL, table).limit(50)
        write_messages(wire, f"{scratch}/{table}")
        assert spark.table(f"{db}.{table}").count() == 0
        for attempt in ("a", "b"):  # the second on a new checkpoint
            ingest(spark, read_messages(spark, f"{scratch}/{table}"), table, sink_table=f"{db}.{table}",
                   checkpoint=f"{scratch}/c-{table}-{attempt}").awaitTermination()
            assert spark.table(f"{db}.{table}").count() > 0
            assert spark.table(f"{db}.{table}").schema.fieldNames() == BRONZE[table].fieldNames()
    create_bronze_tables(spark, db)
    assert all(spark.newSession().table(f"{db}.{t}").count() == 0 for t in BRONZE)
    create_bronze_tables(spark, db, replace=False)
    for t in BRONZE:
        versions.drop(spark, f"{db}.{t}")
    assert not [t for t in spark.catalog.listTables(db) if not t.isTemporary]


def test_a_plain_table_of_the_name_is_taken_over(spark, scratch):
    db = "shopflow_plain"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/plain'")
    spark.range(3).write.saveAsTable(f"{db}.t")
    persistent_view(spark, f"{db}.v", f"SELECT count(*) AS n FROM {db}.t")
    for n in (5, 6, 7):
        assert snapshot(spark.range(n), f"{db}.t").count() == n == spark.table(f"{db}.v").first().n
    assert len([t for t in spark.catalog.listTables(db) if not t.isTemporary]) == 4  # two names, two versions


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_readers_never_fail(spark, scratch, kind):
    """A reader loops over a run on a new checkpoint and over batches that are repeated after a crash."""
    db = f"shopflow_reader_{kind}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch}/r'")
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    sink = {"path": out} if kind == "folder" else {"sink_table": f"{db}.orders"}
    for i in range(3):
        write_messages(messages(spark, order_rows(i)), src)

    def run(checkpoint):
        ingest(spark, read_messages(spark, src, max_files_per_trigger=1), "shoe_orders", checkpoint=checkpoint,
               **sink).awaitTermination()

    run(f"{scratch}/c1")
    done, counts, failures = threading.Event(), [], []

    def read():
        session = spark.newSession()
        while not done.is_set():
            try:
                rows = read_current(session, out) if kind == "folder" else session.table(f"{db}.orders")
                counts.append(rows.count())
            except Exception as e:  # noqa: BLE001 - the test is about any failure
                failures.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        run(f"{scratch}/c2")
        last = max(os.listdir(f"{scratch}/c2/commits"), key=lambda n: int(n) if n.isdigit() else -1)
        for name in (last, f".{last}.crc"):  # as if the last batch had been written but not committed
            if os.path.exists(f"{scratch}/c2/commits/{name}"):
                os.rename(f"{scratch}/c2/commits/{name}", f"{scratch}/lost{name}")
        run(f"{scratch}/c2")
    finally:
        done.set()
        reader.join()
    assert not failures, failures[:1]
    assert len(counts) > 3 and set(counts) <= {1, 2, 3} and counts[-1] == 3


def test_update_slices_fold(spark, scratch):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    for i in range(4):
        write_messages(messages(spark, order_rows(i)), src)
    for run in range(3):
        ingest(spark, read_messages(spark, src, max_files_per_trigger=1), "shoe_orders", out, mode="update",
               checkpoint=f"{scratch}/c{run}").awaitTermination()
        before = multiset(read_updates(spark, out).drop("arrive_dt"))
        assert len(before) == 4
        assert fold_updates(spark, out) == 4 and fold_updates(spark, out) == 0
        assert multiset(read_updates(spark, out).drop("arrive_dt")) == before
        # at most the slices of two folds stay
        assert len(versions.folders(spark, f"{out}/slices")) <= 8
    assert run_of("a/") == run_of("a") != run_of("b")


# ---------------------------------------------------------------- point lookup

def test_lookup_reads_one_file_of_a_hundred(spark, scratch):
    orders = fx.orders(spark, "/root/testdata/sf0.01").repartition(7)
    path = os.path.join(scratch, "clustered")
    write_clustered(orders, path, "order_id", files=100)
    assert len(files_of(spark, path, F.lit(True))) == 100
    some = [r.order_id for r in orders.orderBy("order_id").limit(300).collect()][::97]
    for order_id in some:
        found = lookup_clustered(spark, path, "order_id", order_id)
        assert len(found.inputFiles()) == 1
        assert multiset(found) == multiset(orders.filter(F.col("order_id") == order_id))
        scan = found._jdf.queryExecution().executedPlan()
        found.collect()
        assert "PushedFilters: [IsNotNull(order_id), EqualTo(order_id" in scan.toString()
    assert lookup_clustered(spark, path, "order_id", -5).count() == 0
    assert lookup_clustered(spark, path, "order_id", None).count() == 0
    write_clustered(orders.limit(10), path, "order_id", files=2)  # a new version
    assert len(files_of(spark, path, F.lit(True))) <= 2
