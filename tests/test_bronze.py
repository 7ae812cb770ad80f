"""Bronze ingest on hand-made wire messages (batch path)."""

import datetime as dt
import json

from shopflow.plans.bronze import bronze
from shopflow.schemas import KAFKA_ROW

SENT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _messages(spark, payloads, sent=None):
    rows = []
    for i, p in enumerate(payloads):
        value = None if p is None else (p if isinstance(p, str) else json.dumps(p)).encode()
        rows.append((str(i).encode(), value, "t", (sent or [SENT] * len(payloads))[i]))
    return spark.createDataFrame(rows, KAFKA_ROW)


def test_epoch_millis_are_cut_and_shifted(spark):
    msgs = _messages(spark, [{"order_id": 1, "product_id": "p", "customer_id": "c", "ts": 1681560000123}])
    row = bronze(msgs, "shoe_orders", arrival="message").collect()[0]
    assert row.ts == dt.datetime(2023, 4, 15, 19, 0, 0)
    # arrival stamp of the orders table is shifted too
    assert row.arrive_dt == dt.datetime(2024, 1, 1, 7, 0, 0)
    utc = bronze(msgs, "shoe_orders", zone="UTC", arrival="message").collect()[0]
    assert utc.ts == dt.datetime(2023, 4, 15, 12, 0, 0)


def test_click_payloads_collapse_to_latest(spark):
    base = {"product_id": "1", "user_id": "u", "view_time": 5, "page_url": "/p/1", "ip": "1.1.1.1"}
    msgs = _messages(spark, [
        dict(base, ts=1_700_000_000_000),
        dict(base, ts=1_700_000_000_000),       # exact duplicate
        dict(base, ts=1_700_000_100_999),       # same payload, later -> kept time
        dict(base, view_time=6, ts=1_600_000_000_000),  # other payload, late (earlier ts)
    ])
    rows = sorted(bronze(msgs, "shoe_clickstream", zone="UTC", arrival="message").collect(), key=lambda r: r.view_time)
    assert [(r.view_time, r.ts) for r in rows] == [
        (5, dt.datetime(2023, 11, 14, 22, 15, 0)),
        (6, dt.datetime(2020, 9, 13, 12, 26, 40)),
    ]


def test_order_id_dedup_keeps_first_message(spark):
    early = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    late = dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)
    msgs = _messages(spark, [
        {"order_id": 7, "product_id": "b", "customer_id": "c", "ts": 1_700_000_000_000},
        {"order_id": 7, "product_id": "a", "customer_id": "c", "ts": 1_700_000_000_000},
    ], sent=[early, late])
    rows = bronze(msgs, "shoe_orders", arrival="message").collect()
    assert [(r.order_id, r.product_id) for r in rows] == [(7, "b")]


def test_malformed_and_tombstones_fold_into_one_null_row(spark):
    good = {"id": "1", "brand": "A", "name": "n", "sale_price": 10, "rating": 4.5}
    msgs = _messages(spark, [good, "{not json", None, dict(good, sale_price="ten")])
    rows = bronze(msgs, "shoes", arrival="message").collect()
    as_tuples = sorted(((r.id, r.brand, r.sale_price) for r in rows if r.id is not None), key=str)
    assert as_tuples == [("1", "A", 10), ("1", "A", None)]  # a bad field nulls only that field
    assert sum(1 for r in rows if r.id is None) == 1
    dropped = bronze(msgs, "shoes", arrival="message", drop_malformed=True).collect()
    assert all(r.id is not None for r in dropped)


def test_dimension_arrival_is_not_shifted(spark):
    msgs = _messages(spark, [{"id": "1", "first_name": "a"}])
    row = bronze(msgs, "customers", arrival="message").collect()[0]
    assert row.arrive_dt == dt.datetime(2024, 1, 1)
    smoke = bronze(_messages(spark, [{"id": "1"}]), "shoes_test", arrival="message").collect()[0]
    assert smoke.arrive_dt == dt.datetime(2024, 1, 1, 7)


def test_processing_time_arrival(spark):
    msgs = _messages(spark, [{"id": "1"}])
    row = bronze(msgs, "shoes").collect()[0]
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((now - row.arrive_dt).total_seconds()) < 120 and row.arrive_dt.microsecond == 0
