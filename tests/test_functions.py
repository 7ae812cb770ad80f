"""Column helpers, sources and catalog helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopflow.functions.binary import unsigned_decimal
from shopflow.functions.columns import collisions, payload_columns, prefixed_columns
from shopflow.functions.times import elapsed, from_epoch_millis, ntz_literal, truncate_to_second, within_days
from shopflow.sources.catalog import create_bronze_tables, snapshot
from shopflow.sources.kafka import StreamConfig


def test_unsigned_decimal(spark):
    from shopflow.session import import_in_workers

    import_in_workers(spark)
    keys = [b"", b"\x01\x00", b"\xff" * 8, None, b"\x01" + b"\x00" * 8, b"\xff" * 32]
    df = spark.createDataFrame([(k,) for k in keys], "b binary")
    got = [r.s for r in df.select(unsigned_decimal("b").alias("s")).collect()]
    assert got == [None if k is None else str(int.from_bytes(k, "big")) for k in keys]


def test_collisions_and_prefixes(spark):
    assert collisions(["a", "b"], ["b", "c"], ["c", "d"]) == ["b", "c"]
    assert collisions(["a", "a"]) == ["a"]
    assert payload_columns(["id", "x", "ts", "arrive_dt"]) == ["id", "x"]
    df = spark.createDataFrame([(1, 2, 3)], "id int, x int, arrive_dt int").alias("t")
    assert df.select(*prefixed_columns("t", df.columns, "tbl", exclude=["arrive_dt"])).columns == ["tbl_id", "x"]


def test_time_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 30, 59, 999999),)], "t timestamp_ntz")
    end = ntz_literal("2024-03-01 10:30:59")
    r = df.select(
        truncate_to_second("t").alias("s"),
        elapsed("hour", "t", end).alias("h"), elapsed("month", "t", end).alias("m"),
        elapsed("day", end, F.col("t")).alias("neg"),
        from_epoch_millis(F.lit(1681560000123), "Asia/Bangkok").alias("bkk"),
    ).collect()[0]
    assert r.s == dt.datetime(2024, 1, 1, 10, 30, 59)
    assert (r.h, r.m, r.neg) == (24 * 60 - 1, 1, -59)
    assert r.bkk == dt.datetime(2023, 4, 15, 19, 0)


def test_within_days_equals_whole_day_difference(spark):
    as_of = dt.datetime(2024, 1, 31)
    ts = [as_of - dt.timedelta(seconds=s) for s in range(-200000, 900000, 3607)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    ref = ntz_literal(as_of)
    bad = df.filter(within_days("t", ref, 7) != (elapsed("day", "t", ref) < 7)).count()
    assert bad == 0


def test_stream_config(tmp_path):
    ini = tmp_path / "config.cfg"
    ini.write_text("[SHOP]\nbootstrap_server = b:9092\nconfluentApiKey = k\nconfluentSecret = s\n"
                   "TopicName_shoe_orders = orders\n")
    cfg = StreamConfig.from_ini(str(ini), "SHOP", "shoe_orders")
    opts = cfg.options()
    assert opts["subscribe"] == "orders" and opts["startingOffsets"] == "earliest"
    assert opts["failOnDataLoss"] == "false" and opts["kafka.security.protocol"] == "SASL_SSL"
    assert "username='k' password='s'" in opts["kafka.sasl.jaas.config"]
    assert "kafka.sasl.mechanism" not in StreamConfig("b", "t").options()
    with pytest.raises(FileNotFoundError):
        StreamConfig.from_ini(str(tmp_path / "missing.cfg"), "SHOP", "x")


def test_catalog(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shopflow_t LOCATION '{scratch}/db'")
    names = create_bronze_tables(spark, "shopflow_t")
    assert len(names) == 5
    cols = [c.name for c in spark.catalog.listColumns("shopflow_t.shoe_orders")]
    assert cols == ["order_id", "product_id", "customer_id", "ts", "arrive_dt"]
    df = spark.createDataFrame([(1,)], "x int")
    assert snapshot(df, "shopflow_t.snap").count() == 1


def test_persistent_view(spark, scratch):
    from shopflow.sources.catalog import persistent_view

    spark.sql(f"CREATE DATABASE IF NOT EXISTS shopflow_v LOCATION '{scratch}/dbv'")
    snapshot(spark.createDataFrame([(1, "a"), (2, "a")], "x int, b string"), "shopflow_v.base")
    v = persistent_view(spark, "shopflow_v.per_b", "SELECT b, count(*) AS n FROM shopflow_v.base GROUP BY b")
    assert [(r.b, r.n) for r in v.collect()] == [("a", 2)]


def test_wire_schema_from_sink_table(spark, scratch):
    from shopflow.schemas import wire_schema
    from shopflow.sources.catalog import wire_schema_of

    spark.sql(f"CREATE DATABASE IF NOT EXISTS shopflow_w LOCATION '{scratch}/dbw'")
    create_bronze_tables(spark, "shopflow_w")
    for t in ("shoe_orders", "shoe_clickstream", "customers", "shoes"):
        assert wire_schema_of(spark, f"shopflow_w.{t}").simpleString() == wire_schema(t).simpleString()


def test_shift_zone_and_catalog_columns(spark):
    from shopflow.functions.columns import table_columns
    from shopflow.functions.times import shift_zone

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12),)], "t timestamp_ntz")
    assert df.select(shift_zone("t", "Asia/Bangkok").alias("s")).collect()[0].s == dt.datetime(2024, 1, 1, 19)
    df.createOrReplaceTempView("columns_of")
    assert table_columns(spark, "columns_of") == {"t": "timestamp_ntz"}


def test_elapsed_fixed_units_match_timestampdiff_in_utc(spark):
    import random

    from shopflow.functions.times import epoch_micros

    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 31)
    rows = [(base + dt.timedelta(microseconds=rnd.randrange(-10**14, 10**14)),
             base + dt.timedelta(microseconds=rnd.randrange(-10**12, 10**12))) for _ in range(500)]
    rows += [(dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(1970, 1, 1, 0, 0, 0, 250000))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    for unit in ("second", "minute", "hour", "day", "week"):
        bad = df.filter(elapsed(unit, "a", F.col("b")) != F.timestamp_diff(unit.upper(), "a", "b")).count()
        assert bad == 0, unit
    got = df.select(epoch_micros("a").alias("m")).collect()[-1].m
    assert got == -500000


def test_scratch_folders_go_with_the_driver():
    """A run's tables lie below the shared folder while it lasts, and are gone when its JVM has ended."""
    import os
    import subprocess
    import sys
    import tempfile

    shared = tempfile.mkdtemp(prefix="shopflow-test-", dir="/tmp")
    code = f"""
from shopflow.session import checkpoint_dir, get_session, scratch_path
import os
spark = get_session(master="local[1]")
checkpoint_dir(spark, fallback={shared!r})
path = scratch_path(spark, "x")
spark.range(3).write.parquet(path)
assert os.path.isdir(path) and path.startswith({shared!r}[:5]), path
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=os.path.dirname(os.path.dirname(__file__)))
    left = [f for _, _, files in os.walk(shared) for f in files if f.endswith(".parquet")]
    assert left == []
