"""The recent-click monitor as a live view.

Clicks enter keyed state and leave it by an event-time timer once they are older than the monitor's
minutes; what enters and leaves changes a small versioned table, which is the view.  The watermark trails
the newest click by the same minutes, so a click that it would drop has no place in the view: nothing is
lost, and the state never holds more than the view.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from shopflow.functions.columns import prefixed_columns
from shopflow.functions.times import REFERENCE_ZONE, AsOf, as_of_column, recency_columns
from shopflow.session import import_in_workers, rocksdb_state
from shopflow.sources import versions
from shopflow.streaming.sinks import read_current, run_of, start_batches

_AT, _CHANGE, _KEY, _TIME = "_at", "_change", "_part", "_event_time"


class _Recent(StatefulProcessor):
    """Rows by time of expiry: each is put out with change 1 when it comes and -1 when it expires."""

    def __init__(self, schema: StructType):
        self.schema = schema

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        names = self.schema.fieldNames()
        new = [tuple(r[n] for n in names) for r in rows if r[_AT] > now]
        if new:
            self.rows.appendList(new)
            self.handle.registerTimer(min(r[0] for r in new))
        for r in new:
            yield Row(_CHANGE, *names)(1, *r)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        names = self.schema.fieldNames()
        kept, gone = [], []
        for r in self.rows.get():
            (kept if r[0] > now else gone).append(tuple(r))
        if gone and kept:
            self.rows.put(kept)
        elif gone:
            self.rows.clear()
        if kept:
            self.handle.registerTimer(min(r[0] for r in kept))
        for r in gone:
            yield Row(_CHANGE, *names)(-1, *r)

    def close(self) -> None:
        pass


def with_event_time(rows: DataFrame, ts_col: str, minutes: int) -> DataFrame:
    """The stream with a watermark ``minutes`` (and a millisecond: the view's lower end is inclusive) behind its newest row."""
    return rows.withColumn(_TIME, F.col(ts_col).cast("timestamp")).withWatermark(
        _TIME, f"{minutes} minutes 1 milliseconds")


def recent_changes(timed: DataFrame, parts: int = 64) -> DataFrame:
    """Rows of ``with_event_time`` with ``_change`` 1 as they come and -1 once the watermark has passed them.

    State is dealt to ``parts`` keys by a hash of the whole row, so no customer's or product's clicks
    sit in one place.  Rows without a time are never recent.
    """
    columns = [c for c in timed.columns if c != _TIME]
    kept = StructType([StructField(_AT, LongType()), *timed.select(*columns).schema.fields])
    keyed = timed.filter(F.col(_TIME).isNotNull()).withColumns({
        _KEY: F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int"), _AT: F.unix_millis(_TIME)})
    out = StructType([StructField(_CHANGE, LongType()), *kept.fields])
    return keyed.groupBy(_KEY).transformWithState(
        statefulProcessor=_Recent(kept), outputStructType=out, outputMode="Update", timeMode="EventTime").drop(_AT)


def write_changes(changes: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow",
                  query_name: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Apply signed rows to the versioned table at ``path``; a repeated batch changes nothing.

    A run on another checkpoint starts from an empty table, as its state does.
    """
    run = run_of(checkpoint)
    versions.clean_folder(changes.sparkSession, path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, note = batch.sparkSession, f"{run}-{batch_id}"
        found = versions.note_of(spark, path)
        if found == note:
            return  # swapped in before a crash kept the batch from being committed
        rows = batch
        if found and found.rpartition("-")[0] == run:
            rows = rows.unionByName(read_current(spark, path, fmt).withColumn(_CHANGE, F.lit(1).cast("long")))
        columns = [c for c in batch.columns if c != _CHANGE]
        n = rows.groupBy(*columns).agg(F.sum(_CHANGE).alias("_n")).filter("_n > 0")
        versions.replace_folder(n.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("col"),
                                path, fmt, note)

    with rocksdb_state(changes.sparkSession):  # the only store that transformWithState runs on
        return start_batches(changes, "update", checkpoint, trigger, query_name, apply)


def watch_recent_clicks(clicks: DataFrame, shoes: DataFrame, path: str, checkpoint: str, minutes: int = 15,
                        trigger: str | None = None, query_name: str | None = None) -> StreamingQuery:
    """Keep the clicks of the last ``minutes`` before the newest one, with their shoes, at ``path``."""
    import_in_workers(clicks.sparkSession)
    # the newest click counts also where its product is unknown, so the watermark comes before the join
    cs, s = with_event_time(clicks, "ts", minutes).alias("cs"), shoes.alias("s")
    rows = cs.join(s, F.col("cs.product_id") == F.col("s.id")).select(
        *prefixed_columns("cs", clicks.columns, "shoe_clickstream", exclude=["arrive_dt"]),
        *prefixed_columns("s", shoes.columns, "shoes", exclude=["arrive_dt"]), f"cs.{_TIME}")
    return write_changes(recent_changes(rows), path, checkpoint, trigger, query_name)


def read_recent_clicks(spark: SparkSession, path: str, as_of: AsOf = None, zone: str = REFERENCE_ZONE) -> DataFrame:
    """The view with the recency columns of the click history at ``as_of``."""
    rows = read_current(spark, path)
    return rows.select(*rows.columns, *recency_columns("shoe_clickstream_ts", as_of_column(as_of, zone)))
